"""Extractors from outside: any function over pages, whose observations are checked before use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.catalog import FIELDS
from attestry.operators.contracts import broken_rules, evidence_rules, observation_rules
from attestry.operators.grounding import ground
from attestry.schemas import OBSERVATION_COLUMNS
from attestry.session import materialize

Extractor = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
#: What an extractor gets and what it returns, as frames of rows in any order.
GIVEN = ("parsed_document_id", "document_version_id", "page_number", "text")
RETURNED = f"parsed_document_id string, observation_index int, {OBSERVATION_COLUMNS}"


#: Rows that an extractor gets at a time; what it makes of them is gone before the next ones.
PORTION = 1000


def portions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), PORTION):
            yield frame.iloc[at : at + PORTION].reset_index(drop=True)


def run_extractor(
    pages: DataFrame, extractor: Extractor, headers: DataFrame, fields: Sequence[str] = FIELDS
) -> tuple[DataFrame, DataFrame]:
    """(observations, refusals) of an extractor that is not trusted.

    The extractor runs once, over batches of pages; its rows are written before anything reads them.
    ``headers`` has one row per document: registry, project_id, document_version_id,
    parsed_document_id, extraction_run_id. Refusals (parsed_document_id, rule) name documents that are
    not among them, rows that break the observation or evidence contract, indexes that don't run from
    0 without gap or repeat, and quotes that don't stand on their page. One refusal keeps all
    observations of its document out. Documents without any row have neither.
    """
    given = pages.select(
        F.col("parsed_document_id").cast("string"), F.col("document_version_id").cast("string"), "page_number", "text"
    )
    found = materialize(given.select(*GIVEN).mapInPandas(lambda frames: extractor(portions(frames)), RETURNED))
    document = "parsed_document_id"
    rows = found.join(headers.withColumn("_known", F.lit(True)), document, "left")
    broken = rows.select(
        document,
        F.when(F.col("_known").isNull(), F.array(F.lit("document_unknown")))
        .otherwise(broken_rules(observation_rules(fields)))
        .alias("rules"),
    ).select(document, F.explode("rules").alias("rule"))
    indexes = (
        found.groupBy(document, "observation_index").agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(document)
        .agg(
            F.sum("_n").alias("_rows"), F.count("observation_index").alias("_distinct"),
            F.min("observation_index").alias("_first"), F.max("observation_index").alias("_last"),
        )
    )
    ordered = (F.col("_first") == 0) & (F.col("_last") + 1 == F.col("_rows")) & (F.col("_distinct") == F.col("_rows"))
    gaps = indexes.where(~F.coalesce(ordered, F.lit(False))).select(document, F.lit("index_not_sequential").alias("rule"))
    quotes = found.select(document, F.explode("evidence").alias("e")).select(document, "e.*")
    loose = ground(quotes, given).select(
        document,
        F.explode(
            F.concat(
                broken_rules(evidence_rules()),
                F.when(F.col("outcome") == "grounded", F.array().cast("array<string>")).otherwise(
                    F.array(F.concat(F.lit("evidence_"), "outcome"))
                ),
            )
        ).alias("rule"),
    )
    refusals = materialize(reduce(DataFrame.unionByName, [broken, gaps, loose]).distinct())
    kept = rows.drop("_known").join(
        refusals.select(document).distinct(), rows[document].eqNullSafe(refusals[document]), "left_anti"
    )
    return kept, refusals

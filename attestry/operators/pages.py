"""Page text quality, routing of weak pages, merging of recognised text, parse records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.functions.text import REPLACEMENT_CHARACTER, remove_whitespace
from attestry.functions.values import canonical_hash

MIN_NON_WHITESPACE = 80
MAX_REPLACEMENT_RATIO = 0.02
MIN_INK_RATIO = 0.001


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def text_quality(pages: DataFrame, text: str = "text") -> DataFrame:
    """Add the four deterministic text measures of a page."""
    page = F.col(text)
    measured = pages.withColumns(
        {
            "character_count": F.length(page),
            "non_whitespace_count": F.length(remove_whitespace(page)),
            "_alphanumeric": F.length(F.regexp_replace(page, r"[^\p{L}\p{N}]+", "")),
            "_replacement": F.length(page)
            - F.length(F.translate(page, REPLACEMENT_CHARACTER, "")),
        }
    )
    return measured.withColumns(
        {
            "alphanumeric_ratio": _ratio(F.col("_alphanumeric"), F.col("non_whitespace_count")),
            "replacement_character_ratio": _ratio(F.col("_replacement"), F.col("character_count")),
        }
    ).drop("_alphanumeric", "_replacement")


def route_ocr(
    measured: DataFrame,
    min_non_whitespace: int = MIN_NON_WHITESPACE,
    max_replacement_ratio: float = MAX_REPLACEMENT_RATIO,
    min_ink_ratio: float = MIN_INK_RATIO,
) -> DataFrame:
    """Add ``route`` (native, blank, ocr_required) and a warning for blank pages.

    ``ink_ratio`` is an input column; a page without a rendered measure counts as not blank.
    """
    if min_non_whitespace < 0:
        raise ValueError("minimum non-whitespace count cannot be negative")
    if not (0 <= max_replacement_ratio <= 1 and 0 <= min_ink_ratio <= 1):
        raise ValueError("ratios must lie between 0 and 1")
    readable = (F.col("non_whitespace_count") >= min_non_whitespace) & (
        F.col("replacement_character_ratio") <= max_replacement_ratio
    )
    route = (
        F.when(readable, "native")
        .when(F.col("ink_ratio") < min_ink_ratio, "blank")
        .otherwise("ocr_required")
    )
    return measured.withColumn("route", route).withColumn(
        "warning",
        F.when(
            F.col("route") == "blank",
            F.concat(F.lit("page "), F.col("page_number"), F.lit(": blank page skipped OCR")),
        ),
    )


def merge_ocr_text(routed: DataFrame, recognised: DataFrame) -> DataFrame:
    """Replace the text of routed pages by recognised text and measure those pages again.

    ``recognised`` has (parsed_document_id, page_number, ocr_text). Pages that were routed but
    have no recognised text keep their native text and ``used_ocr = false``.
    """
    keys = ["parsed_document_id", "page_number"]
    measures = [
        "character_count",
        "non_whitespace_count",
        "alphanumeric_ratio",
        "replacement_character_ratio",
    ]
    take = (F.col("route") == "ocr_required") & F.col("ocr_text").isNotNull()
    merged = (
        routed.drop(*measures)
        .join(recognised.select(*keys, "ocr_text"), keys, "left")
        .withColumn("used_ocr", F.coalesce(take, F.lit(False)))
        .withColumn("text", F.when(F.col("used_ocr"), F.col("ocr_text")).otherwise(F.col("text")))
        .drop("ocr_text")
    )
    return text_quality(merged)


def parse_summary(pages: DataFrame) -> DataFrame:
    """Page count, recognised page count and warning count per parsed document."""
    return pages.groupBy("parsed_document_id").agg(
        F.count(F.lit(1)).alias("page_count"),
        F.count_if("used_ocr").alias("ocr_page_count"),
        F.count("warning").alias("warning_count"),
    )


def page_sequence(pages: DataFrame) -> DataFrame:
    """Do the pages of a document run 1..n without gaps or repeats?

    A repeated (document, page) is folded first, so the check needs no distinct per document and
    never gathers the pages of one document in one task.
    """
    once = pages.groupBy("parsed_document_id", "page_number").agg(F.count(F.lit(1)).alias("copies"))
    return (
        once.groupBy("parsed_document_id")
        .agg(
            F.sum("copies").alias("page_count"),
            F.count(F.lit(1)).alias("distinct_pages"),
            F.min("page_number").alias("first_page"),
            F.max("page_number").alias("last_page"),
        )
        .withColumn(
            "sequential",
            (F.col("first_page") == 1)
            & (F.col("last_page") == F.col("page_count"))
            & (F.col("distinct_pages") == F.col("page_count")),
        )
    )


CONFIGURATION_COLUMNS = (
    "parser_name",
    "parser_version",
    "min_non_whitespace_count",
    "max_replacement_character_ratio",
    "inspection_dpi",
    "inspection_white_threshold",
    "inspection_min_ink_ratio",
    "ocr_engine_name",
    "ocr_engine_version",
    "ocr_language",
    "ocr_dpi",
)


def configuration_hash(runs: DataFrame) -> DataFrame:
    """Add the hash of the eleven settings that decide what a parse looks like."""
    return runs.withColumn("configuration_hash", canonical_hash(*CONFIGURATION_COLUMNS))


def unparsed(incoming: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split incoming parses into new ones and those already stored for the same settings."""
    keys = ["document_version_id", "configuration_hash"]
    first = incoming.groupBy(*keys).agg(F.min("parsed_document_id").alias("parsed_document_id"))
    fresh = first.join(stored.select(*keys), keys, "left_anti")
    reused = incoming.join(stored.select(*keys, "parsed_document_id").withColumnRenamed(
        "parsed_document_id", "stored_parsed_document_id"), keys)
    return fresh, reused


def read_parsed(documents: DataFrame, pages: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Header columns beside every page; pages stay one per row, in no particular order.

    A page that was stored twice appears twice: ``contracts`` reports it, nothing is dropped here.
    """
    wanted = documents if ids is None else documents.join(ids, "parsed_document_id", "left_semi")
    shared = [c for c in pages.columns if c in wanted.columns and c != "parsed_document_id"]
    return wanted.join(pages.drop(*shared), "parsed_document_id")

"""Bounded samples of labelled rows, the only rows that models are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.session import materialize

SAMPLE_ROWS = 8_000


def held_out(key: Column) -> Column:
    """Rows kept from every fit: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """At most ``rows`` labelled documents (text, label): those with the smallest hashes of doc_id.

    Rows without a label or id and held-out rows never take part; equal texts with equal labels
    count once. The chosen ids are broadcast;
    there are never more than ``rows`` of them.
    """
    key = F.col("doc_id")
    chosen = (
        labels.where(F.col(label).isNotNull() & key.isNotNull() & ~held_out(key))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64(key), key).limit(rows)
    )
    return materialize(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
        .select("text", "label").distinct()
    )


def sample_by_class(
    docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """As ``labelled_sample``, with at most ``rows`` / 2 rows of each class: text, label, weight.

    A rare class so fills its half. ``weight`` is how many labelled ids of its class a row stands for,
    so that weighted rows have the classes' true shares. A null, or a label that is not 0 or 1, never
    takes part; an id with both labels counts as 1. The chosen ids, ``rows`` at most, are broadcast.
    """
    key = F.col("doc_id")
    wanted = materialize(
        labels.where(F.col(label).isin(0, 1) & key.isNotNull() & ~held_out(key))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    totals = {row.label: row.n for row in wanted.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = max(1, rows // 2)
    parts = [
        wanted.where(F.col("label") == kind).orderBy(F.xxhash64(key), key).limit(half)
        .withColumn("weight", F.lit(max(1.0, total / half)))
        for kind, total in sorted(totals.items())
    ]
    if not parts:
        return materialize(docs.select("text", F.lit(0).alias("label"), F.lit(1.0).alias("weight")).limit(0))
    chosen = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return materialize(
        docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label", "weight").distinct()
    )

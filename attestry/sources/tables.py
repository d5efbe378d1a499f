"""Append-only result tables that can be written twice without changing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.functions.values import canonical_hash

VOLATILE = ("created_at", "pipeline_run_id", "generated_at")


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path``, or no rows of the same layout when nothing was written yet."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return like.limit(0)


def with_result_key(result: DataFrame, volatile: Sequence[str] = VOLATILE) -> DataFrame:
    """Add the hash of everything that identifies a result row, without run ids and times."""
    stable = [c for c in result.columns if c not in volatile]
    return result.withColumn("result_key", canonical_hash(*stable))


def split_by_store(
    keyed: DataFrame, stored: DataFrame, identity: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(new, reused, conflicting) rows of a keyed result against the stored ones and each other.

    Equal content is reused; the same identity with other content, stored or in the same batch, is
    a conflict and none of its rows is written.
    """
    identity = list(identity)
    known = stored.select("result_key").distinct()
    taken = stored.select(*identity, F.col("result_key").alias("_stored_key")).distinct()
    reused = keyed.join(known, "result_key", "left_semi")
    unseen = keyed.join(known, "result_key", "left_anti")
    contents = unseen.groupBy(*identity).agg(
        F.min("result_key").alias("_low"), F.max("result_key").alias("_high")
    )
    disputed = (
        taken.select(*identity)
        .unionByName(contents.where("_low <> _high").select(*identity))
        .distinct()
    )
    conflicting = unseen.join(disputed, identity, "left_semi")
    fresh = unseen.join(disputed, identity, "left_anti")
    once = fresh.dropDuplicates([*identity, "result_key"])
    return once, reused, conflicting


def idempotent_append(
    result: DataFrame, path: str, identity: Sequence[str], volatile: Sequence[str] = VOLATILE
) -> tuple[DataFrame, DataFrame]:
    """Append rows whose content is not stored yet; returns (reused, conflicting) rows."""
    keyed = with_result_key(result, volatile)
    stored = read_or_empty(result.sparkSession, path, keyed)
    fresh, reused, conflicting = split_by_store(keyed, stored, identity)
    fresh.write.mode("append").parquet(path)
    return reused, conflicting

"""Positions inside groups of any size, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 1_000


def blocks_for(rows: Column) -> Column:
    """Into how many hash blocks a group of so many rows is cut; it follows the group's size."""
    return F.ceil(rows / F.lit(ROWS_PER_BLOCK)).cast("long")


def numbered(df: DataFrame, group: Sequence[str], blocks: Column, position: str) -> DataFrame:
    """Add a gapless 0-based ``position`` inside each ``group``, in an order given by content.

    Equal rows are merged before anything moves, so a row that fills a third of the table costs one
    row. Each group is cut by a hash of the row into ``blocks`` pieces; a piece is numbered on its
    own and starts where the pieces before it end. Only one total per piece meets the others of its
    group. Equal rows get neighbouring positions, so the result is the same in every run.
    """
    columns = df.columns
    merged = (
        df.withColumn("_block", F.pmod(F.xxhash64(*columns), F.greatest(blocks, F.lit(1))))
        .groupBy(*columns, "_block")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    inside = (
        Window.partitionBy(*group, "_block")
        .orderBy(F.xxhash64(*columns, F.lit(1)), *[F.col(name).asc_nulls_first() for name in columns])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    across = (
        Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = (
        merged.groupBy(*group, "_block")
        .agg(F.sum("_times").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(across), F.lit(0)))
    )
    on = [F.col(f"m.{name}").eqNullSafe(F.col(f"t.{name}")) for name in (*group, "_block")]
    placed = (
        merged.withColumn("_end", F.sum("_times").over(inside))
        .alias("m")
        .join(totals.alias("t"), on)
        .select("m.*", "t._offset")
    )
    first = F.col("_offset") + F.col("_end") - F.col("_times")
    return placed.select(
        *columns, F.explode(F.sequence(first, first + F.col("_times") - 1)).alias(position)
    )

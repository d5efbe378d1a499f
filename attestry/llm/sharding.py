"""Shards by rendezvous hashing of stable record keys."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.ranks import ROWS_PER_BLOCK, numbered


def draw(key: Column, shard: int, weight: float) -> Column:
    """The draw of one shard for a key: exponential with rate ``weight``; the least draw wins."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key among ``len(weights)`` weighted shards; a null key has a shard as well.

    Only the key and the shards' own weights matter. A new shard takes a key from its old shard or
    leaves it there, so growth by one moves about one row in ``n + 1``, and only into the new one.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("at least one shard, and weights above zero")
    draws = [
        F.struct(draw(key, shard, weight).alias("draw"), F.lit(shard).alias("shard"))
        for shard, weight in enumerate(weights)
    ]
    return F.array_min(F.array(*draws)).getField("shard")


def assign_shards(
    docs: DataFrame, weights: Sequence[float] = (1.0,) * 8, next_weight: float = 1.0
) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard, its slot there and its next shard.

    Columns: doc_id, size (UTF-8 bytes plus 1; 1 for a null text), text_crc32 (0 for a null text),
    law (``key``), shard, slot (gapless from 0 in each shard), grown_shard (with one more shard of
    ``next_weight``). A null doc_id is a key like any other. Repeated rows share a shard and have
    neighbouring slots. Other columns are not read; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.col("doc_id")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, (*weights, next_weight)).alias("grown_shard"),
    )
    blocks = F.lit(math.ceil(docs.count() / ROWS_PER_BLOCK)).cast("long")
    return numbered(rows, ["shard"], blocks, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )

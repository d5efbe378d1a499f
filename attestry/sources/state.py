"""State tables of incremental jobs, in buckets of their key.

A batch reads only the buckets that its keys fall into, whatever the table has grown to. Its rows go
to ``<table>/batch_id=N/key_bucket=K``; a commit, written last, lists the live batches of every bucket
of every table. Readers follow the newest commit, so a batch that dies leaves nothing behind, and one
that runs again starts from the commit before it and leaves the same state.

A bucket with many live batches is rewritten as one by the next batch. Folders that neither the last
commit nor the one before names are deleted.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from attestry.session import delete_path
from attestry.sources.tables import read_or_empty

BUCKETS = 64
#: Live batches of a bucket before it is rewritten as one.
MOST_BATCHES = 16
COMMIT = "table string, key_bucket int, batches array<long>, replaced array<long>, buckets int"

Live = dict[str, dict[int, list[int]]]


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass
class Commit:
    """One commit: live batches by table and bucket, and those that it was the first to leave out."""

    batch_id: int | None = None
    buckets: int | None = None
    live: Live = field(default_factory=dict)
    replaced: Live = field(default_factory=dict)
    older: list[int] = field(default_factory=list)


def _newest(spark: SparkSession, target: str, before: int | None) -> Commit:
    """The newest commit (of the batches before ``before``), and the ids of those older than it."""
    like = spark.createDataFrame([], COMMIT).withColumn("batch_id", F.lit(0).cast("long"))
    commits = read_or_empty(spark, f"{target}/commits", like)
    if before is not None:
        commits = commits.where(F.col("batch_id") < before)
    ids = sorted(row.batch_id for row in commits.select("batch_id").distinct().collect())
    if not ids:
        return Commit()
    out = Commit(ids[-1], older=ids[:-1])
    for row in commits.where(F.col("batch_id") == ids[-1]).collect():
        out.buckets = row.buckets
        out.live.setdefault(row.table, {})[row.key_bucket] = list(row.batches)
        out.replaced.setdefault(row.table, {})[row.key_bucket] = list(row.replaced)
    return out


class BatchState:
    """The state as one batch sees and extends it.

    ``batch_id`` None only reads, from the newest commit. The number of buckets is fixed by a
    target's first batch. The driver holds one short list per table and bucket, nothing per key.
    """

    def __init__(
        self, spark: SparkSession, target: str, batch_id: int | None, buckets: int = BUCKETS,
        most_batches: int = MOST_BATCHES,
    ) -> None:
        self.spark, self.target, self.batch_id = spark, target.rstrip("/"), batch_id
        self.before = _newest(spark, self.target, batch_id)
        self.live, self.buckets = self.before.live, self.before.buckets or buckets
        self.most_batches = most_batches
        self.next: Live = {name: dict(tables) for name, tables in self.live.items()}

    def touched(self, keyed: DataFrame, keys: Sequence[str]) -> list[int]:
        """Buckets of the keys of a batch: at most as many numbers as there are buckets."""
        rows = keyed.select(bucket_of(keys, self.buckets).alias("b")).distinct().collect()
        return sorted(row.b for row in rows)

    def read(self, table: str, schema: StructType, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table's rows in ``buckets`` (all without it), as partition filters on the scan."""
        live = self.live.get(table, {})
        wanted = live if buckets is None else {b: live[b] for b in buckets if b in live}
        by_batch: dict[int, list[int]] = defaultdict(list)
        for bucket, batches in wanted.items():
            for batch in batches:
                by_batch[batch].append(bucket)
        if not by_batch:
            return self.spark.createDataFrame([], schema)
        root = f"{self.target}/{table}"
        stored = StructType([*schema.fields]).add("batch_id", LongType()).add("key_bucket", IntegerType())
        rows = (
            self.spark.read.schema(stored).option("basePath", root)
            .parquet(*[f"{root}/batch_id={batch}" for batch in sorted(by_batch)])
        )
        at = reduce(
            Column.__or__,
            [(F.col("batch_id") == n) & F.col("key_bucket").isin(sorted(b)) for n, b in sorted(by_batch.items())],
        )
        return rows.where(at).drop("batch_id", "key_bucket")

    def add(
        self, table: str, rows: DataFrame, keys: Sequence[str],
        fold: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Write this batch's rows; buckets with too many live batches are rewritten with them.

        ``fold`` reduces a rewritten bucket, for instance to the latest row of each key.
        """
        live = self.live.get(table, {})
        full = [bucket for bucket, batches in live.items() if len(batches) >= self.most_batches]
        if full:
            rows = rows.unionByName(self.read(table, rows.schema, full))
            rows = rows if fold is None else fold(rows)
        path = f"{self.target}/{table}/batch_id={self.batch_id}"
        (
            rows.withColumn("key_bucket", bucket_of(keys, self.buckets)).hint("rebalance", "key_bucket")
            .write.mode("overwrite").partitionBy("key_bucket").parquet(path)
        )
        found = self.spark.read.schema(StructType([*rows.schema.fields]).add("key_bucket", IntegerType())).parquet(path)
        after = self.next.setdefault(table, {})
        for row in found.select("key_bucket").distinct().collect():
            older = [] if row.key_bucket in full else live.get(row.key_bucket, [])
            after[row.key_bucket] = [*older, self.batch_id]

    def commit(self) -> None:
        """Make the batch's rows visible, then delete what no commit that may be read still names.

        That is what the commit before had already left out; what this one leaves out stays for a
        batch that runs again.
        """
        rows = [
            (table, bucket, batches, sorted(set(self.live.get(table, {}).get(bucket, [])) - set(batches)), self.buckets)
            for table, live in self.next.items() for bucket, batches in live.items()
        ]
        path = f"{self.target}/commits/batch_id={self.batch_id}"
        self.spark.createDataFrame(rows, COMMIT).coalesce(1).write.mode("overwrite").parquet(path)
        for table, replaced in self.before.replaced.items():
            for bucket, batches in replaced.items():
                for batch in batches:
                    delete_path(self.spark, f"{self.target}/{table}/batch_id={batch}/key_bucket={bucket}")
        for batch in self.before.older:
            delete_path(self.spark, f"{self.target}/commits/batch_id={batch}")

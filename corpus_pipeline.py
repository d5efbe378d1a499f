"""Raw documents to sharded training data, one operator per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from attestry.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from attestry.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic language, by a model fitted on the labelled ones among them."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of every group of near duplicates."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.without_contaminated(docs, items)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.expand(docs, mixing.mix(docs.select("doc_id", "text", "source")))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every row."""
    return sharding.assign_shards(docs.select("doc_id", "text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again before the next.

    A stage's table is deleted once the next one is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done: list[DataFrame] = []
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), instead_of=done)
        done = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)

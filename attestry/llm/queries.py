"""One registered query per corpus operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.llm import (
    class_model, decontaminate, licenses, line_dedup, mixing, ngram_join, quality, secrets, sharding, spelling,
    token_align, toxicity, vector_dedup,
)
from attestry.llm.samples import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


@query
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, _read(spark, folder, "labels").select("doc_id", "quality"))
    return quality.quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


@query
def op3_licenses(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(_read(spark, folder, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.col("matches.license")))
    return found.select(
        "doc_id",
        F.size("matches").cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.array_max("matches.dice").alias("best_dice"),
    )


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _read(spark, folder, "labels").select("doc_id", "toxic"))
    return toxicity.severity(docs, model)


@query
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    applied = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return applied.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op6_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(
        _read(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    )


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign_shards(_read(spark, folder, "documents").select("doc_id", "text"))


@query
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text", F.col("source").alias("path"))
    return secrets.scan_secrets(docs, secrets.train(docs))


@query
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        _read(spark, folder, "documents").select("doc_id", "text"),
        _read(spark, folder, "benchmark").select("item_id", "text"),
    )
    n_hit = decontaminate.words_hit("spans")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents").select("doc_id", "text")
    return spelling.variants(spelling.corpus_words(docs))


#: Vocabulary files of public tokenizers, present on every machine.
TOKENIZERS = "/opt/tokenizers"


@query
def op12_token_align(spark: SparkSession, folder: str) -> DataFrame:
    return token_align.align(
        _read(spark, folder, "documents").select("doc_id", "text"),
        f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model",
    )


@query
def op13_class_model(spark: SparkSession, folder: str) -> DataFrame:
    return class_model.score(_read(spark, folder, "documents").select("doc_id", "text"))

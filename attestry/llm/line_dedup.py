"""Lines that repeat across documents, as one keep bitmap per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.text import BLANKS, ascii_lower
from attestry.session import materialize

SALTS = 64


def _identity(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: doc, text_id, position, h1, h2."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keys = F.transform(F.split(ascii_lower(text), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))
    placed = F.transform(
        keys,
        lambda key, i: F.when(
            F.char_length(key) >= min_chars,
            F.struct(
                i.cast("int").alias("position"),
                F.xxhash64(key).alias("h1"),
                F.hash(key).alias("h2"),
            ),
        ),
    )
    # The identity is part of what is exploded: beside the explode it would be taken once per line.
    row = F.struct(
        F.col("doc_id").alias("doc"), _identity(F.col("text")).alias("text_id"),
        F.array_compact(placed).alias("lines"),
    )
    whole = docs.select(F.explode(F.array(row)).alias("row")).select("row.*")
    return whole.select("doc", "text_id", F.explode("lines").alias("line")).select("doc", "text_id", "line.*")


def first_occurrences(lines: DataFrame, min_docs: int) -> DataFrame:
    """Keys of at least ``min_docs`` documents with the document that keeps them: h1, h2, keeper.

    Lines are counted per key and salt first, so a line that a third of all documents hold brings
    ``SALTS`` rows. These are range-partitioned by hash and sorted by document inside; one pass over
    each partition sees a key's first occurrence and its total.
    """
    per_document = lines.groupBy("h1", "h2", "doc", "text_id").agg(F.min("position"))
    salted = (
        per_document.groupBy("h1", "h2", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).alias("salt"))
        .agg(F.count(F.lit(1)).alias("documents"), F.max("doc").alias("last"))
        .repartitionByRange("h1", "h2")
        .sortWithinPartitions("h1", "h2", F.col("last").desc_nulls_last(), "salt")
    )
    key = Window.partitionBy("h1", "h2")
    order = key.orderBy(F.col("last").desc_nulls_last(), "salt")
    return (
        salted.withColumn("place", F.row_number().over(order))
        .withColumn(
            "total", F.sum("documents").over(order.rowsBetween(0, Window.unboundedFollowing))
        )
        .where((F.col("place") == 1) & (F.col("total") >= min_docs))
        .select("h1", "h2", F.col("last").alias("keeper"))
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: doc, text_id, n_dropped, bitmap.

    A line's key is the line without blanks at its ends, A-Z lower-cased. Keys of ``min_chars`` code
    points in ``min_docs`` documents (rows) stay only in the largest doc_id that holds them; a null
    doc_id is the smallest, and rows that repeat that doc_id all keep the line. ``bitmap`` lists
    64-line words with at least one dropped line: bit p of word w stands for line 64 * w + p, 1 for
    a kept line; words that are not listed keep all lines. Documents without a row keep everything.
    ``text_id`` tells rows with the same doc_id apart; equal rows have equal bitmaps and one row.
    Null and empty texts are one empty line and lose nothing.
    """
    lines = materialize(keyed_lines(docs, min_chars))
    keepers = first_occurrences(lines, min_docs)
    dropped = lines.join(keepers, ["h1", "h2"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    bit = F.expr("shiftleft(1L, position % 64)")
    words = dropped.groupBy("doc", "text_id", F.expr("position div 64").cast("int").alias("word")).agg(
        F.bit_or(bit).alias("lost")
    )
    return words.groupBy("doc", "text_id").agg(
        F.sum(F.bit_count("lost")).cast("long").alias("n_dropped"),
        F.sort_array(
            F.collect_list(F.struct("word", F.bitwise_not("lost").alias("keep")))
        ).alias("bitmap"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every document with its kept text: doc_id, n_lines, n_dropped, kept."""
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
        _identity(F.col("text")).alias("text_id"),
    )
    joined = rows.join(
        bitmaps,
        rows["doc_id"].eqNullSafe(bitmaps["doc"]) & (rows["text_id"] == bitmaps["text_id"]),
        "left",
    ).select("doc_id", "text", "n_dropped", "bitmap")
    # Words that the bitmap leaves out keep all their lines.
    dense = F.expr(
        "flatten(transform(bitmap, (x, i) -> concat("
        "array_repeat(-1L, x.word - if(i = 0, -1, bitmap[i - 1].word) - 1), array(x.keep))))"
    )
    kept = F.expr(
        "array_join(filter(split(text, '\\n', -1), (line, i) -> i div 64 >= size(dense) or"
        " (shiftrightunsigned(dense[cast(i div 64 as int)], i % 64) & 1L) = 1L), '\\n')"
    )
    newlines = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n")))
    return joined.withColumn("dense", F.when(F.col("bitmap").isNotNull(), dense)).select(
        "doc_id",
        (newlines + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("dense").isNull(), F.col("text")).otherwise(kept).alias("kept"),
    )

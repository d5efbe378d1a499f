"""Benchmark passages found in training documents through one FM-index per shard."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attestry.llm.fm_index import FmIndex, build
from attestry.llm.words import SYMBOL_CODES, hash_words, portions, text_bytes, word_table
from attestry.session import materialize

WINDOW = 10
SHARD_BYTES = 4 << 20
PIECE_WORDS = 1 << 16
BLOCK_WORDS = 1 << 19

INDEX_SCHEMA = (
    "shard long, docs array<bigint>, texts array<bigint>, n_words array<int>, vocabulary binary, counts binary,"
    " bits binary, marks binary, samples binary"
)
HIT_SCHEMA = "shard long, place int, starts array<int>, ends array<int>, items array<string>"


def build_index(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: its documents in order, their word counts and the index over their words.

    A shard is a run of documents of one scan task with ``shard_bytes`` of text, or one longer
    document. Nothing is shuffled.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(SYMBOL_CODES)
        number = TaskContext.get().partitionId() << 32
        for portion in portions(batches, "text", shard_bytes):
            words, lengths = hash_words(text_bytes(portion.column("text")), table)
            parts = build(words, lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([portion.column("doc_id").cast(pa.int64()).to_pylist()], pa.list_(pa.int64())),
                    pa.array([portion.column("text_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                    *[pa.array([parts[x]], pa.binary()) for x in ("vocabulary", "counts", "bits", "marks", "samples")],
                ],
                names=["shard", "docs", "texts", "n_words", "vocabulary", "counts", "bits", "marks", "samples"],
            )
            number += 1

    named = docs.select("doc_id", "text", F.xxhash64("text").alias("text_id"))
    return named.mapInArrow(shards, INDEX_SCHEMA)


def phrase_pieces(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Items as word hashes in bounded pieces that overlap by a window less one: block, item_id, words.

    Blocks hold ``BLOCK_WORDS`` words or one piece more; their number follows the benchmark's size.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(SYMBOL_CODES)
        for portion in portions(batches, "text", SHARD_BYTES):
            words, lengths = hash_words(text_bytes(portion.column("text")), table)
            ends = np.cumsum(lengths)
            for item, start, end in zip(portion.column("item_id").to_pylist(), ends - lengths, ends):
                for k, at in enumerate(range(start, end, PIECE_WORDS)):
                    piece = words[at : min(end, at + PIECE_WORDS + window - 1)]
                    if k and len(piece) < window:
                        continue
                    yield pa.RecordBatch.from_pydict(
                        {"item_id": pa.array([item], pa.string()), "piece": pa.array([k], pa.int32()),
                         "n": pa.array([len(piece)], pa.int64()), "words": pa.array([piece.tobytes()], pa.binary())}
                    )

    rows = items.select(F.col("item_id").cast("string"), "text").mapInArrow(
        pieces, "item_id string, piece int, n long, words binary"
    )
    rows = materialize(rows)
    order = Window.orderBy(F.col("item_id").asc_nulls_first(), "piece", F.xxhash64("words"))
    numbered = rows.select(
        "item_id", "piece", "words",
        (F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))).alias("before"),
    )
    return numbered.select(
        F.expr(f"coalesce(before, 0) div {BLOCK_WORDS}").cast("int").alias("block"), "item_id", "words"
    )


def windows_of(rows: list, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a block: distinct ones as (words, start, length), and (window, item) pairs."""
    words, starts, lengths, owners = [], [], [], []
    at = 0
    for k, row in enumerate(rows):
        piece = np.frombuffer(row["words"], "<u8")
        size = min(window, len(piece))
        count = len(piece) - size + 1
        words.append(piece)
        starts.append(at + np.arange(count))
        lengths.append(np.full(count, size))
        owners.append(np.full(count, k))
        at += len(piece)
    return tuple(
        np.concatenate(x) if x else np.zeros(0, kind)
        for x, kind in ((words, np.uint64), (starts, np.int64), (lengths, np.int64), (owners, np.int64))
    )


def search(index: DataFrame, rows: list, window: int = WINDOW) -> DataFrame:
    """Occurrences of the windows of one block: per document the merged spans of words and the items.

    The block is broadcast; its size is bounded by ``BLOCK_WORDS`` and one piece.
    """
    words, starts, lengths, owners = windows_of(rows, window)
    names = np.array([row["item_id"] for row in rows], dtype=object)
    sent = index.sparkSession.sparkContext.broadcast((words, starts, lengths, owners, names))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, starts, lengths, owners, names = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in batch.schema.names}
                n_words = np.asarray(row["n_words"].values, dtype=np.int64)
                fm = FmIndex(n_words, {x: row[x].as_py() for x in ("vocabulary", "counts", "bits", "marks", "samples")})
                low, high = fm.ranges(fm.codes(words), starts, lengths)
                found = np.flatnonzero(high > low)
                if not len(found):
                    continue
                times = high[found] - low[found]
                which = np.repeat(found, times)
                ranks = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low[found], times)
                distinct, back = np.unique(ranks, return_inverse=True)
                at = fm.locate(distinct)[back]
                yield _merged(row["shard"].as_py(), fm.offsets, at, lengths[which], owners[which], names)

    return index.select(
        "shard", "n_words", "vocabulary", "counts", "bits", "marks", "samples"
    ).mapInArrow(hits, HIT_SCHEMA)


def _merged(shard: int, offsets, at, lengths, owners, names) -> pa.RecordBatch:
    """One row per document with hits: touching spans joined, distinct items listed."""
    place = np.searchsorted(offsets, at, side="right") - 1
    start = at - offsets[place]
    order = np.lexsort((start, place))
    place, start, end, owners = place[order], start[order], (start + lengths)[order], owners[order]
    # An end that grows over all documents makes one running maximum serve every document.
    base = place * (1 << 40)
    reach = np.maximum.accumulate(base + end)
    fresh = np.ones(len(place), dtype=bool)
    fresh[1:] = base[1:] + start[1:] > reach[:-1]
    heads = np.flatnonzero(fresh)
    tails = np.append(heads[1:], len(place)) - 1
    doc_of, span_start, span_end = place[heads], start[heads], reach[tails] - base[tails]
    pairs = np.unique(np.stack([place, owners]), axis=1)
    docs, first = np.unique(doc_of, return_index=True)
    bounds = np.append(first, len(doc_of)).astype(np.int32)
    item_bounds = np.searchsorted(pairs[0], np.append(docs, np.iinfo(np.int64).max)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(docs), shard), pa.int64()),
            pa.array(docs.astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(span_start.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(span_end.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(item_bounds), pa.array(list(names[pairs[1]]), pa.string())),
        ],
        names=["shard", "place", "starts", "ends", "items"],
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) what it shares with ``items`` (item_id, text).

    Columns: doc_id, text_id (a hash of the text), n_words, spans (words from start to before end, merged and in order), items
    (distinct item ids as strings, sorted). Words are runs of digits, letters and characters beyond
    ASCII, A-Z lower-cased. A window is ``window`` words of an item in a row, or all words of a
    shorter item. Null and empty texts have no words; items without words match nothing, and items
    with a null id mark spans but are not listed. Repeated rows and documents of any length are
    treated alike; an empty table of documents gives an empty result. The index is written once;
    each bounded block of the benchmark is one pass over it.
    """
    index = materialize(build_index(docs))
    phrases = materialize(phrase_pieces(items, window))
    blocks = phrases.agg(F.max("block")).first()[0]
    found = [
        search(index, phrases.where(F.col("block") == block).collect(), window)
        for block in range(0 if blocks is None else blocks + 1)
    ]
    rows = index.select("shard", F.posexplode(F.arrays_zip("docs", "texts", "n_words"))).select(
        "shard", F.col("pos").alias("place"), F.col("col.docs").alias("doc_id"), F.col("col.texts").alias("text_id"), "col.n_words"
    )
    if not found:
        spans = F.lit(None).cast("array<struct<start: int, end: int>>")
        return rows.select("doc_id", "text_id", "n_words", spans.alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    hits = reduce(DataFrame.unionByName, found).groupBy("shard", "place").agg(
        F.array_sort(F.flatten(F.collect_list(F.arrays_zip(F.col("starts").alias("start"), F.col("ends").alias("end"))))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_compact("items"))))).alias("items"),
    )
    return rows.join(hits, ["shard", "place"], "left").select(
        "doc_id", "text_id", "n_words", "spans", "items"
    )


def words_hit(spans: str) -> Column:
    """Words inside any of the sorted spans."""
    return F.expr(
        f"""
        coalesce(aggregate({spans}, named_struct('total', 0L, 'reach', 0L),
          (a, s) -> named_struct('total', a.total + greatest(0L, s.end - greatest(a.reach, cast(s.start as bigint))),
                                 'reach', greatest(a.reach, cast(s.end as bigint))),
          a -> a.total), 0L)
        """
    )


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that share no window with ``items``, with all their columns."""
    hit = contamination(docs, items, window).where("spans is not null").select(
        F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text")
    ).distinct()
    return docs.join(
        hit, docs["doc_id"].eqNullSafe(hit["_doc"]) & (F.xxhash64(docs["text"]) == hit["_text"]), "left_anti"
    )

"""Words of many texts at once as 64-bit hashes, for use inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
LONG_WORD = 64

BLANK_CODES = (0x20, *range(0x09, 0x0E))
#: Everything ASCII that is neither a digit nor a letter.
SYMBOL_CODES = (*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))


def word_table(separators: Sequence[int]) -> bytes:
    """A byte table: A-Z lower-cased, then separators to blanks. A-Z never separates."""
    table = bytearray(range(256))
    for code in separators:
        table[code] = 0x20
    for code in range(ord("A"), ord("Z") + 1):
        table[code] = code + 32
    return bytes(table)


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values = values * _MIX
    return values ^ (values >> np.uint64(29))


def hash_words(texts: Sequence[bytes], table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the number of words of each text.

    Equal words have equal hashes in every task; different ones differ but for 64-bit chance.
    """
    hashes, counts, _, _ = hash_words_with_heads(texts, table)
    return hashes, counts


def hash_words_with_heads(
    texts: Sequence[bytes], table: bytes
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``hash_words``, with the first eight bytes of every word as a number, and its length."""
    joined = b" ".join(texts).translate(table)
    size = len(joined)
    raw = np.frombuffer(joined + b" " * 8, dtype=np.uint8)
    inside = np.zeros(size + 2, dtype=bool)
    inside[1:-1] = raw[:size] != 0x20
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    eight = np.ndarray((size + 1,), dtype="<u8", buffer=raw.data, strides=(1,))
    left = ends - starts
    long = left.copy()
    heads = eight[starts] & _KEEP[np.minimum(left, 8)]
    hashes = left.astype(np.uint64) * _ODD
    at, rows = starts, np.arange(len(starts))
    long_rows = np.flatnonzero(left > LONG_WORD)
    while len(rows):
        take = np.minimum(left[rows], 8)
        part = eight[at] & _KEEP[take]
        hashes[rows] = mixed((hashes[rows] ^ part) * _ODD)
        left[rows] -= 8
        going = (left[rows] > 0) & (left[rows] + 8 <= LONG_WORD)
        rows, at = rows[going], at[going] + 8
    for row in long_rows:
        hashes[row] = xxhash.xxh64_intdigest(joined[starts[row] : ends[row]])
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    bounds = np.searchsorted(starts, np.cumsum(lengths + 1) - 1)
    return hashes, np.diff(bounds, prepend=0), heads, long


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it has fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        total = mixed((total + words[k : len(words) - size + 1 + k]) * _ODD)
    return total


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def portions(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """Rows in their order, cut so that a portion's texts have ``most_bytes`` or are one row."""
    for batch in batches:
        sizes = np.array([len(x) for x in text_bytes(batch.column(column))], dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            run = np.cumsum(sizes[start:])
            count = max(1, int(np.searchsorted(run, most_bytes, side="right")))
            yield batch.slice(start, count)
            start += count

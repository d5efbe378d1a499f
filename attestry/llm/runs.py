"""Sorted runs of integers as zstd blocks, and rows of a sorted partition as groups."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext

LEVEL = 3


def pack(*arrays: np.ndarray) -> bytes:
    """Integer arrays as one zstd block; bytes of equal rank lie together, as they repeat most."""
    parts = []
    for array in arrays:
        flat = np.ascontiguousarray(array)
        parts.append(len(flat).to_bytes(8, "little"))
        parts.append(flat.view(np.uint8).reshape(len(flat), flat.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=LEVEL).compress(b"".join(parts))


def unpack(block: bytes, *kinds: str) -> list[np.ndarray]:
    """The arrays that ``pack`` took, given their dtypes in order."""
    raw, at, out = zstandard.ZstdDecompressor().decompress(block), 0, []
    for kind in kinds:
        width, count = np.dtype(kind).itemsize, int.from_bytes(raw[at : at + 8], "little")
        end = at + 8 + count * width
        planes = np.frombuffer(raw, np.uint8, count * width, at + 8).reshape(width, count)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at = end
    return out


def ascending(values: np.ndarray) -> np.ndarray:
    """Differences of an ascending array, which compress far better than its values."""
    return np.diff(values, prepend=values[:0].dtype.type(0))


def sums_by_key(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sum of each one's amounts."""
    order = np.argsort(keys, kind="stable")
    keys, amounts = keys[order], amounts[order]
    firsts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ keys.dtype.type(1)))
    return keys[firsts], np.add.reduceat(amounts, firsts) if len(firsts) else amounts


def groups(
    batches: Iterator[pa.RecordBatch], keys: Sequence[str], values: Sequence[str]
) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Consecutive rows with equal keys, as a stream: the keys, then tuples of the values."""
    width = len(keys)
    rows = (
        row
        for batch in batches
        for row in zip(*[batch.column(name).to_pylist() for name in (*keys, *values)])
    )
    for key, members in itertools.groupby(rows, key=lambda row: row[:width]):
        yield key, (row[width:] for row in members)


class Portions:
    """Numbers for the portions of a task that no other task of the stage gives."""

    def __init__(self) -> None:
        self.next = (TaskContext.get().partitionId() << 40) - 1

    def __call__(self) -> int:
        self.next += 1
        return self.next

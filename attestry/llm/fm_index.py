"""A word-level FM-index over one shard of documents: numpy arrays built and searched in a task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

SAMPLE_EVERY = 8


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the last code must occur once.

    Several codes are packed into the first key, so only suffixes that repeat for that long are
    sorted again, each round by twice the length.
    """
    n = len(codes)
    bits = max(1, int(codes.max()).bit_length())
    depth = max(1, 63 // bits)
    key = np.zeros(n, dtype=np.int64)
    for k in range(depth):
        key = (key << bits) | np.roll(codes, -k)
    order = np.argsort(key, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    slots, sorted_key = np.arange(n), key[order]
    while True:
        new = np.ones(len(slots), dtype=bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, len(slots)))
        rank[order[slots]] = np.repeat(slots[heads], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        if not len(slots) or depth >= n:
            return order
        suffixes = order[slots]
        sorted_key = (rank[suffixes] << 32) | rank[(suffixes + depth) % n]
        again = np.argsort(sorted_key, kind="stable")
        order[slots], sorted_key = suffixes[again], sorted_key[again]
        depth *= 2


@dataclass
class WaveletMatrix:
    """Ranks of any code in a sequence, one bit vector per bit of the codes."""

    words: np.ndarray  # levels x 64-bit words
    before: np.ndarray  # ones before each word
    zeros: np.ndarray  # per level
    first: np.ndarray  # per code: where it starts on the lowest level

    @staticmethod
    def bit_words(codes: np.ndarray, levels: int) -> np.ndarray:
        """The bit vectors of all levels, highest bit first."""
        n_words = len(codes) // 64 + 1
        out = np.zeros((levels, n_words * 8), dtype=np.uint8)
        for row in range(levels):
            bit = ((codes >> (levels - 1 - row)) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            out[row, : len(packed)] = packed
            codes = np.concatenate([codes[~bit], codes[bit]])
        return out.view("<u8")

    @classmethod
    def load(cls, words: np.ndarray, counts: np.ndarray) -> WaveletMatrix:
        levels, n = len(words), int(counts.sum())
        ones = np.bitwise_count(words).astype(np.int64)
        before = np.zeros((levels, words.shape[1]), dtype=np.int64)
        np.cumsum(ones[:, :-1], axis=1, out=before[:, 1:])
        zeros = n - ones.sum(axis=1)
        turned = np.zeros(len(counts), dtype=np.int64)
        for level in range(levels):
            turned = (turned << 1) | ((np.arange(len(counts)) >> level) & 1)
        by_turned = np.argsort(turned)
        first = np.empty(len(counts), dtype=np.int64)
        first[by_turned] = np.cumsum(counts[by_turned]) - counts[by_turned]
        return cls(words, before, zeros, first)

    def _ones(self, row: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[row, word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[row, word] + np.bitwise_count(below)

    def rank(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each code occurs before its position."""
        levels = len(self.words)
        for row in range(levels):
            ones = self._ones(row, at)
            bit = (codes >> (levels - 1 - row)) & 1
            at = np.where(bit == 1, self.zeros[row] + ones, at - ones)
        return at - self.first[codes]

    def code_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The code at each position, and how often it occurs before."""
        codes = np.zeros(len(at), dtype=np.int64)
        for row in range(len(self.words)):
            bit = ((self.words[row, at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            ones = self._ones(row, at)
            codes = (codes << 1) | bit
            at = np.where(bit == 1, self.zeros[row] + ones, at - ones)
        return codes, at - self.first[codes]


def build(words: np.ndarray, lengths: np.ndarray) -> dict[str, bytes]:
    """The index of the documents whose word hashes stand one after the other in ``words``.

    Every document ends with a code of its own, so no match crosses documents. Parts: ``vocabulary``
    (hash per code after the document ends), ``counts`` per code, ``bits`` of the transform's
    wavelet matrix, ``marks`` of the sampled suffixes and their positions ``samples``.
    """
    docs = len(lengths)
    coded, vocabulary = pd.factorize(words)
    ends = np.cumsum(lengths)
    codes = np.insert(coded.astype(np.int64) + docs, ends, np.arange(docs))
    order = suffix_array(codes)
    counts = np.bincount(codes, minlength=docs + len(vocabulary))
    levels = max(1, int(len(counts) - 1).bit_length())
    sampled = order % SAMPLE_EVERY == 0
    marks = np.zeros((len(codes) // 64 + 1) * 8, dtype=np.uint8)
    packed = np.packbits(sampled, bitorder="little")
    marks[: len(packed)] = packed
    return {
        "vocabulary": np.ascontiguousarray(vocabulary, dtype="<u8").tobytes(),
        "counts": counts.astype("<i4").tobytes(),
        "bits": WaveletMatrix.bit_words(codes[order - 1], levels).tobytes(),
        "marks": marks.tobytes(),
        "samples": order[sampled].astype("<i4").tobytes(),
    }


class FmIndex:
    def __init__(self, lengths: np.ndarray, parts: dict[str, bytes]):
        self.docs = len(lengths)
        vocabulary = np.frombuffer(parts["vocabulary"], "<u8")
        self.by_hash = np.argsort(vocabulary)
        self.sorted_hashes = vocabulary[self.by_hash]
        counts = np.frombuffer(parts["counts"], "<i4").astype(np.int64)
        self.starts = np.append(0, np.cumsum(counts))
        levels = max(1, int(len(counts) - 1).bit_length())
        self.matrix = WaveletMatrix.load(
            np.frombuffer(parts["bits"], "<u8").reshape(levels, -1), counts
        )
        self.marks = WaveletMatrix.load(
            np.frombuffer(parts["marks"], "<u8").reshape(1, -1), np.array([counts.sum(), 0])
        )
        self.samples = np.frombuffer(parts["samples"], "<i4").astype(np.int64)
        #: Where documents start in the indexed sequence, which holds their ends as well.
        self.offsets = np.append(0, np.cumsum(lengths + 1))

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Codes of word hashes; -1 where the shard lacks the word."""
        if not len(self.sorted_hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.sorted_hashes, hashes), len(self.sorted_hashes) - 1)
        return np.where(self.sorted_hashes[at] == hashes, self.by_hash[at] + self.docs, -1)

    def ranges(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """Suffix ranges of the phrases ``codes[start : start + length]``, last word first."""
        last = codes[starts + lengths - 1]
        low = np.where(last >= 0, self.starts[last], 0)
        high = np.where(last >= 0, self.starts[last + 1], 0)
        for step in range(2, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= step) & (high > low))
            code = codes[starts[live] + lengths[live] - step]
            high[live[code < 0]] = low[live[code < 0]]
            live, code = live[code >= 0], code[code >= 0]
            if not len(live):
                continue
            low[live] = self.starts[code] + self.matrix.rank(code, low[live])
            high[live] = self.starts[code] + self.matrix.rank(code, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: back through the text until a sampled one."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            at = rows[open_]
            marked = (self.marks.words[0, at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            done = at[marked]
            found[open_[marked]] = self.samples[self.marks._ones(0, done)] + steps
            open_, at = open_[~marked], at[~marked]
            code, before = self.matrix.code_and_rank(at)
            rows = rows.copy()
            rows[open_] = self.starts[code] + before
            steps += 1
        return found

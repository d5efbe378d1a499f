"""Which tokens of two tokenizers stand for the same bytes, and how often over the corpus.

External spill counting. A scan task cuts its documents into portions, finds each portion's distinct
records (token pair, document) and writes them radix-partitioned by the side A id: sorted zstd runs
of pairs with their numbers of documents, and the records themselves, which stay with the portion.
Runs of one radix are merged by a heap, a bounded number at a time, until one is left. Its order is
A-major, so an id's largest count is known as soon as the id ends. The counts then go back to every
run in the order of its pairs, and a portion turns them into the figures of its documents.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.runs import Portions, ascending, groups, pack, sums_by_key, unpack
from attestry.llm.words import portions
from attestry.session import materialize

PORTION_BYTES = 2 << 20
RADIX_BITS, B_BITS, DOC_BITS = 8, 20, 20
#: Runs that one task merges at once; more runs take more passes.
FAN_IN = 1024
#: Pairs that a merge holds before it gives out what is complete, and pairs of a written run's block.
HELD_PAIRS, BLOCK_PAIRS = 1 << 20, 1 << 16
#: A group with more links is counted by its distinct ids, not link by link.
LINKS_AT_ONCE = 1 << 12
LONG_BLANK = re.compile(r"\s{400}")

# The split pattern and the printable bytes of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = (*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100))


class ByteBpe:
    """A byte-level BPE file; ids of texts, and the bytes of every id.

    Where the file's merges rank as its ids and it splits by ``PATTERN``, texts take a faster encoder
    with the same results; long runs of blanks, which that one can't take, go to the file's own.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        others = [code for code in range(256) if code not in PRINTABLE]
        codes = {chr(code): code for code in PRINTABLE} | {chr(256 + k): code for k, code in enumerate(others)}
        special = {x["id"]: x["content"] for x in content["added_tokens"]}
        vocabulary = content["model"]["vocab"]
        size = max([*vocabulary.values(), *special]) + 1
        self.bytes = [b""] * size
        for piece, number in vocabulary.items():
            if number not in special:
                self.bytes[number] = bytes(codes[c] for c in piece)
        for number, text in special.items():
            self.bytes[number] = text.encode()
        merges = [x.split(" ") if isinstance(x, str) else x for x in content["model"]["merges"]]
        ranks = [vocabulary[left + right] for left, right in merges]
        single = [number for piece, number in vocabulary.items() if len(piece) == 1]
        split = content["pre_tokenizer"]
        ranked = (
            ranks == sorted(ranks) and single and max(single) < min(ranks, default=size)
            and content["normalizer"] is None and split["type"] == "ByteLevel"
            and split["use_regex"] and not split["add_prefix_space"]
        )
        self.fast = None
        if ranked:
            import tiktoken

            self.fast = tiktoken.Encoding(
                "given", pat_str=PATTERN, special_tokens={},
                mergeable_ranks={self.bytes[n]: n for n in vocabulary.values() if n not in special},
            )

    def encode(self, text: str) -> list[int]:
        if self.fast is None or LONG_BLANK.search(text):
            return self.own.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceBpe:
    """A sentence-piece file, which puts a space before a text; ids of texts, bytes of every id."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.own = SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(self.own.id_to_piece(k)[3:5], 16)]) if self.own.is_byte(k)
            else self.own.id_to_piece(k).replace("▁", " ").encode()
            for k in range(self.own.get_piece_size())
        ]

    def encode(self, text: str) -> list[int]:
        return self.own.encode(text, num_threads=1)


@functools.cache
def _sides(a_path: str, b_path: str) -> "Sides":
    return Sides(ByteBpe(a_path), PieceBpe(b_path))


class Sides:
    """Both tokenizers and the tables by which a portion is aligned at once."""

    def __init__(self, a: ByteBpe, b: PieceBpe) -> None:
        self.a, self.b = a, b
        if len(b.bytes) > 1 << B_BITS or len(a.bytes) > 1 << (64 - B_BITS - DOC_BITS - 1):
            raise ValueError("a vocabulary is too large for the pair keys")
        self.lengths = [np.array([len(x) for x in side.bytes], np.int64) for side in (a, b)]
        ids_a, ids_b = ([str(k).encode() for k in range(len(side.bytes))] for side in (a, b))
        written = [x + end for ids, ends in ((ids_a, (b",", b"|")), (ids_b, (b",", b";", b""))) for end in ends for x in ids]
        self.written = np.array(written, dtype=object)
        self.written_lengths = np.array([len(x) for x in written], np.int64)

    def tokens(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per side the ids of all texts in order, and their number per text; odd texts have none."""
        ids, counts = ([], []), np.zeros((2, len(texts)), np.int64)
        for k, text in enumerate(texts):
            if not text:
                continue
            spaced = " " + text
            found = self.a.encode(spaced), self.b.encode(text)
            expected = spaced.encode()
            if all(b"".join(map(side.bytes.__getitem__, x)) == expected for side, x in zip((self.a, self.b), found)):
                for side, x in enumerate(found):
                    ids[side].append(np.array(x, np.int64))
                    counts[side, k] = len(x)
        none = [np.zeros(0, np.int64)]
        return [np.concatenate(x or none) for x in ids], list(counts)


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between ascending ``bounds`` (ends, one per text)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[bounds], prepend=0)


class Aligned:
    """The groups of a portion's texts: common ends of both sides cut the tokens."""

    def __init__(self, sides: Sides, texts: list[str | None]) -> None:
        self.sides = sides
        (self.a, self.b), (self.n_a, self.n_b) = sides.tokens(texts)
        ends_a, ends_b = (np.cumsum(n[x]) for n, x in zip(sides.lengths, (self.a, self.b)))
        size = int(ends_a[-1]) if len(ends_a) else 0
        marks = np.zeros(size + 1, np.uint8)
        marks[ends_a] = 1
        marks[ends_b] |= 2
        last_a, last_b = (np.flatnonzero(marks[x] == 3) for x in (ends_a, ends_b))
        self.p, self.q = (np.diff(x, prepend=-1) for x in (last_a, last_b))
        self.until_a, self.until_b = last_a + 1, last_b + 1
        self.text_of_group_end = np.searchsorted(last_a, np.cumsum(self.n_a), side="left")
        self.n_groups = np.diff(self.text_of_group_end, prepend=0)
        self.n_links = _per_text(self.p * self.q, self.text_of_group_end)

    def digests(self) -> list[str]:
        """sha256 of every text's groups in writing; '' without tokens."""
        vocabulary_a, vocabulary_b = len(self.sides.a.bytes), len(self.sides.b.bytes)
        order = np.empty(len(self.a) + len(self.b), np.int64)
        ids_a, ids_b = self.a.copy(), self.b + 2 * vocabulary_a
        ids_a[self.until_a - 1] += vocabulary_a
        ids_b[self.until_b - 1] += vocabulary_b
        spoken = np.cumsum(self.n_b)[self.n_b > 0]
        ids_b[spoken - 1] += vocabulary_b
        order[np.arange(len(ids_a)) + np.repeat(self.until_b - self.q, self.p)] = ids_a
        order[np.arange(len(ids_b)) + np.repeat(self.until_a, self.q)] = ids_b
        joined = memoryview(b"".join(self.sides.written[order].tolist()))
        ends = np.concatenate([[0], np.cumsum(self.sides.written_lengths[order])])[np.cumsum(self.n_a + self.n_b)]
        starts = np.concatenate([[0], ends[:-1]])
        return [
            hashlib.sha256(joined[x:y]).hexdigest() if n else ""
            for x, y, n in zip(starts.tolist(), ends.tolist(), self.n_a.tolist())
        ]

    def records(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (pair, text) keys in order, and how many links each stands for."""
        text = np.repeat(np.arange(len(self.n_a)), self.n_groups)
        links = self.p * self.q
        small = links <= LINKS_AT_ONCE
        p, q, text_small = self.p[small], self.q[small], text[small]
        start_a, start_b = (self.until_a - self.p)[small], (self.until_b - self.q)[small]
        times = p * q
        group = np.repeat(np.arange(len(p)), times)
        inside = np.arange(len(group)) - np.repeat(np.cumsum(times) - times, times)
        step = q[group]
        keys = _keys(self.a[start_a[group] + inside // step], self.b[start_b[group] + inside % step], text_small[group])
        keys.sort()
        firsts = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
        keys, counts = keys[firsts], np.diff(firsts, append=len(keys))
        if small.all():
            return keys, counts
        all_keys, all_counts = [keys], [counts]
        for g in np.flatnonzero(~small):
            a, times_a = np.unique(self.a[self.until_a[g] - self.p[g] : self.until_a[g]], return_counts=True)
            b, times_b = np.unique(self.b[self.until_b[g] - self.q[g] : self.until_b[g]], return_counts=True)
            all_keys.append(_keys(np.repeat(a, len(b)), np.tile(b, len(a)), np.full(len(a) * len(b), text[g])))
            all_counts.append(np.outer(times_a, times_b).reshape(-1))
        return sums_by_key(np.concatenate(all_keys), np.concatenate(all_counts))


def _keys(a: np.ndarray, b: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Radix (low bits of a), the rest of a, b, text: ascending keys are A-major inside a radix."""
    radix, rest = a & ((1 << RADIX_BITS) - 1), a >> RADIX_BITS
    high = (radix << (63 - B_BITS - DOC_BITS - RADIX_BITS)) | rest
    return ((high << B_BITS | b) << DOC_BITS | text).astype(np.uint64)


def _radix(pairs: np.ndarray) -> np.ndarray:
    return (pairs >> np.uint64(63 - DOC_BITS - RADIX_BITS)).astype(np.int64)


SPILLED = "portion long, radix int, first long, run binary, rest binary"
TEXT_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def spill(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per portion its sorted runs by radix, and one row (radix -1) with its records and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, sides = Portions(), _sides(a_path, b_path)
        for portion in portions(batches, "text", PORTION_BYTES):
            for at in range(0, portion.num_rows, 1 << DOC_BITS):
                yield from _spilled(number(), portion.slice(at, 1 << DOC_BITS), sides)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, SPILLED)


def _text(raw: bytes | None) -> str | None:
    """None also for bytes that are no UTF-8."""
    try:
        return None if raw is None else raw.decode()
    except UnicodeDecodeError:
        return None


def _spilled(portion: int, rows: pa.RecordBatch, sides: Sides) -> Iterator[pa.RecordBatch]:
    aligned = Aligned(sides, [_text(x) for x in rows.column("text").to_pylist()])
    figures = pa.table({
        "doc_id": rows.column("doc_id"),
        **{name: getattr(aligned, name) for name in TEXT_FIGURES},
        "groups_sha256": aligned.digests(),
    })
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, figures.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(figures)
    keys, links = aligned.records()
    pairs = keys >> np.uint64(DOC_BITS)
    firsts = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] ^ np.uint64(1)))
    holders = np.diff(firsts, append=len(pairs))
    text = (keys & np.uint64((1 << DOC_BITS) - 1)).astype(np.uint32)
    rest = len(sink.getvalue()).to_bytes(8, "little") + sink.getvalue().to_pybytes() + pack(
        text, links.astype(np.uint64), holders.astype(np.uint32)
    )
    pairs = pairs[firsts]
    radix = _radix(pairs)
    out = [(portion, -1, 0, None, rest)]
    cuts = np.flatnonzero(np.diff(radix, prepend=-1))
    for start, end in zip(cuts, np.append(cuts[1:], len(pairs))):
        for x in range(start, end, BLOCK_PAIRS):
            part = slice(x, min(end, x + BLOCK_PAIRS))
            block = pack(ascending(pairs[part]), holders[part].astype(np.uint64))
            out.append((portion, int(radix[x]), int(pairs[x]), block, None))
    names = ("portion", "radix", "first", "run", "rest")
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)


def _read_run(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = unpack(block, "<u8", "<u8")
    return np.cumsum(steps, dtype=np.uint64), counts


def merged_runs(blocks: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted pairs and their summed counts from blocks (first pair, run) in the order of first pairs.

    A heap holds the open blocks by their next pair. Pairs below the first one of the block that comes
    next are complete; they are given out when more than ``HELD_PAIRS`` are held.
    """
    heap, held, ties = [], 0, 0
    for first, block in blocks:
        if held > HELD_PAIRS and heap[0][0] < first:
            ready = _taken(heap, first)
            held -= sum(len(x) for x, _ in ready)
            yield sums_by_key(*map(np.concatenate, zip(*ready)))
        pairs, counts = _read_run(block)
        ties, held = ties + 1, held + len(pairs)
        heapq.heappush(heap, (first, ties, pairs, counts))
    if heap:
        yield sums_by_key(*map(np.concatenate, zip(*_taken(heap, None))))


def _taken(heap: list, until: int | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Take from the heap's blocks what lies below ``until``; what is left goes back."""
    out = []
    while heap and (until is None or heap[0][0] < until):
        _, tie, pairs, counts = heapq.heappop(heap)
        cut = len(pairs) if until is None else int(np.searchsorted(pairs, np.uint64(until)))
        out.append((pairs[:cut], counts[:cut]))
        if cut < len(pairs):
            heapq.heappush(heap, (int(pairs[cut]), tie, pairs[cut:], counts[cut:]))
    return out


def _with_maxima(
    stream: Iterator[tuple[np.ndarray, np.ndarray]]
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same pairs, with twice the count, plus one where it is its A id's largest.

    The last A id of a part may go on in the next; at most one id's pairs wait.
    """
    kept = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    for part in (*stream, None):
        pairs, counts = kept if part is None else map(np.concatenate, zip(kept, part))
        sides = pairs >> np.uint64(B_BITS)
        ends = len(pairs) if part is None else int(np.searchsorted(sides, sides[-1]))
        kept = pairs[ends:], counts[ends:]
        pairs, counts, sides = pairs[:ends], counts[:ends], sides[:ends]
        if ends:
            firsts = np.flatnonzero(np.diff(sides, prepend=sides[:1] ^ np.uint64(1)))
            largest = np.repeat(np.maximum.reduceat(counts, firsts), np.diff(firsts, append=ends))
            yield pairs, counts * np.uint64(2) + (counts == largest).astype(np.uint64)


MERGED = "radix int, part long, first long, run binary"


def _merge(runs: DataFrame, parts: int, last: bool) -> DataFrame:
    """Merge the runs (radix, part, first, run) of each radix into ``parts`` runs, the last into one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("radix", "part", "first", "run")
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        for (radix, part), blocks in groups(batches, ("radix", "part"), ("first", "run")):
            stream = merged_runs(blocks)
            for pairs, counts in _with_maxima(stream) if last else stream:
                for at in range(0, len(pairs), BLOCK_PAIRS):
                    piece = slice(at, at + BLOCK_PAIRS)
                    row = radix, part, int(pairs[at]), pack(ascending(pairs[piece]), counts[piece])
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

    sliced = runs.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts)))
    return (
        sliced.repartition("radix", "part").sortWithinPartitions("radix", "part", "first")
        .select("radix", "part", "first", "run").mapInArrow(run, MERGED)
    )


def count_pairs(spilled: DataFrame) -> DataFrame:
    """One run per radix with the corpus count of every pair, A-major, maxima marked.

    The number of passes follows the number of runs: each pass leaves one run of ``FAN_IN``.
    """
    runs = spilled.where("radix >= 0").select("radix", F.col("portion").alias("part"), "first", "run")
    count = spilled.where("radix = -1").count()
    while True:
        parts = max(1, math.ceil(count / FAN_IN))
        runs = materialize(_merge(runs, parts, last=parts == 1))
        if parts == 1:
            return runs.select("radix", "first", "run")
        count = parts


def _send_back(spilled: DataFrame, counted: DataFrame) -> DataFrame:
    """For every run of a portion the marked corpus counts of its pairs, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ("portion", "radix", "first", "back"), (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        for (radix, _), rows in groups(batches, ("radix", "part"), ("portion", "first", "run")):
            whole, pairs, counts = [], None, None
            for portion, first, block in rows:
                if portion is None:
                    whole.append(_read_run(block))
                    continue
                if pairs is None:
                    pairs, counts = map(np.concatenate, zip(*whole))
                at = np.searchsorted(pairs, _read_run(block)[0])
                row = portion, radix, first, pack(counts[at])
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)

    runs = spilled.where("radix >= 0")
    parts = max(1, math.ceil(spilled.where("radix = -1").count() / FAN_IN))
    portion_part = F.pmod(F.xxhash64("portion"), F.lit(parts))
    both = runs.select("radix", portion_part.alias("part"), "portion", "first", "run").unionByName(
        counted.select(
            "radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
            F.lit(None).cast("long").alias("portion"), "first", "run",
        )
    )
    return (
        both.repartition("radix", "part")
        .sortWithinPartitions("radix", "part", F.col("portion").asc_nulls_first(), "first")
        .mapInArrow(run, "portion long, radix int, first long, back binary")
    )


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string"
)


def _finish(spilled: DataFrame, back: DataFrame) -> DataFrame:
    """The figures of every document from its portion's records and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in groups(batches, ("portion",), ("rest", "back")):
            (rest, _), *others = rows
            head = int.from_bytes(rest[:8], "little")
            figures = pa.ipc.open_stream(rest[8 : 8 + head]).read_all()
            text, links, holders = unpack(rest[8 + head :], "<u4", "<u8", "<u4")
            marked = [unpack(block, "<u8")[0] for _, block in others]
            marked = np.repeat(np.concatenate([np.zeros(0, np.uint64), *marked]), holders)
            links = links.astype(np.int64)
            best, total = np.zeros((2, figures.num_rows), np.int64)
            np.add.at(best, text, links * (marked & np.uint64(1)).astype(np.int64))
            np.add.at(total, text, links * (marked >> np.uint64(1)).astype(np.int64))
            columns = {name: figures.column(name) for name in figures.column_names}
            digests = columns.pop("groups_sha256")
            yield from pa.table(
                {**columns, "n_best": best, "count_sum": total, "groups_sha256": digests}
            ).to_batches()

    nothing = F.lit(None).cast("binary")
    rest = spilled.where("radix = -1").select("portion", "radix", "first", "rest", nothing.alias("back"))
    return (
        rest.unionByName(back.select("portion", "radix", "first", nothing.alias("rest"), "back"))
        .repartition("portion").sortWithinPartitions("portion", "radix", "first")
        .select("portion", "rest", "back").mapInArrow(run, ALIGNED)
    )


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document the alignment of two tokenizers' tokens and how common its links are.

    ``a_path`` is a byte-level BPE file, encoding a space and the text; ``b_path`` a sentence-piece
    file, which adds the space itself. Special tokens' strings are plain text. Places where tokens of
    both sides end cut them into groups; all pairs inside a group are linked. The count of a pair is
    the number of documents (rows) that hold it linked. ``n_best`` counts links whose pair has the
    largest count of its A id (ties included), ``count_sum`` adds the counts of all links, and
    ``groups_sha256`` hashes the groups written as ``a1,a2|b1;a3|b2,b3``.

    Texts that are null, empty, no UTF-8, or that either side's tokens don't spell out byte for byte
    have no tokens: zeros and ''. Repeated rows count as documents of their own. Other columns are
    ignored; no documents give no rows.
    """
    spilled = materialize(spill(docs, a_path, b_path))
    return _finish(spilled, _send_back(spilled, count_pairs(spilled)))

"""Secrets in texts: candidates by pattern, false findings removed by a random forest."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.words import portions, text_bytes
from attestry.session import materialize

PORTION_BYTES, COUNTED_BYTES = 8 << 20, 1 << 20
LEAST_LENGTH = 16
#: What the forest is fitted on: so many different values at most of each stratum of the findings of all documents.
STRATUM_FINDINGS = 2_000
FORMAT, NAMED, HARD, PLAIN = "format", "named", "hard", "plain"
TREES, DEPTH, LEAF_ROWS = 40, 8, 3
NEAR_BYTES = 40
FOUR_GRAMS = 4_096

CANDIDATE = re.compile(rb"(?<![0-9A-Za-z+/_\-])[0-9A-Za-z+/_\-]{%d,}(?![0-9A-Za-z+/_\-])" % LEAST_LENGTH)
#: Words before a value that name a secret, and formats that only keys have (fixed values).
_NAME = (
    rb"(?:pass(?:word|wd|phrase)?|pwd|(?<![a-z0-9])pw|token|secret|api[_-]?key|access[_-]?key|credential)s?"
    rb"[\"']?\s{0,3}(?::=|[:=]=?=?>?)\s{0,3}"
)
NAMING = re.compile(rb"(?i)" + _NAME + rb"[\"']?$")
#: On lower-cased texts that hold one of the parts.
_NAME_PARTS, _NAMED = (b"pass", b"pw", b"token", b"secret", b"key", b"credential"), re.compile(_NAME)
_NAMED_VALUE = re.compile(rb"\"(?P<a>[^\"\r\n]+)\"|'(?P<b>[^'\r\n]+)'|[\"']?(?P<c>[^\s\"']+)")
_CHUNK = re.compile(rb"[^\s\"'<>]+")
#: A password ends at the last @ of the authority; one that holds a slash at the first @.
_PASSWORD = rb":(?!//)(?P<a>[^/?#]+@|(?:(?!://)[^@])+@)(?=[0-9A-Za-z\[_\x80-\xFF])"
_IN_URL, _AFTER_USER = re.compile(rb"://[^/?#@:]*" + _PASSWORD), re.compile(rb"[^/?#@:]+" + _PASSWORD)
_URL_USER = re.compile(rb"://[^\s/?#@:\"'<>]*:$")
_FORMAT = rb"(?:A(?:KI|SI)A[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36,}|xox[abprs]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_-]{35})"
FORMATS = re.compile(rb"^" + _FORMAT + rb"$")
_FORMAT_PARTS = (b"AKIA", b"ASIA", b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_", b"xox", b"sk_live_", b"AIza")
_FORMAT_RUN = re.compile(rb"(?<![0-9A-Za-z])" + _FORMAT + rb"(?![0-9A-Za-z])")
SAMPLE_WORDS = re.compile(rb"(?i)example|sample|dummy|placeholder|test|xxxx|your")

FEATURES = (
    "length", "digits", "upper", "lower", "symbols", "kinds", "kind_changes", "entropy", "transition",
    "dictionary", "longest_letters", "hexadecimal", "named_before", "assigned_before", "quoted",
    "sample_word", "word_before", "word_after", "path_depth", "path_sample_word", "url_password",
)

_KIND = np.full(256, 3, dtype=np.int64)
_KIND[ord("0") : ord("9") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("a") : ord("z") + 1] = 2
_SLOT = np.full(256, 37, dtype=np.int64)
for _code in range(26):
    _SLOT[ord("a") + _code] = _SLOT[ord("A") + _code] = _code
for _code in range(10):
    _SLOT[ord("0") + _code] = 26 + _code
_LETTERS = re.compile(rb"[A-Za-z]+")


@dataclass(frozen=True)
class Language:
    """How likely one character follows another in plain words, and their frequent four-letter runs."""

    transitions: np.ndarray
    four_grams: frozenset

    @classmethod
    def of(cls, counts: np.ndarray, four_grams: list[bytes]) -> Language:
        smooth = counts + 0.5
        return cls(np.log(smooth / smooth.sum(axis=1, keepdims=True)), frozenset(four_grams))


def describe(text: bytes, start: int, end: int, path: str, language: Language) -> list[float]:
    """The ``FEATURES`` of one candidate."""
    value = text[start:end]
    raw = np.frombuffer(value, np.uint8)
    kinds, slots = _KIND[raw], _SLOT[raw]
    times = np.bincount(raw)
    shares = times[times > 0] / len(raw)
    of_kind = np.bincount(kinds, minlength=4) / len(raw)
    low = value.lower()
    covered = np.zeros(len(low), dtype=bool)
    for k in range(len(low) - 3):
        if low[k : k + 4] in language.four_grams:
            covered[k : k + 4] = True
    before, after = text[max(0, start - NEAR_BYTES) : start], text[end : end + NEAR_BYTES]
    path_bytes = path.encode()
    return [
        len(raw), of_kind[0], of_kind[1], of_kind[2], of_kind[3], float((of_kind > 0).sum()),
        float((kinds[1:] != kinds[:-1]).sum() / max(1, len(raw) - 1)), float(-(shares * np.log2(shares)).sum()),
        float(language.transitions[slots[:-1], slots[1:]].sum() / max(1, len(raw) - 1)), float(covered.mean()),
        float(max((len(x) for x in _LETTERS.findall(value)), default=0)),
        float(re.fullmatch(rb"[0-9a-f]+|[0-9A-F]+", value) is not None),
        float(NAMING.search(before) is not None), float(re.search(rb"[:=]\s{0,3}[\"']?$", before) is not None),
        float(before[-1:] in (b'"', b"'")), float(SAMPLE_WORDS.search(value) is not None),
        float(re.search(rb"[a-z]{2,}\s$", before) is not None), float(re.match(rb"[\"']?\s[a-z]{2,}", after) is not None),
        float(path.count("/")), float(SAMPLE_WORDS.search(path_bytes) is not None),
        float(after[:1] == b"@" and _URL_USER.search(before) is not None),
    ]


def rule_label(text: bytes, start: int, end: int) -> int | None:
    """The label of a sample finding: 1 for key formats and named or URL values with digits, 0 for plain words.

    None leaves a finding out of the fit. Used where no reviewed findings are given.
    """
    value = text[start:end]
    before = text[max(0, start - NEAR_BYTES) : start]
    if SAMPLE_WORDS.search(value):
        return 0
    if FORMATS.match(value):
        return 1
    mixed_kinds = re.search(rb"[0-9]", value) is not None and re.search(rb"[A-Za-z]", value) is not None
    in_url = text[end : end + 1] == b"@" and _URL_USER.search(before) is not None
    if in_url or NAMING.search(before):
        return 1 if mixed_kinds else None if re.search(rb"[^0-9A-Za-z+/_\-]", value) else 0
    return None if mixed_kinds else 0


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: feature (-1 in a leaf), cut, children, share of secrets."""

    language: Language
    trees: tuple

    def score(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values))
        for feature, cut, low, high, share in self.trees:
            node = np.zeros(len(values), dtype=np.int64)
            for _ in range(DEPTH + 1):
                inner = np.flatnonzero(feature[node] >= 0)
                if not len(inner):
                    break
                at = node[inner]
                node[inner] = np.where(values[inner, feature[at]] <= cut[at], low[at], high[at])
            total += share[node]
        return total / max(1, len(self.trees))


def grow_forest(values: np.ndarray, label: np.ndarray, language: Language, seed: int = 7) -> Forest:
    """Bootstrap trees by Gini impurity, each split over a random part of the features.

    Every bootstrap takes half its rows from each class, so a single secret weighs as much as all false findings.
    """
    classes = [x for x in (np.flatnonzero(label < 0.5), np.flatnonzero(label >= 0.5)) if len(x)]
    rng = np.random.default_rng(seed)
    part = max(2, int(np.sqrt(values.shape[1])) + 1)
    trees = []
    for _ in range(TREES if len(label) else 0):
        rows = np.concatenate([rng.choice(x, max(LEAF_ROWS, len(label) // len(classes))) for x in classes])
        nodes: list[list] = []

        def grow(mine: np.ndarray, depth: int) -> int:
            place, y = len(nodes), label[mine]
            nodes.append([-1, 0.0, 0, 0, float(y.mean())])
            best = None
            if depth < DEPTH and len(mine) >= 2 * LEAF_ROWS and 0 < y.mean() < 1:
                for k in rng.permutation(values.shape[1])[:part]:
                    order = np.argsort(values[mine, k], kind="stable")
                    x, ones = values[mine, k][order], np.cumsum(y[order])
                    size = np.arange(1, len(x))
                    edge = (x[1:] > x[:-1]) & (size >= LEAF_ROWS) & (len(x) - size >= LEAF_ROWS)
                    if not edge.any():
                        continue
                    left, right = ones[:-1], ones[-1] - ones[:-1]
                    other = len(x) - size
                    impurity = left * (size - left) / size + right * (other - right) / other
                    impurity = np.where(edge, impurity, np.inf)
                    at = int(impurity.argmin())
                    if best is None or impurity[at] < best[0]:
                        best = (impurity[at], int(k), (x[at] + x[at + 1]) / 2)
            if best is not None:
                _, k, cut = best
                below = values[mine, k] <= cut
                nodes[place][:2] = k, cut
                nodes[place][2] = grow(mine[below], depth + 1)
                nodes[place][3] = grow(mine[~below], depth + 1)
            return place

        grow(rows, 0)
        trees.append(tuple(np.array(x) for x in zip(*nodes)))
    return Forest(language, tuple(trees))


def _word_counts(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Times of every letter pair and four-letter run, inside words shorter than ``LEAST_LENGTH``, as numbers to base 26."""
    slots = _SLOT[np.frombuffer(joined, np.uint8)]
    inside = np.zeros(len(slots) + 2, dtype=bool)
    inside[1:-1] = slots < 26
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    short = ends - starts < LEAST_LENGTH
    left = np.zeros(len(slots) + 1, dtype=np.int64)
    np.add.at(left, starts[short], 1)
    np.add.at(left, ends[short], -1)
    word = np.cumsum(left[:-1]) > 0
    out = []
    for size in (2, 4):
        whole = np.ones(max(0, len(slots) - size + 1), dtype=bool)
        code = np.zeros(len(whole), dtype=np.int64)
        for k in range(size):
            whole &= word[k : k + len(whole)]
            code = code * 26 + slots[k : k + len(whole)]
        out.append(np.bincount(code[whole], minlength=26**size))
    return out[0], out[1]


def learn_language(docs: DataFrame) -> Language:
    """Character transitions and frequent four-letter runs of the words of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(26**2, dtype=np.int64), np.zeros(26**4, dtype=np.int64)]
        for portion in portions(batches, "text", COUNTED_BYTES):
            for total, more in zip(totals, _word_counts(b" ".join(text_bytes(portion.column("text"))))):
                total += more
        for size, total in zip((2, 4), totals):
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({
                "size": pa.array(np.full(len(used), size, dtype=np.int32)), "code": pa.array(used.astype(np.int32)),
                "times": pa.array(total[used]),
            })

    counted = materialize(
        docs.select("text").mapInArrow(run, "size int, code int, times long")
        .groupBy("size", "code").agg(F.sum("times").alias("times"))
    )
    counts = np.zeros((38, 38))
    for row in counted.where("size = 2").collect():
        counts[divmod(row["code"], 26)] = row["times"]
    top = counted.where("size = 4").orderBy(F.col("times").desc(), "code").limit(FOUR_GRAMS).collect()
    letters = b"abcdefghijklmnopqrstuvwxyz"
    return Language.of(counts, [bytes(letters[row["code"] // 26**k % 26] for k in (3, 2, 1, 0)) for row in top])


def stratum(text: bytes, start: int, end: int) -> str | None:
    """The part of the sample that a finding belongs to; None if the rules do not label it.

    Secrets by key format and by naming word; false findings that look like secrets (mixed, named or
    with a sample word), and plain words.
    """
    label = rule_label(text, start, end)
    if label is None:
        return None
    value = text[start:end]
    if label:
        return FORMAT if FORMATS.match(value) else NAMED
    named = NAMING.search(text[max(0, start - NEAR_BYTES) : start]) is not None
    return HARD if named or re.search(rb"[0-9]", value) or SAMPLE_WORDS.search(value) else PLAIN


def labelled_values(docs: DataFrame) -> DataFrame:
    """At most ``STRATUM_FINDINGS`` values (value, label) of each stratum, from the findings of all documents.

    Values are chosen by their hash, so reruns agree; one that is a secret anywhere counts as a secret.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION_BYTES):
            found: set[tuple[bytes, str]] = set()
            for text in text_bytes(portion.column("text")):
                for start, end in spans(text):
                    kind = stratum(text, start, end)
                    if kind is not None:
                        found.add((hashlib.sha256(text[start:end]).digest(), kind))
            yield pa.RecordBatch.from_pydict({
                "value": pa.array([x for x, _ in found], pa.binary()), "stratum": pa.array([x for _, x in found], pa.string()),
            })

    order = F.array_position(F.array(*map(F.lit, (PLAIN, HARD, NAMED, FORMAT))), F.col("stratum"))
    found = materialize(
        docs.select("text").mapInArrow(run, "value binary, stratum string")
        .groupBy("value").agg(F.max(order).alias("rank"))
    )
    parts = [found.where(F.col("rank") == k).orderBy("value").limit(STRATUM_FINDINGS) for k in (1, 2, 3, 4)]
    chosen = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    return chosen.select("value", (F.col("rank") > 2).cast("int").alias("label"))


def _named_spans(text: bytes) -> Iterator[tuple[int, int]]:
    """Values after naming words: in quotes up to the same quote, else up to a blank or quote, without closing marks.

    A value that itself holds ``name=`` is taken whole and in parts, so all spans together stay linear.
    """
    low = text.lower()
    if not any(part in low for part in _NAME_PARTS):
        return
    names = [match.span() for match in _NAMED.finditer(low)]
    covered = 0
    for (_, at), (following, _) in zip(names, [*names[1:], (len(text), 0)]):
        value = _NAMED_VALUE.match(text, at)
        if value is None:
            continue
        start, end = value.span(value.lastgroup)
        ends = {min(end, following)} if start < covered else {end, min(end, following)}
        covered = max(covered, end)
        for end in ends:
            if value.lastgroup == "c" or end == following:
                end = start + len(text[start:end].rstrip(b",;.)]}&"))
            if start < end:
                yield start, end


def _password_spans(text: bytes) -> Iterator[tuple[int, int]]:
    """Passwords of scheme://user:password@host and user:password@host."""
    if b"@" not in text or b":" not in text:
        return
    for chunk in _CHUNK.finditer(text):
        if b"@" in chunk[0] and b":" in chunk[0]:
            first = _AFTER_USER.match(chunk[0])
            for match in [*([first] if first else []), *_IN_URL.finditer(chunk[0])]:
                start, end = match.span("a")
                yield chunk.start() + start, chunk.start() + end - 1


def spans(text: bytes) -> list[tuple[int, int]]:
    """The candidates of a text in order: long runs, key formats, values after naming words, passwords before a host."""
    found = {match.span() for match in CANDIDATE.finditer(text)}
    if any(part in text for part in _FORMAT_PARTS):
        found.update(match.span() for match in _FORMAT_RUN.finditer(text))
    found.update(_named_spans(text))
    found.update(_password_spans(text))
    return sorted(found)


def _outermost(rows: list[tuple], kept: np.ndarray) -> np.ndarray:
    """``kept`` without findings inside an earlier kept one of the same document, unless they are key formats."""
    kept = kept.copy()
    last_row, last_end = None, -1
    for k in sorted(np.flatnonzero(kept), key=lambda k: (rows[k][6], rows[k][1], -rows[k][2])):
        row, end = rows[k][6], rows[k][2]
        if row != last_row:
            last_row, last_end = row, -1
        if end <= last_end and not rows[k][4]:
            kept[k] = False
        last_end = max(last_end, end)
    return kept


def _found(batches: Iterator[pa.RecordBatch], language: Language) -> Iterator[list[tuple]]:
    for portion in portions(batches, "text", PORTION_BYTES):
        rows = []
        ids, paths = portion.column("doc_id").to_pylist(), portion.column("path").to_pylist()
        for place, (doc, text, path) in enumerate(zip(ids, text_bytes(portion.column("text")), paths)):
            for start, end in spans(text):
                rows.append((
                    doc, start, end, hashlib.sha256(text[start:end]).hexdigest(), FORMATS.match(text[start:end]) is not None
                    and rule_label(text, start, end) == 1, describe(text, start, end, path or "", language), place,
                ))
        yield rows


def train(docs: DataFrame) -> Forest:
    """A forest from labelled findings of all documents, a bounded number of each stratum.

    Word statistics come from all documents too. Of a value's findings with its label, the one with
    the greatest features takes part. Each task keeps one row per value.
    """
    language = learn_language(docs)
    chosen = {bytes(row["value"]): row["label"] for row in labelled_values(docs).collect()}
    sent = docs.sparkSession.sparkContext.broadcast((language, chosen))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language, chosen = sent.value
        best: dict[bytes, list[float]] = {}
        for portion in portions(batches, "text", PORTION_BYTES):
            for text, path in zip(text_bytes(portion.column("text")), portion.column("path").to_pylist()):
                for start, end in spans(text):
                    value = hashlib.sha256(text[start:end]).digest()
                    if value in chosen and rule_label(text, start, end) == chosen[value]:
                        features = describe(text, start, end, path or "", language)
                        best[value] = max(best.get(value, features), features)
        yield pa.RecordBatch.from_pydict({
            "value": pa.array(list(best), pa.binary()), "features": pa.array(list(best.values()), pa.list_(pa.float64())),
        })

    fitted = (
        docs.select("text", "path").mapInArrow(run, "value binary, features array<double>")
        .groupBy("value").agg(F.max("features").alias("features")).orderBy("value").toArrow()
    )
    values = np.array(fitted.column("features").to_pylist(), dtype=np.float64).reshape(-1, len(FEATURES))
    label = np.array([chosen[x] for x in fitted.column("value").to_pylist()], dtype=np.float64)
    return grow_forest(values, label, language)


def scan_secrets(docs: DataFrame, forest: Forest, least: float = 0.5) -> DataFrame:
    """Findings of ``docs`` (doc_id, text, path) that the forest keeps: one row each.

    Columns: doc_id, start and end (bytes of the UTF-8 text), value_sha256, score. Candidates are
    runs of at least 16 letters, digits and ``+/_-``, key formats, values of any length and characters after a
    naming word, and passwords of ``user:password@host``; those scored below ``least`` are taken for
    false findings, but formats that only keys have score 1 whatever the forest was fitted on. A
    finding inside another one is left out unless it is a key format. Null and empty texts have none; a null path is an empty one; equal rows give
    equal findings each. Whole texts are read in the scan's own tasks, nothing moves.
    """
    sent = docs.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _found(batches, sent.value.language):
            values = np.array([r[5] for r in rows], dtype=np.float64).reshape(-1, len(FEATURES))
            scores = np.where([r[4] for r in rows], 1.0, sent.value.score(values))
            kept = [(rows[k], float(scores[k])) for k in np.flatnonzero(_outermost(rows, scores >= least))]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([r[0] for r, _ in kept], pa.int64()), "start": pa.array([r[1] for r, _ in kept], pa.int64()),
                "end": pa.array([r[2] for r, _ in kept], pa.int64()), "value_sha256": pa.array([r[3] for r, _ in kept], pa.string()),
                "score": pa.array([s for _, s in kept], pa.float64()),
            })

    return docs.select("doc_id", "text", "path").mapInArrow(
        run, "doc_id long, start long, end long, value_sha256 string, score double"
    )

"""Document quality by a sparse ensemble of rules over text statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm.samples import SAMPLE_ROWS, labelled_sample
from attestry.llm.words import BLANK_CODES, hash_words, portions, text_bytes, word_table

PORTION_BYTES = 8 << 20
TREES, DEPTH, CUTS, LEAF_ROWS, SHRINK = 30, 3, 24, 20, 0.3
LASSO, LASSO_STEPS = 2e-3, 600
CUTOFF = 0.7

STATISTICS = (
    "words", "word_bytes", "line_bytes", "upper", "lower", "digits", "beyond_ascii", "blanks",
    "sentence_marks", "exclamations", "bars", "other_symbols", "distinct_words", "doubled_symbols",
    "doubled_bytes", "byte_entropy",
)

_KINDS = np.full(256, 7, dtype=np.int64)
for _code in range(ord("A"), ord("Z") + 1):
    _KINDS[_code], _KINDS[_code + 32] = 0, 1
_KINDS[ord("0") : ord("9") + 1] = 2
_KINDS[128:] = 3
_KINDS[list(BLANK_CODES)] = 4
_KINDS[[ord(x) for x in ".,;:?'\""]] = 5
_KINDS[ord("!")] = 6
_KINDS[ord("|")] = 8


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` per text: shares of bytes but for the first three; 0 if empty."""
    out = np.zeros((len(texts), len(STATISTICS)))
    hashes, counts = hash_words(texts, word_table(BLANK_CODES))
    ends = np.cumsum(counts)
    for k, text in enumerate(texts):
        if not text:
            continue
        raw = np.frombuffer(text, np.uint8)
        times = np.bincount(raw, minlength=256)
        kinds = np.bincount(_KINDS, weights=times, minlength=9) / len(raw)
        words = int(counts[k])
        same = raw[1:] == raw[:-1]
        symbols = same & (_KINDS[raw[1:]] >= 5)
        shares = times[times > 0] / len(raw)
        distinct = len(np.unique(hashes[ends[k] - words : ends[k]])) / words if words else 0.0
        out[k] = (
            words, (1 - kinds[4]) * len(raw) / words if words else 0.0, len(raw) / (times[10] + 1),
            kinds[0], kinds[1], kinds[2], kinds[3], kinds[4], kinds[5], kinds[6], kinds[8], kinds[7],
            distinct, symbols.sum() / len(raw), same.sum() / len(raw), -(shares * np.log2(shares)).sum(),
        )
    return out


def with_statistics(docs: DataFrame, carried: Sequence[str]) -> DataFrame:
    """``carried`` columns of ``docs`` and the statistics of its ``text``, in the scan's own tasks."""
    source = docs.select(*carried, "text")
    schema = ", ".join(
        [f"`{x.name}` {x.dataType.simpleString()}" for x in source.schema if x.name != "text"]
        + [f"{name} double" for name in STATISTICS]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION_BYTES):
            values = statistics(text_bytes(portion.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*[portion.column(name) for name in carried], *[pa.array(x) for x in values.T]],
                names=[*carried, *STATISTICS],
            )

    return source.mapInArrow(run, schema)


@dataclass(frozen=True)
class Condition:
    statistic: int
    above: bool
    cut: float

    def holds(self, values: np.ndarray) -> np.ndarray:
        column = values[:, self.statistic]
        return column > self.cut if self.above else column <= self.cut

    def column(self) -> Column:
        column = F.col(STATISTICS[self.statistic])
        return column > self.cut if self.above else column <= self.cut


@dataclass(frozen=True)
class RuleEnsemble:
    """A logistic score over conjunctive rules: intercept plus the weights of the rules that hold."""

    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """The ensemble as one Spark expression over the statistics' columns."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights):
            holds = reduce(lambda a, b: a & b, [condition.column() for condition in rule])
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def grow_tree(values: np.ndarray, residual: np.ndarray, cuts: list[np.ndarray]):
    """A regression tree as (paths to every node but the root, prediction per row)."""
    paths, predicted = [], np.zeros(len(values))

    def split(rows: np.ndarray, path: tuple[Condition, ...]) -> None:
        if path:
            paths.append(path)
        best = None
        total, count = residual[rows].sum(), len(rows)
        if len(path) < DEPTH and count >= 2 * LEAF_ROWS:
            for k, points in enumerate(cuts):
                if not len(points):
                    continue
                slot = np.searchsorted(points, values[rows, k], side="left")
                sums = np.cumsum(np.bincount(slot, weights=residual[rows], minlength=len(points) + 1))[:-1]
                sizes = np.cumsum(np.bincount(slot, minlength=len(points) + 1))[:-1]
                right = count - sizes
                fine = (sizes >= LEAF_ROWS) & (right >= LEAF_ROWS)
                if not fine.any():
                    continue
                gain = np.where(fine, sums**2 / np.maximum(sizes, 1) + (total - sums) ** 2 / np.maximum(right, 1), -1.0)
                at = int(gain.argmax())
                if best is None or gain[at] > best[0]:
                    best = (gain[at], k, points[at])
        if best is None or best[0] <= total**2 / count + 1e-9:
            predicted[rows] = total / count
            return
        _, k, cut = best
        low = values[rows, k] <= cut
        split(rows[low], (*path, Condition(k, False, float(cut))))
        split(rows[~low], (*path, Condition(k, True, float(cut))))

    split(np.arange(len(values)), ())
    return paths, predicted


def tree_rules(values: np.ndarray, label: np.ndarray) -> list[tuple[Condition, ...]]:
    """The distinct paths of boosted trees, each a conjunction of conditions."""
    cuts = [np.unique(np.quantile(column, np.arange(1, CUTS) / CUTS)) for column in values.T]
    cuts = [points[points < column.max()] for points, column in zip(cuts, values.T)]
    score = np.zeros(len(label))
    rules: dict[frozenset, tuple[Condition, ...]] = {}
    for _ in range(TREES):
        residual = label - 1 / (1 + np.exp(-score))
        paths, predicted = grow_tree(values, residual, cuts)
        score += SHRINK * 4 * predicted
        for path in paths:
            rules.setdefault(frozenset(path), path)
    return list(rules.values())


def fit_lasso(holds: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty by accelerated proximal steps; the intercept is free."""
    n = len(label)
    x = np.column_stack([holds.astype(np.float64), np.ones(n)])
    step = 4 * n / max(np.linalg.norm(x, 2) ** 2, 1e-9)
    weights = ahead = np.zeros(x.shape[1])
    t = 1.0
    for _ in range(LASSO_STEPS):
        slope = x.T @ (1 / (1 + np.exp(-np.clip(x @ ahead, -50, 50))) - label) / n
        new = ahead - step * slope
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * LASSO, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - weights)
        weights, t = new, t_new
    return weights[:-1], float(weights[-1])


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """An ensemble from at most ``rows`` labelled documents (doc_id, quality 0 or 1).

    Only statistics of the text are read. With one class alone, or no rows, every text gets that
    class's (or an even) score.
    """
    sample = with_statistics(labelled_sample(docs, labels, "quality", rows), ["label"]).toArrow()
    label = sample.column("label").to_numpy().astype(np.float64)
    values = np.column_stack([sample.column(name).to_numpy() for name in STATISTICS])
    if len(label) == 0 or label.min() == label.max():
        base = float(label.mean()) if len(label) else 0.5
        return RuleEnsemble((), (), float(np.log((base + 1e-3) / (1 - base + 1e-3))))
    order = np.lexsort((*values.T, label))  # the same rows give the same model in any order
    values, label = values[order], label[order]
    rules = tree_rules(values, label)
    weights, intercept = fit_lasso(np.column_stack([
        reduce(np.logical_and, [condition.holds(values) for condition in rule]) for rule in rules
    ]), label)
    used = np.flatnonzero(weights)
    return RuleEnsemble(
        tuple(rules[k] for k in used), tuple(float(weights[k]) for k in used), intercept
    )


def quality(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, score (0 to 1), predicted (score >= 0.7).

    Null and empty texts have statistics of 0 and are scored like any other; whole texts are read,
    once, and nothing moves between tasks.
    """
    scored = with_statistics(docs, ["doc_id"]).select("doc_id", model.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))

"""Severity of toxic language by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.samples import SAMPLE_ROWS, sample_by_class
from attestry.llm.words import (
    SYMBOL_CODES, hash_words_with_heads, mixed, portions, text_bytes, word_table,
)

PORTION_BYTES = 8 << 20
PREFIX_BYTES = (4, 5, 6)
MOST_FEATURES = 4_096
LEAST_TOXIC = 4
LEAST_LOG_ODDS = 3.5
GRADES = 4
STEPS = 1_500
L2 = 0.003


def occurrences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature of every word and of every word's first 4, 5 and 6 bytes."""
    hashes, counts, heads, lengths = hash_words_with_heads(texts, word_table(SYMBOL_CODES))
    owner = np.repeat(np.arange(len(texts)), counts)
    owners, features = [owner], [hashes]
    for size in PREFIX_BYTES:
        longer = lengths > size
        cut = heads[longer] & np.uint64((1 << (8 * size)) - 1)
        owners.append(owner[longer])
        features.append(mixed((cut ^ np.uint64(size)) * np.uint64(0xD6E8FEB86659FD93)))
    return np.concatenate(owners), np.concatenate(features)


@dataclass(frozen=True)
class Severity:
    """Selected features (sorted hashes), their shared weights, and ordered thresholds."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def sparse(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and log(1 + count) of the selected features in the texts."""
        owners, features = occurrences(texts)
        at = np.minimum(np.searchsorted(self.features, features), max(0, len(self.features) - 1))
        hit = self.features[at] == features if len(self.features) else np.zeros(len(at), dtype=bool)
        cells, times = np.unique(owners[hit] * np.int64(len(self.features) or 1) + at[hit], return_counts=True)
        return cells // (len(self.features) or 1), cells % (len(self.features) or 1), np.log1p(times)

    def above(self, texts: list[bytes]) -> np.ndarray:
        """P(grade > k) for every text and threshold k."""
        rows, columns, values = self.sparse(texts)
        score = np.bincount(rows, weights=values * self.weights[columns], minlength=len(texts))
        return 1 / (1 + np.exp(self.thresholds[None, :] - score[:, None]))


def least_toxic(toxic: int) -> int:
    """In how many toxic rows a feature must occur: 4, or fewer where few rows are toxic."""
    return min(LEAST_TOXIC, max(2, toxic // 4))


def select_features(sample: DataFrame) -> np.ndarray:
    """Features that toxic rows of the sample hold far more often than others, at most 4,096.

    Toxic rows without any such feature are an error: the model would call nothing toxic.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION_BYTES):
            owners, features = occurrences(text_bytes(portion.column("text")))
            label = np.asarray(portion.column("label"))
            # One per text and feature.
            order = np.lexsort((owners, features))
            owners, features = owners[order], features[order]
            new = np.ones(len(features), dtype=bool)
            new[1:] = (owners[1:] != owners[:-1]) | (features[1:] != features[:-1])
            owners, features = owners[new], features[new]
            toxic = label[owners] == 1
            names, back = np.unique(features, return_inverse=True)
            ones = np.bincount(back, weights=toxic, minlength=len(names)).astype(np.int64)
            alls = np.bincount(back, minlength=len(names)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(ones), pa.array(alls - ones)],
                names=["feature", "toxic", "clean"],
            )

    total = sample.agg(F.sum("label"), F.count(F.lit(1))).first()
    toxic, clean = total[0] or 0, total[1] - (total[0] or 0)
    odds = F.log((F.col("toxic") + 0.5) / F.lit(toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(clean + 1.0))
    rows = (
        sample.mapInArrow(run, "feature long, toxic long, clean long")
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= least_toxic(toxic)) & (odds >= LEAST_LOG_ODDS))
        .orderBy((odds * F.sqrt("toxic")).desc(), "feature").limit(MOST_FEATURES)
        .select("feature").toArrow()
    )
    if toxic and not rows.num_rows:
        raise ValueError(f"{toxic} of {toxic + clean} labelled rows are toxic, but no feature marks them; label more rows")
    return np.sort(rows.column("feature").to_numpy().astype(np.int64).view(np.uint64))


def grade_rows(label: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Severity grades of labelled rows: 0 for clean, else 1 to 3 by thirds of the marked features."""
    grades = np.zeros(len(label), dtype=np.int64)
    toxic = label == 1
    if toxic.any():
        cuts = np.quantile(marks[toxic], np.arange(1, GRADES - 1) / (GRADES - 1))
        grades[toxic] = 1 + np.searchsorted(cuts, marks[toxic], side="left")
    return grades


def fit_ordinal(
    rows, columns, values, grades: np.ndarray, n_features: int, row_weights: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of P(grade > k) = sigmoid(w x - threshold k), by adaptive gradients.

    All thresholds share the weights; each threshold is one binary question over all rows, and they
    are kept in order by fitting the first one and positive gaps. ``row_weights`` say how many rows
    each one stands for.
    """
    n, cuts = len(grades), GRADES - 1
    share = np.ones(n) if row_weights is None else row_weights * n / row_weights.sum()
    beyond = grades[:, None] > np.arange(cuts)[None, :]
    weights, first, gaps = np.zeros(n_features), 1.0, np.zeros(cuts - 1)
    memory = np.full(n_features + cuts, 1e-8)
    for _ in range(STEPS):
        steps = np.exp(gaps)
        thresholds = first + np.append(0.0, np.cumsum(steps))
        score = np.bincount(rows, weights=values * weights[columns], minlength=n)
        error = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -50, 50))) - beyond
        error *= share[:, None]
        by_row = error.sum(axis=1)
        slope_w = np.bincount(columns, weights=values * by_row[rows], minlength=n_features) / n + L2 * weights / n
        slope_t = -error.mean(axis=0)
        slope_gaps = np.array([slope_t[k + 1 :].sum() for k in range(cuts - 1)]) * steps
        slope = np.concatenate([slope_w, [slope_t.sum()], slope_gaps])
        memory += slope**2
        move = slope / np.sqrt(memory)
        weights, first, gaps = weights - move[:n_features], first - move[n_features], gaps - move[n_features + 1 :]
    return weights, first + np.append(0.0, np.cumsum(np.exp(gaps)))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Severity:
    """A model from at most ``rows`` labelled documents (doc_id, toxic 0 or 1).

    Each class fills half of them and weighs as it does among all labels. Toxic rows get grades 1 to 3
    by how many marked features they hold. Without toxic rows nothing is ever found toxic; with toxic
    rows that no feature marks, this is an error.
    """
    sample = sample_by_class(docs, labels, "toxic", rows)
    features = select_features(sample)
    if not len(features):
        return Severity(features, np.zeros(0), np.full(GRADES - 1, 50.0))
    blank = Severity(features, np.zeros(len(features)), np.zeros(GRADES - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION_BYTES):
            owner, columns, values = blank.sparse(text_bytes(portion.column("text")))
            bounds = np.searchsorted(owner, np.arange(portion.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    portion.column("label").cast(pa.int32()),
                    portion.column("weight"),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(columns.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)),
                ],
                names=["label", "weight", "columns", "values"],
            )

    # At most ``rows`` rows with the few selected features that each holds.
    table = sample.mapInArrow(run, "label int, weight double, columns array<int>, values array<double>").toArrow()
    label = table.column("label").to_numpy()
    lists = table.column("columns").to_pylist()
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    owner = np.repeat(np.arange(len(lists)), sizes)
    columns = np.array([c for x in lists for c in x], dtype=np.int64)
    values = np.array([v for x in table.column("values").to_pylist() for v in x])
    marks = np.bincount(owner, weights=np.expm1(values), minlength=len(label))
    weights, thresholds = fit_ordinal(
        owner, columns, values, grade_rows(label, marks), len(features), table.column("weight").to_numpy()
    )
    return Severity(features, weights, thresholds)


def severity(docs: DataFrame, model: Severity) -> DataFrame:
    """Every row of ``docs`` (doc_id, text): doc_id, severity, grade, toxic.

    ``severity`` is the expected grade (0 to 3), ``grade`` the highest one that is likelier reached
    than not, ``toxic`` whether grade is above 0. Null and empty texts hold no features and get the
    model's base severity. Whole texts are scored in the scan's own tasks; nothing moves.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION_BYTES):
            above = sent.value.above(text_bytes(portion.column("text")))
            grade = (above >= 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    portion.column("doc_id").cast(pa.int64()),
                    pa.array(above.sum(axis=1)),
                    pa.array(grade.astype(np.int32)),
                    pa.array(grade > 0),
                ],
                names=["doc_id", "severity", "grade", "toxic"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, severity double, grade int, toxic boolean"
    )


def without_toxic(docs: DataFrame, model: Severity) -> DataFrame:
    """The rows of ``docs`` whose likeliest grade is 0, with all their columns; nothing moves."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for portion in portions(batches, "text", PORTION_BYTES):
            above = sent.value.above(text_bytes(portion.column("text")))
            yield portion.filter(pa.array(above[:, 0] < 0.5))

    return docs.mapInArrow(run, docs.schema)

"""Class model: base scores by brute force, probabilities that sum to one, better than the base."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from attestry.llm import class_model

DOCS = "doc_id long, text string, n_tokens string, portion int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered(text)), None]


def base_scores(rows):
    """Per row (id, held out, tokens, known, training tokens, base score) as the contract states them."""
    held = [doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0 for doc, _ in rows]
    count = collections.Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    total, types = sum(count.values()), len(count)
    out = []
    for (doc, text), h in zip(rows, held):
        line = tokens(text)
        score = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (types + 1))) for w in line)
        out.append((doc, h, len(line), sum(count[w] > 0 for w in line), total, score))
    return out


def same(got, want):
    order = lambda row: tuple((x is None, x) for x in row[:5])
    got = sorted(([*r] for r in got), key=lambda r: (*order(r), r[5]))
    want = sorted(want, key=lambda r: (*order(r), r[5]))
    assert [tuple(r[:5]) for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-9)


def frame(spark, rows, parts=4):
    made = [Row(doc_id=d, text=t, n_tokens="clash", portion=3) for d, t in rows]
    return spark.createDataFrame(made, DOCS).repartition(parts)


@pytest.fixture(scope="module")
def rows():
    """Two topics whose words follow each other in turns, with every awkward text."""
    rng = random.Random(8)
    parts = [[f"{x}{k}" for k in range(60)] for x in ("ga", "gb", "ha", "hb")]
    texts = []
    for k in range(400):
        first, second = (parts[0], parts[1]) if k % 2 else (parts[2], parts[3])
        line = [rng.choice((first, second)[i % 2]) for i in range(rng.randrange(20, 60))]
        texts.append(" ".join(line) + f" only{k}")
    texts += [None, "", " \t\n", "A", "é É\x0bx", "word" * 20_000, texts[0], " ".join(rng.choice(parts[0]) for _ in range(50_000))]
    out = list(enumerate(texts))
    return [*out, out[1], out[1], (None, "null id")]


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, rows):
    got = class_model.score(frame(spark, rows)).collect()
    same(got, base_scores(rows))
    held = [r for r in got if r.held_out]
    assert len(held) > 20
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.2 * sum(r.n_tokens for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_portions_change_nothing_but_ties(spark, rows, monkeypatch):
    """Also with few frequent words, so that most words get their class by the single step."""
    monkeypatch.setattr(class_model, "PORTION_BYTES", 500)
    monkeypatch.setattr(class_model, "FREQUENT", 50)
    got = class_model.score(frame(spark, rows, 3)).collect()
    same(got, base_scores(rows))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_are_the_models_probabilities(spark, rows):
    """Scores from the classes and counts alone, token by token."""
    docs = frame(spark, rows)
    encoded, known, classes, placed = class_model._learn(docs)
    count = collections.Counter(
        w for d, t in rows if d is None or zlib.crc32(str(d).encode()) % 10 for w in tokens(t)
    )
    table = class_model.word_table(class_model.BLANK_CODES)
    hashed = {int(class_model.hash_words([w.encode()], table)[0][0]): w for w in count if w}
    rank = dict(zip(known.frequent.tolist(), known.order.tolist()))
    kind = {w: int(classes[rank[h]]) for h, w in hashed.items() if h in rank}
    local = {r.portion: class_model._words(r.words)[0] for r in encoded.collect()}
    for r in placed.where("portion IS NOT NULL").collect():
        at, n, c = (class_model.unpack(x, k)[0] for x, k in ((r.at, "<u4"), (r.n, "<i8"), (r["class"], "u1")))
        for h, times, own in zip(local[r.portion][at].tolist(), n.tolist(), c.tolist()):
            if times:
                assert count[hashed[h]] == times and kind.setdefault(hashed[h], own) == own
    assert set(kind) == {w for w in count if w}
    end, unknown = class_model.CLASSES, class_model.UNKNOWN
    types, mass = np.zeros((2, class_model.CLASSES))
    for w, c in kind.items():
        types[c] += 1
        mass[c] += count[w]
    counted = np.zeros((class_model.STATES,) * 2)

    def states(text):
        return [end if w is None else kind.get(w, unknown) for w in tokens(text)]

    for d, t in rows:
        if d is None or zlib.crc32(str(d).encode()) % 10:
            line = states(t)
            np.add.at(counted, ([end, *line[:-1]], line), 1)
    model = class_model.build_model(counted, types, mass, known.discount)
    want = []
    for d, t in rows:
        line, score = states(t), 0.0
        for before, own, w in zip([end, *states(t)[:-1]], line, tokens(t)):
            score += model.transitions[before, own]
            if own < end:
                score += math.log10((count[w] - model.discount) / mass[own])
        want.append(score)
    got = sorted(r.score for r in class_model.score(docs).collect())
    assert np.allclose(got, sorted(want), rtol=1e-9)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    counted = rng.integers(0, 50, (class_model.STATES,) * 2)
    types = rng.integers(0, 9, class_model.CLASSES).astype(float)
    sizes = types * 3
    model = class_model.build_model(counted, types, sizes, 0.4)
    known = np.where(sizes > 0, 1 - 0.4 * types / np.maximum(sizes, 1), 0.0)
    to = 10**model.transitions
    total = to[:, : class_model.CLASSES] @ known + to[:, class_model.CLASSES] + to[:, class_model.UNKNOWN]
    assert np.allclose(total, 1)


def test_exchange_finds_the_words_of_a_kind(spark):
    """Words that follow each other in turns end in classes of their own."""
    rng = random.Random(3)
    pairs = collections.Counter()
    for _ in range(40_000):
        pairs[rng.randrange(0, 40), rng.randrange(40, 80)] += 1
        pairs[rng.randrange(40, 80), rng.randrange(0, 40)] += 1
    df = spark.createDataFrame([(a, b, n) for (a, b), n in pairs.items()], "left int, right int, n long")
    classes, follows, precedes = class_model.exchange(df, 80)
    assert not set(classes[:40]) & set(classes[40:80])
    assert follows.sum() == precedes.sum() == sum(pairs.values())


def test_no_rows_and_no_training_texts(spark):
    assert class_model.score(spark.createDataFrame([], DOCS)).collect() == []
    doc = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 10 == 0)
    for text in ("some words", None):
        (row,) = class_model.score(spark.createDataFrame([(doc, text)], "doc_id long, text string")).collect()
        assert (row.held_out, row.n_known, row.train_tokens) == (True, 0, 0)
        assert row.score == row.base_score == 0.0
    (row,) = class_model.score(spark.createDataFrame([(doc + 1 if doc else 1, "")], "doc_id long, text string")).collect()
    assert row.n_known == 1 and math.isfinite(row.score)

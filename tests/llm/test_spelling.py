"""Spelling variants against brute force over all pairs of words."""

import collections
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import Row

from attestry.llm import spelling
from attestry.llm.oracles import ORACLES

DOCS = "doc_id long, text string, word string, n int, length int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_words(rows):
    count = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", lowered(text)):
            h = None if doc is None else zlib.crc32(f"{doc}:{run}".encode())
            if h is not None and h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(count):
    near = collections.defaultdict(list)
    for a, b in itertools.combinations(sorted(count), 2):
        if one_apart(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-count[x], x))
        if count[best] >= 2 * count[w]:
            form[w] = best
    out = []
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    stems = ["spelling", "commonly", "étrangère", "aaaaaaaa", "ababababab", "straße", "ÿÿÿÿÿÿ"]
    texts = []
    for _ in range(400):
        word = rng.choice(stems)
        for _ in range(rng.choice((0, 0, 1, 1, 2))):
            at = rng.randrange(len(word) + 1)
            word = rng.choice((word[:at] + word[at + 1 :], word[:at] + rng.choice("abé") + word[at:], word[:at] + "x" + word[at + 1 :]))
        texts.append(" ".join([word] * rng.randrange(1, 9)) + rng.choice((".", "1", "\n", "×", "")))
    texts += [None, "", "1 2 3", "Word " * 3_000, ("y" * 300 + " ") * 3, ("y" * 299 + " ") * 6, "Abcdefg×abcdefg÷ABCDEFG ÀBCDEF àbcdef ÀBCDEF ÀBCDEF"]
    out = list(enumerate(texts))
    return [*out, out[0], out[0], (None, "nullid nullid nullid"), (None, None)]


def frame(spark, rows):
    return spark.createDataFrame([Row(doc_id=d, text=t, word="clash", n=1, length=2) for d, t in rows], DOCS).repartition(3)


def test_variants_equal_brute_force(spark, rows):
    want = brute_variants(brute_words(rows))
    assert len(want) > 100 and any(r[1] and r[2] != r[1] for r in want)
    assert result(spelling.variants(spelling.corpus_words(frame(spark, rows)))) == want


def test_refined_chunks_lose_no_pair(spark, rows, monkeypatch):
    monkeypatch.setattr(spelling, "PAIRS_PER_CHUNK", 1)
    assert result(spelling.variants(spelling.corpus_words(frame(spark, rows)))) == brute_variants(brute_words(rows))


def test_crowds_with_one_beginning_stay_small(spark):
    """2,000 words share their first half: their pairs never meet all at once."""
    rng = random.Random(2)
    words = {"prefixes" + "".join(rng.choice("abcdefghij") for _ in range(8)) for _ in range(2_000)}
    words |= {w[:-1] for w in list(words)[:50]}
    count = {w: rng.randrange(3, 50) for w in words}
    df = spark.createDataFrame(list(count.items()), "word string, n long")
    assert result(spelling.variants(df)) == brute_variants(count)


def test_ties_take_the_first_form(spark):
    df = spark.createDataFrame([("words", 3), ("wordz", 9), ("worda", 9), ("wordy", 18)], "word string, n long")
    got = {r.word: (r.form, r.root, r.n_near) for r in spelling.variants(df).collect()}
    assert got == {
        "words": ("wordy", "wordy", 3), "wordz": ("wordy", "wordy", 3), "worda": ("wordy", "wordy", 3), "wordy": (None, "wordy", 3),
    }
    df = spark.createDataFrame([("words", 3), ("wordz", 9), ("worda", 9)], "word string, n long")
    assert {r.word: r.form for r in spelling.variants(df).collect()}["words"] == "worda"


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    for df in (docs, docs.where("doc_id > 5")):
        assert spelling.variants(spelling.corpus_words(df)).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(docs.selectExpr("text AS word", "doc_id AS n"), ratio=1)


def test_sql_agrees(spark):
    folder = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    columns = "word, form, root, n, n_near, form_n"
    want = sorted(db.sql(f"SELECT {columns} FROM ({ORACLES['op11_spelling']})").fetchall())
    assert result(spelling.variants(spelling.corpus_words(spark.read.parquet(f"{folder}/documents.parquet")))) == want

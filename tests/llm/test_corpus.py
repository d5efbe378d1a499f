"""Corpus operators against brute force, on rows with every awkward case."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from attestry.llm import (
    components, decontaminate, fm_index, licenses, line_dedup, mixing, ngram_join, quality, samples,
    secrets, sharding, toxicity, vector_dedup, words,
)

DOCS = "doc_id long, text string, lang string, source string, size int, shard string, _doc int, component_id int"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sentence(rng, count, prefix="w"):
    return " ".join(f"{prefix}{rng.randrange(4000)}" for _ in range(count))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, repeated rows, nulls, blanks, short and very long texts, mixed case."""
    rng = random.Random(5)
    base, other = sentence(rng, 120).split(), sentence(rng, 60)
    texts = [" ".join(base), " ".join(base).upper(), other, other, None, "", " \t\n", "one", "one", "two words here"]
    for k in range(12):
        near = list(base)
        for at in rng.sample(range(len(near)), k):
            near[at] = f"x{k}y{at}"
        texts.append(" ".join(near))
    texts += [sentence(rng, 30_000), "é É a b c d e f g h " + other, "word" * 5_000]
    texts += [f"{sentence(rng, 8)}\nThe same line in several documents.\n  the SAME line in several documents.\t\n{k}" for k in range(5)]
    out = [
        Row(doc_id=k, text=t, lang=None, source=("a", "b", None, "Ä")[k % 4], size=1, shard="x", _doc=2, component_id=3)
        for k, t in enumerate(texts)
    ]
    return [*out, out[2], out[2], Row(doc_id=None, text=other, lang="en", source=None, size=1, shard="x", _doc=2, component_id=3)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------------- words and index
def test_words_are_hashed_alike_and_counted():
    texts = ["A b  c", "", "a\x0bB " + "x" * 100, "é É " + "x" * 100, "word" * 40].__iter__()
    texts = [t.encode() for t in texts]
    table = words.word_table(words.BLANK_CODES)
    hashes, counts = words.hash_words(texts, table)
    flat = [w for t in texts for w in t.translate(table).split()]
    assert counts.tolist() == [len(t.translate(table).split()) for t in texts]
    named = dict(zip(flat, hashes.tolist()))
    assert all(named[w] == h for w, h in zip(flat, hashes.tolist()))
    assert len(set(named.values())) == len(named)


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    lengths = np.array([40, 0, 40, 1, 300])
    text = rng.integers(0, 4, lengths.sum()).astype(np.uint64)
    text[40:80] = text[:40]
    parts = fm_index.build(text, lengths)
    index = fm_index.FmIndex(lengths, parts)
    phrases = [text[k : k + size] for k in range(0, 80, 7) for size in (1, 2, 5)] + [np.array([9], np.uint64)]
    ends = np.cumsum(lengths)
    for phrase in phrases:
        low, high = index.ranges(index.codes(phrase), np.array([0]), np.array([len(phrase)]))
        found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
        true = []
        for k, (a, b) in enumerate(zip(ends - lengths, ends)):
            true += [int(p) + k for p in range(a, b - len(phrase) + 1) if (text[p : p + len(phrase)] == phrase).all()]
        assert found == true


def test_index_without_words():
    index = fm_index.FmIndex(np.array([0]), fm_index.build(np.zeros(0, np.uint64), np.array([0])))
    low, high = index.ranges(index.codes(np.array([1], np.uint64)), np.array([0]), np.array([1]))
    assert (high - low).tolist() == [0]


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 9), (3, 2), (7, 8), (8, 5)], "u long, v long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 4, 8: 4}
    assert components.components(edges.where("u > 99")).count() == 0


# --------------------------------------------------------------------------- n-gram join
def brute_components(rows):
    sets = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(r.text))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(rows)))
    for _ in rows:
        for i, j in itertools.combinations(range(len(rows)), 2):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                label[i] = label[j] = min(label[i], label[j])
    least = {}
    for r, k in zip(rows, label):
        if r.doc_id is not None:
            least[k] = min(least.get(k, r.doc_id), r.doc_id)
    return [(r.doc_id, len(s), r.doc_id if not s else least.get(k)) for r, s, k in zip(rows, sets, label)]


def key(row):
    return tuple((x is None, x) for x in row)


def test_near_duplicates_equal_brute_force(docs, rows):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows), key=key)


def test_crowds_of_near_copies_lose_no_link(spark, monkeypatch):
    """Shingles that most texts share are ordered by the hot list; links are the same."""
    monkeypatch.setattr(ngram_join, "LOCAL_LEAST", 2)
    monkeypatch.setattr(ngram_join, "HOT_LEAST", 2)
    rng = random.Random(11)
    base = sentence(rng, 100).split()
    made = []
    for k in range(60):
        near = list(base)
        for at in rng.sample(range(100), rng.randrange(0, 7)):
            near[at] = f"v{rng.randrange(50)}"
        made.append(Row(doc_id=k, text=" ".join(near)))
    made += [Row(doc_id=100 + k, text=" ".join(base[:40]) + " " + sentence(rng, 60 + k)) for k in range(10)]
    got = ngram_join.near_duplicates(spark.createDataFrame(made).repartition(4)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(made))


def test_one_of_each_keeps_columns_and_least_ids(docs, rows, nothing):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for d, n, c in brute_components(rows) if n} | {d for d, n, c in brute_components(rows) if not n}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert ngram_join.one_of_each(nothing).count() == 0


# ------------------------------------------------------------------------------ line dedup
def test_line_bitmaps_equal_brute_force(docs, rows, nothing):
    blanks = " \t\n\x0b\x0c\r"
    holders = {}
    for r in rows:
        for k in {lowered(line).strip(blanks) for line in (r.text or "").split("\n")}:
            holders.setdefault(k, []).append(r.doc_id)
    want = []
    for r in rows:
        lines, kept = (r.text or "").split("\n"), []
        for line in lines:
            held = holders[k] if len(k := lowered(line).strip(blanks)) >= 20 else []
            if len(held) < 3 or r.doc_id == max((h for h in held if h is not None), default=None):
                kept.append(line)
        want.append((r.doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256)
    )
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert sum(w[2] for w in want) >= 8
    assert line_dedup.apply_bitmaps(nothing, line_dedup.keep_bitmaps(nothing)).count() == 0


def test_bitmaps_list_only_words_with_drops(spark):
    text = "\n".join([f"a line of its own, number {k} of {{}}" for k in range(130)] + ["a line that all of them share"])
    made = spark.createDataFrame([Row(doc_id=k, text=text.replace("{}", str(k))) for k in range(3)])
    got = {r.doc: r for r in line_dedup.keep_bitmaps(made).collect()}
    assert set(got) == {0, 1}
    assert [(w.word, w.keep) for w in got[0].bitmap] == [(2, ~(1 << 2))]
    assert got[0].n_dropped == 1


# ---------------------------------------------------------------------------------- mixing
def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in fixed]
        left = total - sum(fixed.values())
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * sizes[s]]
        if not over:
            return {**fixed, **{s: weight[s] * level for s in open_}}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mix_meets_targets(docs, rows, nothing):
    got = mixing.mix(docs).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
    targets = brute_targets(sizes)
    assert sorted((r.doc_id, r.size) for r in got if r.doc_id is not None) == sorted((r.doc_id, count(r.text)) for r in rows if r.doc_id is not None)
    assert len(got) == len(rows)
    for source, size in sizes.items():
        mine = [r for r in got if r.source == source]
        assert all(r.source_size == size and abs(r.target - targets[source]) < 1e-6 for r in mine)
        assert all(0 <= r.taken <= 2 * r.size for r in mine)
        # Whole copies of one document of half the source's words cannot come nearer.
        sizes_here = sorted(r.size for r in mine if r.size)
        grain = sizes_here[-1] / 2 if sizes_here[-1] > sum(sizes_here) / 4 else sizes_here[0]
        assert abs(sum(r.taken for r in mine) - targets[source]) <= max(grain, 0.02 * targets[source])
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(7)).collect()))
    assert mixing.mix(nothing).count() == 0


def test_expand_repeats_rows_as_dealt(docs, rows, nothing):
    mixed = mixing.mix(docs)
    expanded = mixing.expand(docs, mixed)
    assert expanded.columns == docs.columns
    want = {}
    for r in mixed.collect():
        want[(r.doc_id, r.source)] = want.get((r.doc_id, r.source), 0) + r.copies
    have = {(r.doc_id, r.source): r["count"] for r in expanded.groupBy("doc_id", "source").count().collect()}
    assert have == {k: v for k, v in want.items() if v}
    assert mixing.expand(nothing, mixing.mix(nothing)).count() == 0


def test_rates_are_tilted_by_size(spark):
    made = spark.createDataFrame([Row(doc_id=k, text="a " * (10 * (1 + k % 10)), source="s") for k in range(1000)])
    got = mixing.mix(made, weights=(1.0,), share=0.5).groupBy("size").agg(F.avg("copies").alias("rate")).orderBy("size").collect()
    rates = [r.rate for r in got]
    assert rates == sorted(rates, reverse=True) and rates[0] > 2 * rates[-1]


# -------------------------------------------------------------------------------- sharding
def test_shards_and_slots(docs, rows, nothing):
    got = sharding.assign_shards(docs).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows if r.doc_id is not None
    )
    for shard in range(8):
        mine = [r.slot for r in got if r.shard == shard]
        assert sorted(mine) == list(range(len(mine)))
    by_id = {}
    for r in got:
        assert by_id.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)
        assert r.grown_shard in (r.shard, 8)
    assert sharding.assign_shards(nothing).count() == 0


def test_weighted_shards_take_their_part(spark):
    ids = spark.range(20_000)
    got = ids.select(sharding.rendezvous(F.col("id"), (1.0, 3.0)).alias("s")).groupBy("s").count().collect()
    assert abs({r.s: r["count"] for r in got}[1] / 20_000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), ())


# --------------------------------------------------------------------------- decontamination
def test_contamination_equals_brute_force(spark, docs, rows, nothing, monkeypatch):
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    items = [
        Row(item_id="10", text=" ".join((rows[0].text).split()[5:40]).upper() + "!"), Row(item_id="2", text=rows[2].text),
        Row(item_id="3", text="One"), Row(item_id="4", text=None), Row(item_id="5", text="..."), Row(item_id=None, text="two words here"),
        Row(item_id="6", text="É a"),
    ]
    table = spark.createDataFrame(items, "item_id string, text string")
    want = []
    for r in rows:
        w, hit, names = split.findall(lowered(r.text)), set(), set()
        for item in items:
            phrase = split.findall(lowered(item.text))
            size = min(10, len(phrase))
            windows = {tuple(phrase[i : i + size]) for i in range(len(phrase) - size + 1)} if phrase else set()
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
                    names |= {item.item_id} - {None}
        want.append((r.doc_id, len(w), len(hit), ",".join(sorted(names))))

    def result():
        found = decontaminate.contamination(docs, table)
        return sorted(
            (tuple(r) for r in found.select("doc_id", "n_words", decontaminate.words_hit("spans"), F.coalesce(F.array_join("items", ","), F.lit(""))).collect()),
            key=key,
        )

    assert result() == sorted(want, key=key)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 30)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 16)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 2_000)
    assert result() == sorted(want, key=key)
    assert decontaminate.contamination(nothing, table).count() == 0
    assert decontaminate.contamination(docs, table.where("false")).where("items is not null").count() == 0
    clean = decontaminate.without_contaminated(docs, table)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id,) for r in clean.collect()), key=key) == sorted(((x[0],) for x in want if not x[2]), key=key)


# -------------------------------------------------------------------------------- licences
def test_licences(spark, nothing):
    made = spark.createDataFrame(
        [
            Row(doc_id=1, text="some text\nLicensed under CC BY-NC 4.0.\nmore"), Row(doc_id=2, text=None), Row(doc_id=3, text=""),
            Row(doc_id=4, text="THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE; VERSION 3!"), Row(doc_id=5, text="license " * 30_000),
            Row(doc_id=6, text="a\n\n" + licenses.TEMPLATES["mpl-2.0-notice"].replace(". ", ".\n") + "\n\nb"), Row(doc_id=6, text="All rights"),
        ],
        "doc_id long, text string",
    )
    got = sorted((r.doc_id, [(m.license, round(m.dice, 3)) for m in r.matches]) for r in licenses.scan_licenses(made).collect())
    assert got[0] == (1, [("cc-by-nc-4.0-line", 1.0)])
    assert got[3] == (4, [("gpl-3.0-line", 1.0)])
    assert got[1][1] == got[2][1] == got[4][1] == [] and ("mpl-2.0-notice", 1.0) in got[6][1]
    assert licenses.scan_licenses(nothing).count() == 0
    low, high = licenses.size_bounds(10, 0.8)
    assert 2 * min(low, 10) / (low + 10) == pytest.approx(0.8) and 2 * 10 / (high + 10) == pytest.approx(0.8)


# ------------------------------------------------------------------------- learned operators
@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(2)
    made = []
    for k in range(600):
        text = sentence(rng, rng.randrange(20, 200))
        toxic, good = k % 5 == 0, k % 3 > 0
        if toxic:
            parts = text.split()
            for _ in range(rng.randrange(1, 6)):
                parts.insert(rng.randrange(len(parts)), rng.choice(["grumble", "blighter", "snarkox", "snarkuz"]) )
            text = " ".join(parts)
        if not good:
            text = text.replace(" ", "!! ").upper()
        made.append(Row(doc_id=k, text=text, quality=int(good), toxic=int(toxic)))
    made += [Row(doc_id=900, text=None, quality=None, toxic=None), Row(doc_id=901, text="", quality=None, toxic=None)]
    return spark.createDataFrame(made, "doc_id long, text string, quality int, toxic int").repartition(3).cache()


def test_quality_on_held_out_rows(graded, nothing):
    model = quality.train(graded.select("doc_id", "text"), graded.select("doc_id", "quality"))
    assert 0 < len(model.rules) < 200 and all(1 <= len(rule) <= quality.DEPTH for rule in model.rules)
    got = quality.quality(graded, model).join(graded.drop("text"), "doc_id")
    assert got.count() == 602 and got.where("score is null or score < 0 or score > 1").count() == 0
    out = got.where(samples.held_out(F.col("doc_id")) & F.col("quality").isNotNull())
    assert out.where("predicted <> quality").count() <= 0.03 * out.count()
    assert quality.quality(nothing, model).count() == 0
    even = quality.train(nothing.select("doc_id", "text"), graded.select("doc_id", "quality"))
    assert quality.quality(graded, even).select("score").distinct().count() == 1


def test_rule_columns_equal_rules(graded):
    model = quality.train(graded.select("doc_id", "text"), graded.select("doc_id", "quality"))
    rows = quality.with_statistics(graded, ["doc_id"]).withColumn("score", model.score()).collect()
    values = np.array([[r[name] for name in quality.STATISTICS] for r in rows])
    total = np.full(len(rows), model.intercept)
    for rule, weight in zip(model.rules, model.weights):
        total += weight * np.logical_and.reduce([c.holds(values) for c in rule])
    assert np.allclose(1 / (1 + np.exp(-total)), [r.score for r in rows])


def test_toxicity_on_held_out_rows(graded, nothing):
    model = toxicity.train(graded.select("doc_id", "text"), graded.select("doc_id", "toxic"))
    assert (np.diff(model.thresholds) > 0).all()
    got = toxicity.severity(graded, model).join(graded.select("doc_id", F.col("toxic").alias("label")), "doc_id")
    out = got.where(samples.held_out(F.col("doc_id")) & F.col("label").isNotNull())
    assert out.where("toxic <> (label = 1)").count() <= 0.03 * out.count()
    assert got.where("severity < 0 or severity > 3 or severity is null").count() == 0
    assert got.where("doc_id >= 900 and toxic").count() == 0
    kept = toxicity.without_toxic(graded, model)
    assert kept.columns == graded.columns and kept.count() == got.where("not toxic").count()
    assert toxicity.severity(nothing, model).count() == 0
    never = toxicity.train(nothing.select("doc_id", "text"), graded.select("doc_id", "toxic"))
    assert toxicity.severity(graded, never).where("toxic").count() == 0


def test_samples_are_bounded_and_leave_out_rows_out(graded):
    taken = samples.labelled_sample(graded.select("doc_id", "text"), graded.select("doc_id", "toxic"), "toxic", rows=50)
    assert taken.count() <= 50
    held = {r.text for r in graded.where(samples.held_out(F.col("doc_id"))).collect()}
    assert not held & {r.text for r in taken.collect()}


def test_secrets(spark, nothing):
    rng = random.Random(4)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    made, want = [], set()
    for k in range(300):
        text, path = sentence(rng, 30, "plain") + " abcdeabcdeabcdeabcde", "src/a.txt"
        if k % 3 == 0:
            value = hexes(40)
            text += f' token = "{value}" and more'
            want.add((k, value))
        if k % 7 == 0:
            text += " someverylongwordwithoutdigits antidisestablishment"
        made.append(Row(doc_id=k, text=text, path=path))
    made += [Row(doc_id=400, text=None, path=None), Row(doc_id=401, text="", path=None)]
    table = spark.createDataFrame(made, "doc_id long, text string, path string").repartition(2)
    forest = secrets.train(table)
    texts = {r.doc_id: r.text for r in made}
    got = {(r.doc_id, texts[r.doc_id].encode()[r.start : r.end].decode()) for r in secrets.scan_secrets(table, forest).collect()}
    assert len(want - got) <= 1 and len(got - want) <= 2
    assert secrets.scan_secrets(nothing.withColumn("path", F.lit(None).cast("string")), forest).count() == 0
    empty = secrets.train(table.where("false"))
    assert secrets.scan_secrets(table, empty).count() == 0


def test_secrets_are_learned_from_all_documents(spark, monkeypatch):
    """One secret among many documents, and more secrets than the bound: both classes take part."""
    rng = random.Random(8)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    made = [Row(doc_id=k, text=sentence(rng, 4, "plain") + " antidisestablishment" + "abcdefgh"[k % 8], path="a") for k in range(6_000)]
    order = {r.doc_id: k for k, r in enumerate(spark.range(6_000).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id")).collect())}
    last = max(order, key=order.get)
    key, token = "AKIA" + "QZ7XW2LM9KP4TR8V", hexes(40)
    made[last] = Row(doc_id=last, text=f'{key} and token = "{token}" end', path="a")
    table = spark.createDataFrame(made, "doc_id long, text string, path string").repartition(3)
    got = secrets.scan_secrets(table, secrets.train(table)).collect()
    assert {r.value_sha256 for r in got} == {hashlib.sha256(x.encode()).hexdigest() for x in (key, token)}
    # A forest that never saw a secret still keeps key formats.
    blind = secrets.train(table.where(F.col("doc_id") != last))
    assert [r.value_sha256 for r in secrets.scan_secrets(table, blind).collect()] == [hashlib.sha256(key.encode()).hexdigest()]
    # More secrets than the bound leave the false findings in the sample.
    monkeypatch.setattr(secrets, "STRATUM_FINDINGS", 20)
    many = spark.createDataFrame(
        [Row(doc_id=k, text=f'token = "{hexes(40)}" x antidisestablishment{"abcdefgh"[k % 8]} y', path="a") for k in range(100)], "doc_id long, text string, path string"
    )
    sampled = secrets.labelled_values(many).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in sampled} == {0: 8, 1: 20}
    assert secrets.scan_secrets(many, secrets.train(many)).count() == 100


def test_secret_candidates_of_every_form():
    def of(text):
        text = text.encode()
        return {text[a:b].decode() for a, b in secrets.spans(text)}

    assert of('password = "hunter2-XyZ!9"') == {"hunter2-XyZ!9"}
    assert of('password = "Tr0ub4dor&3xQ9!vLmP2"') == {"Tr0ub4dor&3xQ9!vLmP2"}
    assert of("pw: s3cr3tPass99, and") == {"s3cr3tPass99"}
    assert of("postgres://app:Zk83hfPq0sLw92XnVt@db.host/x") == {"Zk83hfPq0sLw92XnVt"}
    assert of("x postgres://app:p/a:s@db ftp://u:p@ss@h1 me:é1@host") == {"p/a:s", "p@ss", "é1"}
    assert of("see https://ghp_0123456789abcdefghijABCDEFGHIJ012345@github.com/") >= {"ghp_0123456789abcdefghijABCDEFGHIJ012345"}
    assert of("passphrase: 'correct horse 9 staple' Secret := \"é\"") == {"correct horse 9 staple", "é"}
    assert of("?token=ab1&password=de2 xoxb-1234567890") == {"ab1&password=de2", "ab1", "de2", "xoxb-1234567890"}
    assert of("password = ") == of("password = \"\"") == of("a@b.c http://h:80/x") == of("") == set()


def test_short_and_url_secrets_are_found(spark):
    rng = random.Random(12)
    letters = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnpqrstuvwxyz23456789!$%&*"
    made, want = [], set()
    for k in range(300):
        value = "".join(rng.choice(letters) for _ in range(7 + k % 9)) + "7xQ"
        end = (f' password = "{value}" and', f" postgres://app:{value}@db.host/x and", " password = required and", " see bob@db.host and")[k % 4]
        made.append(Row(doc_id=k, text=sentence(rng, 20, "plain") + end, path="a"))
        if k % 4 < 2:
            want.add((k, hashlib.sha256(value.encode()).hexdigest()))
    table = spark.createDataFrame(made, "doc_id long, text string, path string").repartition(2)
    got = {(r.doc_id, r.value_sha256) for r in secrets.scan_secrets(table, secrets.train(table)).collect()}
    assert len(want - got) <= 2 and len(got - want) <= 2


def test_word_statistics_equal_a_count_by_hand(spark):
    texts = ["Abcd abcde xab1cd", None, "", "a" * 20 + " éabcd ABCD", "q"]
    pairs, grams = secrets._word_counts(b" ".join(words.text_bytes(pa.array(texts))))
    want_pairs, want_grams = {}, {}
    for word in re.findall("[A-Za-z]+", " ".join(x or "" for x in texts)):
        for size, want in ((2, want_pairs), (4, want_grams)):
            for k in range(len(word) - size + 1 if len(word) < secrets.LEAST_LENGTH else 0):
                code = 0
                for c in word[k : k + size].lower():
                    code = code * 26 + ord(c) - 97
                want[code] = want.get(code, 0) + 1
    assert {int(k): int(pairs[k]) for k in np.flatnonzero(pairs)} == want_pairs
    assert {int(k): int(grams[k]) for k in np.flatnonzero(grams)} == want_grams


# ---------------------------------------------------------------------------------- vectors
def vectors(spark):
    rng = np.random.default_rng(9)
    made = []
    for k in range(300):
        made.append((k, rng.normal(size=16).tolist(), k % 3))
    crowd = rng.normal(size=16)
    for k in range(300, 420):
        made.append((k, (crowd + rng.normal(size=16) * 0.12).tolist(), 1))
    made += [(420, made[7][1], 1), (421, made[7][1], 1), (422, [2 * x for x in made[7][1]], 1), (423, made[7][1], 2)]
    made += [
        (500, None, 1), (501, [0.0] * 16, 1), (502, [float("nan")] * 16, 1), (503, [None, *[1.0] * 15], 1), (504, made[7][1], None),
        (505, [], 1), (506, [1.0, 2.0], 1), (507, [1.0, 2.0], 1), (508, [float("inf")] * 16, 1), (None, made[8][1], 2), (7, made[7][1], 1),
        (509, [0.0, 1.0], 2), (510, [-0.0, 1.0], 2),
    ]
    return made, spark.createDataFrame([(*m, "x", 1) for m in made], "vec_id long, embedding array<double>, label int, node string, cell int").repartition(3)


def brute_vectors(made, least=0.93):
    unit = []
    for _, e, label in made:
        fine = label is not None and e and all(x is not None and np.isfinite(x) for x in e) and np.linalg.norm(e) > 0
        unit.append(np.array(e) / np.linalg.norm(e) if fine else None)
    n, label = [0] * len(made), list(range(len(made)))
    pairs = [
        (i, j) for i, j in itertools.combinations(range(len(made)), 2)
        if unit[i] is not None and unit[j] is not None and made[i][2] == made[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least
    ]
    for i, j in pairs:
        n[i] += 1
        n[j] += 1
    for _ in range(12):
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    ids = {}
    for (i, _, _), k in zip(made, label):
        if i is not None:
            ids[k] = min(ids.get(k, i), i)
    return sorted(((m[0], c, ids.get(k)) for m, c, k in zip(made, n, label)), key=key)


@pytest.mark.parametrize("aim, most", [(512, 4096), (40, 64)])
def test_near_vectors_equal_brute_force(spark, monkeypatch, aim, most):
    monkeypatch.setattr(vector_dedup, "SHARD_AIM", aim)
    monkeypatch.setattr(vector_dedup, "SHARD_MOST", most)
    made, table = vectors(spark)
    got = vector_dedup.near_vectors(table).collect()
    want = brute_vectors(made)
    found, true = sum(r.n_links for r in got), sum(w[1] for w in want)
    assert found <= true and found >= 0.95 * true
    if most == 4096:
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


@pytest.mark.parametrize("most", [4096, 64])
def test_near_vectors_compare_all_when_the_search_finds_too_little(spark, monkeypatch, most):
    monkeypatch.setattr(vector_dedup, "SHARD_MOST", most)
    made, table = vectors(spark)
    nodes = vector_dedup.distinct_vectors(table.select("vec_id", "label", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("embedding")))
    exact = vector_dedup.linked_exactly(nodes, 0.93).groupBy("node").agg(F.sum("links").alias("links"))
    assert vector_dedup.audited_recall(nodes, exact, 0.93) == 1.0
    monkeypatch.setattr(vector_dedup, "audited_recall", lambda *_: 0.5)
    got = vector_dedup.near_vectors(table).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == brute_vectors(made)


def test_recall_counts_single_pairs_apart_from_crowds(spark):
    rng = np.random.default_rng(3)
    crowd, made = rng.normal(size=16), []
    for k in range(200):
        made.append((k, (crowd + rng.normal(size=16) * 0.01).tolist(), 1))
    for k in range(20):
        single = rng.normal(size=16)
        made += [(1000 + 2 * k + j, (single + rng.normal(size=16) * 0.01).tolist(), 1) for j in (0, 1)]
    nodes = vector_dedup.distinct_vectors(spark.createDataFrame(made, "vec_id long, embedding array<double>, label int")).cache()
    exact = vector_dedup.linked_exactly(nodes, 0.93).groupBy("node").agg(F.sum("links").alias("links"))
    assert vector_dedup.audited_recall(nodes, exact, 0.93) == 1.0
    # All pairs lost, the crowd found: more than 0.99 of all links.
    lost = exact.withColumn("links", F.when(F.col("links") > 100, F.col("links")).otherwise(0))
    assert vector_dedup.audited_recall(nodes, lost, 0.93) == 0.0


def test_pairs_of_two_shards_are_counted_if_the_first_shard_misses_them(spark):
    """Graphs without edges, whose search misses nearly all: pairs that meet in two shards are found and counted once."""
    made, table = vectors(spark)
    nodes = vector_dedup.distinct_vectors(table.where("size(embedding) = 16 and label = 1")).cache()
    middle = {(1, 16): np.linalg.qr(np.random.default_rng(1).normal(size=(16, 2)))[0].T}
    shards = vector_dedup.in_shards(nodes, middle, 2)
    edges = spark.createDataFrame([], "node long, neighbours array<long>")
    shards = shards.withColumn("cells", F.array(F.lit(0), F.lit(1)))
    exact = {r.node: r.links for r in vector_dedup.linked_exactly(nodes, 0.93).collect()}
    found = vector_dedup.linked_in_shards(shards, edges, 0.93).groupBy("node").agg(F.sum("links").alias("links"))
    assert {r.node: r.links for r in found.collect()} == exact


def test_near_vectors_of_an_empty_table(spark):
    assert vector_dedup.near_vectors(vectors(spark)[1].where("false")).count() == 0


# ---------------------------------------------------------------------------------- pipeline
def test_pipeline_on_small_tables(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, folder)
        if name not in ("mixing", "sharding"):
            assert docs.join(before, columns, "left_anti").count() == 0
        if name != "sharding":
            assert docs.columns == columns
            docs = docs.cache()
    assert docs.count() > 0 and docs.where("shard not between 0 and 7").count() == 0
    assert corpus_pipeline.run(spark, folder).count() == docs.count()

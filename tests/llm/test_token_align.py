"""Alignment of two tokenizers against brute force that uses the tokenizers' own libraries."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import Row

from attestry.llm import runs, token_align

A, B = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
DOCS = "doc_id long, text string, n_a string, radix int, part int"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    words = ["the", "corpus", "of", "Straße", "naïve", "日本語", "x1y2", "1234567", "don't", "we'll", "\n", "\t", "  "]
    made = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 200))) for _ in range(40)]
    made += [None, "", " ", "\n", "a", "▁under", "a▁b", "<|endoftext|> <s></s> <unk>", "<0x0A>", "é é ﬁ \u0000 ﻿"]
    made += [" " * 5_000 + "x", "\n" * 3_000, "ab" * 20_000, "日" * 3_000, "\U0001f469‍\U0001f680 ok", made[0], made[0]]
    return [*made, " ".join(rng.choice(words) for _ in range(60_000))]


def brute_force(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(A)
    a_side.encode_special_tokens = True
    b_side = SentencePieceProcessor(model_file=B)
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    decode = {chr(c): c for c in kept} | {
        chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in kept)
    }
    out, links, holders = [], [], collections.Counter()
    for doc, text in rows:
        tokens = [[], []]
        if text:
            for k in a_side.encode(" " + text, add_special_tokens=False).ids:
                tokens[0].append((k, bytes(decode[c] for c in a_side.id_to_token(k))))
            for k in b_side.encode(text):
                piece = b_side.id_to_piece(k)
                raw = bytes([int(piece[3:5], 16)]) if b_side.is_byte(k) else piece.replace("▁", " ").encode()
                tokens[1].append((k, raw))
            if any(b"".join(x for _, x in side) != (" " + text).encode() for side in tokens):
                tokens = [[], []]
        a, b = tokens
        i = j = at_a = at_b = 0
        groups, group = [], ([], [])
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                group[0].append(a[i][0])
                at_a, i = at_a + len(a[i][1]), i + 1
            else:
                group[1].append(b[j][0])
                at_b, j = at_b + len(b[j][1]), j + 1
            if at_a == at_b:
                groups.append(group)
                group = ([], [])
        found = collections.Counter()
        for x, y in groups:
            times_x, times_y = collections.Counter(x), collections.Counter(y)
            for p, m in times_x.items():
                for q, n in times_y.items():
                    found[p, q] += m * n
        links.append(found)
        holders.update(found.keys())
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append([doc, len(a), len(b), len(groups), sum(found.values()),
                    hashlib.sha256(written.encode()).hexdigest() if a else ""])
    largest = collections.Counter()
    for (p, _), n in holders.items():
        largest[p] = max(largest[p], n)
    return sorted(
        (*row[:5], sum(n for (p, q), n in found.items() if holders[p, q] == largest[p]),
         sum(n * holders[pair] for pair, n in found.items()), row[5])
        for row, found in zip(out, links)
    )


def figures(df):
    return sorted(tuple(row) for row in df.collect())


def documents(spark, texts, parts=5):
    rows = [Row(doc_id=k, text=t, n_a="clash", radix=-7, part=9) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def test_alignment_equals_brute_force(spark, texts):
    want = brute_force(list(enumerate(texts)))
    assert figures(token_align.align(documents(spark, texts), A, B)) == want
    assert sum(row[1] > 0 for row in want) > 40 and any(row[3] < row[1] for row in want)


def test_passes_blocks_and_portions_change_nothing(spark, texts, monkeypatch):
    for name, value in (
        ("PORTION_BYTES", 300), ("FAN_IN", 2), ("HELD_PAIRS", 4), ("BLOCK_PAIRS", 3), ("LINKS_AT_ONCE", 2),
    ):
        monkeypatch.setattr(token_align, name, value)
    few = [t for t in texts if t is None or len(t) < 600]
    assert figures(token_align.align(documents(spark, few, 3), A, B)) == brute_force(list(enumerate(few)))


def test_repeated_rows_null_ids_and_no_rows(spark):
    rows = [(None, "the same text"), (3, "the same text"), (3, "the same text")]
    got = token_align.align(spark.createDataFrame(rows, "doc_id long, text string"), A, B).collect()
    assert sorted((r.doc_id is None, r.n_a, r.count_sum) for r in got) == [(False, 3, 9)] * 2 + [(True, 3, 9)]
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_align.align(none, A, B).collect() == []


def test_supplied_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert figures(token_align.align(docs, A, B)) == brute_force(rows)


def test_merged_runs_sum_every_pair():
    rng = np.random.default_rng(2)
    blocks, true = [], collections.Counter()
    for _ in range(30):
        pairs = np.unique(rng.integers(0, 500, 60).astype(np.uint64))
        counts = rng.integers(1, 9, len(pairs)).astype(np.uint64)
        true.update(dict(zip(pairs.tolist(), counts.tolist())))
        for at in range(0, len(pairs), 7):
            part = slice(at, at + 7)
            blocks.append((int(pairs[at]), runs.pack(runs.ascending(pairs[part]), counts[part])))
    token_align_held, token_align.HELD_PAIRS = token_align.HELD_PAIRS, 20
    try:
        parts = list(token_align.merged_runs(iter(sorted(blocks))))
    finally:
        token_align.HELD_PAIRS = token_align_held
    pairs = np.concatenate([x for x, _ in parts]).tolist()
    counts = np.concatenate([x for _, x in parts]).tolist()
    assert len(parts) > 5 and pairs == sorted(true) and counts == [true[x] for x in pairs]


def test_blocks_keep_any_integers():
    arrays = [np.array([], np.uint32), np.array([1, 2**40], np.uint64), np.arange(5, dtype=np.uint16)]
    for want, got in zip(arrays, runs.unpack(runs.pack(*arrays), "<u4", "<u8", "<u2")):
        assert want.tolist() == got.tolist()

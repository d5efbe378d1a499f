import json
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from attestry.functions.ranking import ordered_positions
from attestry.operators.discover import (
    classify_responses,
    gold_standard_documents,
    html_links,
    join_url,
    run_status,
    sync_ledger,
    verra_documents,
)
from attestry.operators.replies import estimate_cost
from attestry.sources.manifest import (
    file_manifest,
    manifest_header,
    manifest_violations,
    read_manifest,
    sample_manifest,
    write_manifest,
)
from attestry.sources.tables import idempotent_append
from attestry.streaming.jobs import fold_batch, live_heads
from pyspark.sql import functions as F
from test_canonical import CANDIDATES, decision, fact_of

PAYLOAD = "registry string, project_id string, url string, discovered_at timestamp, body string"


def test_manifest_of_a_tree(spark, tmp_path):
    root = tmp_path / "tree"
    (root / "ACR125").mkdir(parents=True)
    (root / ".hidden").mkdir()
    (root / "ACR125" / "project.pdf").write_bytes(b"%PDF-")
    (root / "ACR125" / "notes.txt").write_bytes(b"hello")
    (root / "ACR125" / ".secret").write_bytes(b"x")
    (root / ".hidden" / "a.txt").write_bytes(b"x")
    rows = file_manifest(spark, str(root))
    got = {r.relative_path: (r.size_bytes, r.content_type, r.project_id) for r in rows.collect()}
    assert got == {
        "ACR125/project.pdf": (5, "application/pdf", "ACR125"),
        "ACR125/notes.txt": (5, "text/plain", "ACR125"),
    }
    header = manifest_header(rows).first()
    assert (header.row_count, header.total_bytes) == (2, 10)
    write_manifest(rows, str(tmp_path / "manifest"))
    assert read_manifest(spark, str(tmp_path / "manifest")).count() == 2
    assert manifest_violations(rows).isEmpty()


def test_sample_is_repeatable_and_strict(spark):
    rows = spark.createDataFrame([(f"f{n}",) for n in range(10)], "relative_path string")
    one = sample_manifest(rows, 3, 1, 1, seed=7).collect()
    two = sample_manifest(rows.repartition(5), 3, 1, 1, seed=7).collect()
    assert sorted(one) == sorted(two)
    counts = {s: sum(r.sample_split == s for r in one) for s in ("development", "validation", "test")}
    assert counts == {"development": 3, "validation": 1, "test": 1}
    with pytest.raises(Exception, match="samples were requested"):
        sample_manifest(rows, 8, 2, 1).collect()
    with pytest.raises(ValueError):
        sample_manifest(rows, 0, 0, 0)


def test_positions_in_groups_of_any_size(spark):
    rows = [("hot", n, str(n)) for n in range(500)] + [("cold", n, "c") for n in range(3)]
    df = spark.createDataFrame(rows, "k string, n int, v string")
    out = ordered_positions(
        df, ["k"], ["n"], "p", previous={"v": "before"}, carried={"v": "kept"}
    )
    for row in out.collect():
        assert row.p == row.n + 1
        expected = None if row.n == 0 else (str(row.n - 1) if row.k == "hot" else "c")
        assert (row.before, row.kept) == (expected, expected)


def test_append_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "results")

    def run(value, run_id):
        return spark.createDataFrame(
            [(1, value, run_id)], "key int, value string, pipeline_run_id string"
        )

    idempotent_append(run("a", "one"), path, ["key"])
    reused, conflicts = idempotent_append(run("a", "two"), path, ["key"])
    assert (reused.count(), conflicts.count()) == (1, 0)
    _, conflicts = idempotent_append(run("b", "three"), path, ["key"])
    assert conflicts.count() == 1
    assert spark.read.parquet(path).count() == 1


def test_anchor_documents(spark):
    html = (
        '<a name="top">x</a><p><a href="/files/a.pdf">The <b>report</b></a> '
        '<a class="c" href=\'page.html\'>plain</a><a href="b?x=1&amp;y=2">see b.PDF</a>'
        '<!-- <a href="c.pdf">c</a> --><a href="open.pdf">never closed'
    )
    rows = [("acr", "7", "https://r.example/x/index.html", None, html)]
    got = html_links(spark.createDataFrame(rows, PAYLOAD)).orderBy("document_id").collect()
    assert [(r.document_id, r.title, r.url) for r in got] == [
        ("acr-7-1", "The  report", "https://r.example/files/a.pdf"),
        ("acr-7-3", "see b.PDF", "https://r.example/x/b?x=1&y=2"),
    ]


@pytest.mark.parametrize(
    "link", ["a.pdf", "/a", "../a", "./a", "//h.example/a", "?q=1", "#f", "https://o.example/z", "../../../a"]
)
def test_url_joining(spark, link):
    from urllib.parse import urljoin

    base = "https://r.example/x/y/index.html?k=v"
    row = spark.range(1).select(join_url(F.lit(base), F.lit(link)).alias("u")).first()
    assert row.u == urljoin(base, link)


def test_json_documents(spark):
    groups = {"documentGroups": [{"documents": [
        {"id": 42, "uri": "f/a.pdf", "documentName": "PD", "version": "3"}, {"id": 1, "uri": None},
        {"uri": "/b"},
    ]}]}
    rows = spark.createDataFrame([("verra", "1", "", None, json.dumps(groups))], PAYLOAD)
    got = [(r.document_id, r.title, r.url, r.declared_version) for r in verra_documents(rows).collect()]
    assert got == [
        ("42", "PD", "https://registry.verra.org/f/a.pdf", "3"),
        ("/b", "/b", "https://registry.verra.org/b", None),
    ]
    requests = {"requests": [{"documents": [{"id": 9, "name": "Report"}, {"name": "none"}]}]}
    rows = spark.createDataFrame([("gold_standard", "1", "", None, json.dumps(requests))], PAYLOAD)
    only = gold_standard_documents(rows).collect()
    assert [(r.document_id, r.url.endswith("/documents/9/download")) for r in only] == [("9", True)]


def test_response_classes(spark):
    rows = [
        (1, 200, "text/html; charset=utf-8", "<html></html>"), (2, 403, "", ""),
        (3, 200, "application/json", "{}"), (4, 200, "application/json", "{"),
        (5, 200, "text/html", "Invalid Page"), (6, 500, "", ""), (7, None, None, None),
        (8, 200, "application/json", '"' + "x" * 2_000_000 + '"'), (9, 200, "image/png", "x"),
    ]
    df = spark.createDataFrame(rows, "n int, http_status int, content_type string, body string")
    got = {r.n: (r.status, r.error_code) for r in classify_responses(df).collect()}
    assert got == {
        1: ("endpoint_mismatch", "html_instead_of_data"), 2: ("blocked", "http_403"),
        3: ("ok", None), 4: ("endpoint_mismatch", "invalid_json"),
        5: ("not_found", "html_not_found"), 6: ("transient_failure", "http_500"),
        7: ("transport_failure", "network_error"), 8: ("endpoint_mismatch", "response_too_large"),
        9: ("endpoint_mismatch", "unexpected_content_type"),
    }


def test_failed_page_keeps_the_cursor(spark):
    start = datetime(2024, 1, 1)
    runs = spark.createDataFrame(
        [("r1", "acr", None, "c1", 2, start), ("r2", "acr", "c1", "c2", 2, start + timedelta(1))],
        "sync_run_id string, registry string, cursor_before string, next_cursor string, "
        "discovered_projects int, finished_at timestamp",
    )
    failures = spark.createDataFrame([("r2", "p1")], "sync_run_id string, scope string")
    row = sync_ledger(run_status(failures, runs)).first()
    assert (row.last_run_id, row.last_status, row.cursor) == ("r2", "partial", "c1")
    clean = sync_ledger(run_status(failures.limit(0), runs)).first()
    assert (clean.last_status, clean.cursor) == ("succeeded", "c2")


def test_costs_are_exact_decimals(spark):
    calls = spark.createDataFrame([(1212, 223)], "input_tokens int, output_tokens int")
    row = estimate_cost(calls, Decimal("0.15"), Decimal("0.60"), Decimal("0.0001")).first()
    assert row.estimated_cost_usd == Decimal("0.000315600000") and not row.within_ceiling
    with pytest.raises(ValueError):
        estimate_cost(calls, Decimal("-1"), Decimal("0"))


def test_batches_of_decisions_can_be_run_again(spark, tmp_path):
    from attestry.schemas import DECISIONS

    target = str(tmp_path / "heads")
    start = datetime(2024, 1, 1)
    candidates = spark.createDataFrame([("c", "verra", "p", "country")], CANDIDATES)
    one = spark.createDataFrame(
        [decision("a", "c", "approved", None, start, "country", "First")], DECISIONS
    )
    two = spark.createDataFrame(
        [
            decision("a", "c", "approved", None, start, "country", "First"),
            decision("b", "c", "approved", fact_of("a"), start + timedelta(1), "country", "Second"),
        ],
        DECISIONS,
    )
    fold_batch(one, 0, candidates, None, target)
    for _ in range(2):
        fold_batch(two, 1, candidates, None, target)
        head = live_heads(spark, target).collect()
        assert [(h.fact_id, h.value_json) for h in head] == [(fact_of("b"), '"Second"')]
    outcomes = spark.read.parquet(f"{target}/outcomes")
    got = {(r.batch_id, r.decision_id): r.outcome for r in outcomes.collect()}
    assert got == {(0, "a"): "approved", (1, "a"): "reused", (1, "b"): "approved"}

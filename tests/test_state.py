"""State in key buckets: what a batch reads, what a repeated or broken batch leaves, and equal folds."""

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from attestry.operators.canonical import fold_decisions
from attestry.schemas import DECISIONS
from attestry.session import drop_stages, materialize, stage_root
from attestry.sources.state import BatchState
from attestry.streaming import jobs
from test_canonical import CANDIDATES, FIELDS, VERDICTS, decision, fact_of

ROWS = "k string, n int"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROWS)


def write(spark, target, batch, *pairs, **options):
    state = BatchState(spark, target, batch, buckets=8, **options)
    state.add("t", rows(spark, *pairs), ["k"], options.pop("fold", None))
    state.commit()
    return state


def stored(spark, target):
    return sorted((r.k, r.n) for r in BatchState(spark, target, None).read("t", rows(spark).schema).collect())


def test_a_batch_scans_only_the_buckets_of_its_keys(spark, tmp_path):
    target = str(tmp_path / "state")
    write(spark, target, 0, *[(f"k{n}", n) for n in range(200)])
    write(spark, target, 1, *[(f"k{n}", -n) for n in range(5)])
    state = BatchState(spark, target, 2)
    assert state.buckets == 8
    touched = state.touched(rows(spark, ("k3", 0), ("k3", 1)), ["k"])
    assert len(touched) == 1
    scan = state.read("t", rows(spark).schema, touched)
    plan = scan._jdf.queryExecution().explainString(
        scan.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    filters = re.search(r"PartitionFilters: (.*)", plan)[1]
    assert set(re.findall(r"key_bucket#\d+ = (\d+)", filters)) == {str(touched[0])}
    files = {r.f for r in scan.select(F.input_file_name().alias("f")).collect()}
    assert {re.search(r"key_bucket=(\d+)", f)[1] for f in files} == {str(touched[0])}
    assert {("k3", 3), ("k3", -3)} <= {(r.k, r.n) for r in scan.collect()}


def test_repeated_and_broken_batches_leave_one_state(spark, tmp_path):
    target = str(tmp_path / "state")
    write(spark, target, 0, ("a", 1), ("b", 2))
    broken = BatchState(spark, target, 1, buckets=8)
    broken.add("t", rows(spark, ("c", 3), ("x", 9)), ["k"])
    assert stored(spark, target) == [("a", 1), ("b", 2)]  # not committed
    for _ in range(2):
        write(spark, target, 1, ("c", 3))
        assert stored(spark, target) == [("a", 1), ("b", 2), ("c", 3)]
    write(spark, target, 2)
    assert stored(spark, target) == [("a", 1), ("b", 2), ("c", 3)]


def test_full_buckets_are_rewritten_and_old_folders_go(spark, tmp_path):
    target = str(tmp_path / "state")
    fold = lambda df: df.groupBy("k").agg(F.max("n").cast("int").alias("n"))
    for batch in range(12):
        state = BatchState(spark, target, batch, buckets=2, most_batches=3)
        state.add("t", rows(spark, ("a", batch), (f"k{batch}", batch)), ["k"], fold)
        state.commit()
        again = BatchState(spark, target, batch, buckets=2, most_batches=3)  # and once more
        again.add("t", rows(spark, ("a", batch), (f"k{batch}", batch)), ["k"], fold)
        again.commit()
        latest = {}
        for k, n in stored(spark, target):
            latest[k] = max(n, latest.get(k, -1))
        assert latest == {"a": batch, **{f"k{n}": n for n in range(batch + 1)}}
    folders = list((tmp_path / "state" / "t").glob("batch_id=*/key_bucket=*"))
    assert len(folders) < 2 * 8
    assert len(list((tmp_path / "state" / "commits").glob("batch_id=*"))) <= 3


def random_log(rng, projects, steps):
    made, fields = [], {}
    start = datetime(2024, 1, 1)
    for project in range(projects):
        known = {f: [None] for f in FIELDS}
        for step in range(steps):
            field = rng.choice(FIELDS[1:] * 3 + FIELDS)
            cid = f"c{project}-{field}"
            fields[cid] = ("verra", f"p{project}", field)
            did = f"d{project}-{step}"
            made.append(
                decision(did, cid, "approved", rng.choice(known[field][-2:]), start + timedelta(minutes=step),
                         field, f"20{rng.randrange(18, 24)}-01-01")
            )
            known[field].append(fact_of(did))
    return made, fields


def test_batches_of_any_cut_give_the_heads_of_one_fold(spark, tmp_path):
    rng = random.Random(9)
    made, fields = random_log(rng, 6, 30)
    candidates = spark.createDataFrame([(c, *s) for c, s in fields.items()], CANDIDATES)
    whole = fold_decisions(
        spark.createDataFrame(made, DECISIONS), candidates, spark.createDataFrame([], VERDICTS)
    )[2]
    want = sorted((r.project_id, r.field_name, r.fact_id, r.value_json) for r in whole.collect())
    made.sort(key=lambda r: r[8])
    for batch, (low, high) in enumerate(((0, 40), (40, 110), (110, 180))):
        part = spark.createDataFrame(made[low:high], DECISIONS)
        for _ in range(2 if batch == 1 else 1):
            jobs.fold_batch(part, batch, candidates, None, str(tmp_path / "heads"), buckets=4)
    got = jobs.live_heads(spark, str(tmp_path / "heads")).collect()
    assert sorted((r.project_id, r.field_name, r.fact_id, r.value_json) for r in got) == want


ARRIVALS = (
    "registry string, registry_project_id string, source_url string, document_type string, title string, "
    "sha256 string, content_type string, file_name string, byte_size bigint, declared_version string, retrieved_at timestamp"
)


def test_arrivals_are_versions_once_whatever_the_batches(spark, tmp_path):
    def arrival(url, sha, day, title="T"):
        return ("verra", "1", url, "pdd", title, sha, "application/pdf", f"{sha}.pdf", 5, None, datetime(2024, 1, day))

    target = str(tmp_path / "ingest")
    one = spark.createDataFrame([arrival("u", "a", 1), arrival("u", "a", 2), arrival("v", "a", 1)], ARRIVALS)
    two = spark.createDataFrame([arrival("u", "a", 3), arrival("u", "b", 3), arrival("u", "c", 3, "Other")], ARRIVALS)
    jobs.ingest_batch(one, 0, target, buckets=4)
    for _ in range(2):
        jobs.ingest_batch(two, 1, target, buckets=4)
        got = jobs.stored_versions(one, target).collect()
        assert sorted(r.sha256 for r in got) == ["a", "a", "b"]
    assert [r.rule for r in spark.read.parquet(f"{target}/conflicts").collect()] == ["source_metadata_conflict"]


def test_stages_go_when_replaced_and_at_the_end(spark):
    first = materialize(spark.range(5).toDF("n"))
    second = materialize(first.where("n > 2"), instead_of=[first])
    assert second.count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(first._stage_path).count()
    other = stage_root(spark)
    assert second._stage_path.startswith(other)
    drop_stages(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        spark.read.parquet(second._stage_path).count()

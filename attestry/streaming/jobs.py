"""Two incremental jobs: versions from arriving files, heads from arriving decisions.

State lies in key buckets (``sources/state.py``): a micro-batch reads the buckets of its own keys and
nothing else, and a batch that is run again after a failure leaves the same tables behind. What the
jobs only report (conflicts, outcomes, facts) goes to one ``batch_id`` folder per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from attestry.operators.canonical import current_heads, facts_of, fold_decisions, replacement_verdicts
from attestry.operators.versions import ingest_versions, source_id
from attestry.schemas import FACTS
from attestry.session import materialize
from attestry.sources.state import BUCKETS, BatchState


SOURCE, PROJECT, DECISION = ["source_document_id"], ["registry", "project_id"], ["decision_id"]
LOG = "decision_id string, payload_hash string"


def _write(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _ingest_schemas(batch: DataFrame) -> tuple[StructType, StructType]:
    spark = batch.sparkSession
    sources, versions, _, _ = ingest_versions(
        batch.limit(0), spark.createDataFrame([], "source_document_id string, title string"),
        spark.createDataFrame(
            [], "source_document_id string, sha256 string, document_version_id string"
        ),
    )
    return sources.schema, versions.schema


def ingest_batch(batch: DataFrame, batch_id: int, target: str, buckets: int = BUCKETS) -> None:
    """Add the sources and versions of one micro-batch that are not known yet."""
    state = BatchState(batch.sparkSession, target, batch_id, buckets)
    source_schema, version_schema = _ingest_schemas(batch)
    touched = state.touched(batch.select(source_id().alias("source_document_id")), SOURCE)
    new_sources, new_versions, _, conflicts = ingest_versions(
        batch, state.read("sources", source_schema, touched), state.read("versions", version_schema, touched)
    )
    state.add("sources", new_sources, SOURCE)
    state.add("versions", new_versions, SOURCE)
    _write(conflicts, f"{target}/conflicts", batch_id)
    state.commit()


def stored_versions(arriving: DataFrame, target: str) -> DataFrame:
    """All versions stored so far; ``arriving`` gives the layout."""
    return BatchState(arriving.sparkSession, target, None).read("versions", _ingest_schemas(arriving)[1])


def stream_ingest(
    arriving: DataFrame, target: str, checkpoint: str, buckets: int = BUCKETS
) -> StreamingQuery:
    """Follow a streaming DataFrame of arrivals; every content becomes one version, once."""
    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, batch_id: ingest_batch(batch, batch_id, target, buckets))
        .start()
    )


def fold_batch(
    batch: DataFrame,
    batch_id: int,
    candidates: DataFrame,
    pages: DataFrame | None,
    target: str,
    verdicts: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> None:
    """Apply one micro-batch of decisions on top of the heads of the projects it touches.

    The batch continues from the stored heads and log instead of folding the history again. Heads are
    read in the buckets of the touched projects, the log in those of the batch's decision ids. What
    bars an approval is either checked against ``pages`` or given as ``verdicts`` (decision_id,
    created_at, blocked_codes).
    """
    spark = batch.sparkSession
    none = spark.createDataFrame(
        [], "decision_id string, created_at timestamp, blocked_codes array<string>"
    )
    if verdicts is None:
        verdicts = none if pages is None else replacement_verdicts(batch, candidates, pages)
    else:
        verdicts = verdicts.join(batch.select("decision_id").distinct(), "decision_id", "left_semi")
    touched = (
        batch.select("candidate_id")
        .distinct()
        .join(candidates.select("candidate_id", *PROJECT), "candidate_id")
        .select(*PROJECT)
        .distinct()
    )
    state = BatchState(spark, target, batch_id, buckets)
    fact_schema, log_schema = (spark.createDataFrame([], x).schema for x in (FACTS, LOG))
    stored = state.read("heads", fact_schema, state.touched(touched, PROJECT))
    heads = current_heads(stored.join(touched, PROJECT, "left_semi"))
    log = state.read("log", log_schema, state.touched(batch, DECISION)).join(
        batch.select("decision_id").distinct(), "decision_id", "left_semi"
    )
    new_outcomes, new_facts, _ = fold_decisions(batch, candidates, verdicts, heads, log)
    new_outcomes = materialize(new_outcomes)
    new_facts = facts_of(new_outcomes)
    _write(new_outcomes, f"{target}/outcomes", batch_id)
    _write(new_facts, f"{target}/facts", batch_id)
    logged = new_outcomes.where("outcome IN ('approved', 'rejected', 'unresolved')")
    latest = lambda facts: current_heads(facts).select(*fact_schema.names)
    state.add("heads", latest(new_facts), PROJECT, fold=latest)
    state.add("log", logged.select(*log_schema.names), DECISION)
    state.commit()


def live_heads(spark: SparkSession, target: str) -> DataFrame:
    """Current heads after the newest committed batch."""
    schema = spark.createDataFrame([], FACTS).schema
    return current_heads(BatchState(spark, target, None).read("heads", schema))


def stream_heads(
    decisions: DataFrame,
    candidates: DataFrame,
    pages: DataFrame | None,
    target: str,
    checkpoint: str,
    verdicts: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep heads current from a streaming DataFrame of decisions."""
    return (
        decisions.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(
            lambda batch, batch_id: fold_batch(
                batch, batch_id, candidates, pages, target, verdicts, buckets
            )
        )
        .start()
    )

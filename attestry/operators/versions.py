"""Source documents and their content versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.catalog import REPROCESS_STAGES
from attestry.functions.ranking import ordered_positions
from attestry.functions.values import uuid5

SOURCE_IDENTITY = ("registry", "registry_project_id", "source_url", "document_type")


def source_id() -> Column:
    return uuid5(F.concat(F.lit("source:"), F.concat_ws("|", *SOURCE_IDENTITY)))


def version_id() -> Column:
    return uuid5(F.concat_ws(":", F.lit("version"), "source_document_id", "sha256"))


def ingest_versions(
    incoming: DataFrame, sources: DataFrame, versions: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(new sources, new versions, duplicates, conflicts) for a batch of arriving contents.

    ``incoming`` has the source identity columns, title, sha256, content_type, file_name, byte_size,
    declared_version, retrieved_at. Within a source equal content is one version, kept from its
    earliest arrival; every other arrival is a duplicate that names the version it repeats. The
    stored title of a source, or else that of its earliest arrival, is its title; each arrival with
    another title is a conflict (source, hash, file name) and is not taken, the others are. All steps are partial aggregates or joins on (source, hash), so a source with a third of
    all arrivals still spreads over its hashes.
    """
    arrivals = incoming.withColumn("source_document_id", source_id())
    order = F.struct("retrieved_at", "file_name", "byte_size", "content_type", "declared_version")
    described = arrivals.groupBy("source_document_id", *SOURCE_IDENTITY).agg(
        F.min(F.struct(order.alias("order"), "title")).alias("_first"),
        F.min("retrieved_at").alias("discovered_at"),
    )
    stored = sources.select(
        "source_document_id", F.col("title").alias("_stored"), F.lit(True).alias("_known")
    )
    named = described.join(stored, "source_document_id", "left").withColumn(
        "_title", F.when(F.col("_known"), F.col("_stored")).otherwise(F.col("_first.title"))
    )
    new_sources = named.where("_known IS NULL").select(
        "source_document_id", *SOURCE_IDENTITY, F.col("_title").alias("title"), "discovered_at"
    )

    judged = arrivals.join(named.select("source_document_id", "_title"), "source_document_id")
    same = F.col("title").eqNullSafe(F.col("_title"))
    conflicts = judged.where(~same).select(
        "source_document_id", "sha256", "file_name", F.lit("source_metadata_conflict").alias("rule")
    )
    accepted = judged.where(same).withColumn("document_version_id", version_id())
    key = ["source_document_id", "sha256"]
    firsts = accepted.groupBy(*key, "document_version_id").agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("arrivals")
    )
    known = versions.select(*key, F.col("document_version_id").alias("_kept"))
    placed = firsts.join(known, key, "left")
    new_versions = placed.where("_kept IS NULL").select(
        "document_version_id", *key, "first.*"
    )
    duplicates = placed.select(
        *key,
        F.coalesce("_kept", "document_version_id").alias("document_version_id"),
        F.when(F.col("_kept").isNull(), F.col("arrivals") - 1)
        .otherwise(F.col("arrivals"))
        .alias("duplicates"),
    ).where("duplicates > 0")
    return new_sources, new_versions, duplicates, conflicts


def version_history(versions: DataFrame) -> DataFrame:
    """Versions of a source in retrieval order, each with the hash that came before it."""
    return ordered_positions(
        versions,
        ["source_document_id"],
        ["retrieved_at", "document_version_id"],
        "version_number",
        previous={"sha256": "previous_sha256"},
    )


def object_keys(versions: DataFrame) -> DataFrame:
    """Add the storage key of a version; unsafe or empty components give no key but a rule."""
    parts = ("registry", "project_id", "document_type", "document_version", "sha256")
    unsafe = F.lit(False)
    for part in parts:
        value = F.col(part)
        unsafe = unsafe | F.coalesce(
            (F.length(value) == 0) | value.contains("/") | value.contains(".."), F.lit(True)
        )
    return versions.withColumns(
        {
            "object_key": F.when(~unsafe, F.concat_ws("/", *parts)),
            "rule": F.when(unsafe, "unsafe_component"),
        }
    )


def reprocess_gate(
    versions: DataFrame, version_stages: DataFrame, predecessors: DataFrame
) -> DataFrame:
    """Which stages each of ``versions`` still needs before its facts may be promoted.

    ``version_stages`` has (document_version_id, stage) with repeats allowed; ``predecessors`` maps
    a version to the one before it and has no row for a first version. One flag per required stage is aggregated, so repeats and hot
    versions combine before the shuffle.
    """
    flags = {f"_{s}": F.max(F.col("stage") == s) for s in REPROCESS_STAGES}
    done = version_stages.groupBy("document_version_id").agg(
        *[flag.alias(name) for name, flag in flags.items()],
        F.max(~F.col("stage").isin(*REPROCESS_STAGES)).alias("_unknown"),
    )
    stages = lambda present: F.array_compact(
        F.array(
            *[
                F.when(F.coalesce(F.col(f"_{s}"), F.lit(False)) == present, s)
                for s in REPROCESS_STAGES
            ]
        )
    )
    gated = (
        versions.select("document_version_id")
        .join(predecessors, "document_version_id", "left")
        .join(done, "document_version_id", "left")
    )
    same = F.col("previous_document_version_id") == F.col("document_version_id")
    return gated.select(
        "document_version_id",
        "previous_document_version_id",
        stages(True).alias("completed_stages"),
        stages(False).alias("missing_stages"),
        F.when(F.coalesce("_unknown", F.lit(False)), "unknown_stage")
        .when(F.coalesce(same, F.lit(False)), "version_equals_predecessor")
        .alias("rule"),
    ).withColumn("promotable", (F.size("missing_stages") == 0) & F.col("rule").isNull())

"""Headline queries on whole tables; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores, BENCH_QUERIES a comma-separated
choice of registered queries. The supplied files have one row group each, which one task reads; they
are first laid out, untimed, in as many files as there are cores, as a table of any size would be.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from attestry import build_session
from attestry.plans import review_queries  # noqa: F401  (registers its queries)
from attestry.plans.queries import QUERIES
from attestry.sources.adapters import TABLES

HEADLINES = (
    "keyword_totals",
    "keyword_scores",
    "text_quality",
    "ocr_routing",
    "regex_extraction",
    "ingest_new_versions",
    "version_history",
    "evidence_grounding",
    "candidate_validation",
    "consistency_issues",
    "canonical_heads",
    "review_queue",
    "review_metrics",
    "readiness",
    "business_gates",
    "consistency_links",
    "reply_observations",
    "extractor_comparison",
    "gold_aggregate",
    "page_selection",
    "html_links",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = build_session("bench", cores=cores)
    spark.sparkContext.setLogLevel("ERROR")
    laid_out = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    for name in TABLES:
        source = spark.read.parquet(f"{folder}/{name}.parquet")
        source.repartition(2 * cores).write.parquet(f"{laid_out}/{name}.parquet")
    seconds = {}
    for name in names:
        began = time.perf_counter()
        QUERIES[name](spark, laid_out).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

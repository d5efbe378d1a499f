"""Views that give the supplied tables the shapes the operators work on.

The SQL texts use only what Spark and DuckDB spell the same, so a checker can build the very same
inputs in either engine. ``{name}`` stands for a table. All adapters read whole tables; conditions on
keys only decide *which* rows are faulty, late or without a partner, so that every outcome occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestry.operators.canonical import fact_id
from attestry.operators.extract import IDENTITY, page_block
from attestry.schemas import EVIDENCE

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Run adapter SQL over the tables it names."""
    named = {n: table(spark, folder, n) for n in TABLES if "{" + n + "}" in sql}
    return spark.sql(sql, **named)


# One line item is one page of the order's document, with one recorded candidate on it.
_S = "CAST({} AS STRING)"
_QTY = "CAST(CAST(l_quantity AS INT) AS STRING)"
_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
CARBON_TEXT = f"""
'Project title: Plant ' || CAST(l_partkey AS STRING) || ' Wind Farm' || chr(10)
|| CASE WHEN l_linenumber % 3 = 0
   THEN 'Project owner: Supplier ' || CAST(l_suppkey AS STRING) || ' Ltd' || chr(10) ELSE '' END
|| CASE WHEN l_linenumber % 2 = 1
   THEN 'Installed capacity: ' || {_QTY} || '.5 MW' || chr(10) ELSE '' END
|| CASE WHEN l_returnflag = 'A' THEN 'Emission Reductions: ' || {_QTY} || ',000' || chr(10)
        WHEN l_returnflag = 'R' THEN 'Baseline Emissions = ' || {_QTY} || '00.25' || chr(10)
        ELSE 'Leakage: 0' || chr(10) END
|| CASE WHEN l_linestatus = 'O' THEN 'Crediting period start: ' || {_DAY} || chr(10)
        WHEN l_linenumber = 2 THEN 'Crediting period end: 03/04/2020' || chr(10)
        WHEN l_linenumber = 4 THEN 'Crediting period end: 2027' || chr(10)
        ELSE 'Crediting period: ' || CAST(l_linenumber + 3 AS STRING) || ' years' || chr(10) END
|| 'Host country: Land ' || CAST(l_suppkey % 25 AS STRING) || chr(10)
|| CASE WHEN l_partkey % 5 = 0 THEN 'Methodology AMS-I.D is used' || chr(10)
        WHEN l_partkey % 5 < 3 THEN 'Methodology ACM0002 applies' || chr(10) ELSE '' END
|| CASE WHEN l_partkey % 7 = 0 THEN 'The plant is Grid-Connected.' || chr(10) ELSE '' END
"""
_CLASS = "(l_partkey % 16)"
FIELD_OF_CLASS = (
    "installed_capacity_mw",
    "installed_capacity_mw",
    "crediting_period_start",
    "crediting_period_end",
    "registered_date",
    "country",
    "crediting_period_years",
    "pe_applicable_flag",
    "pe_value_tco2e",
    "electricity_generated_mwh",
    "electricity_exported_mwh",
    "baseline_assumptions_table",
    "methodology_name",
    "validator_name",
    "verification_period_start",
    "be_value_tco2e",
)
_FIELD = (
    f"CASE {_CLASS} "
    + " ".join(f"WHEN {n} THEN '{field}'" for n, field in enumerate(FIELD_OF_CLASS))
    + " END"
)
_RAW = f"""CASE {_CLASS}
 WHEN 0 THEN {_QTY} || '.0' WHEN 1 THEN CASE WHEN l_linenumber = 7 THEN '-' ELSE '' END || {_QTY}
 WHEN 2 THEN {_DAY}
 WHEN 3 THEN CASE l_linenumber WHEN 3 THEN '03/04/2020' WHEN 5 THEN '2020-02-30' ELSE {_DAY} END
 WHEN 4 THEN CASE WHEN l_linenumber = 6 THEN '2021' ELSE {_DAY} END
 WHEN 5 THEN 'Land ' || CAST(l_suppkey % 3 AS STRING)
 WHEN 6 THEN CAST(l_linenumber + 3 AS STRING)
 WHEN 7 THEN CASE WHEN l_linenumber % 2 = 0 THEN 'true' ELSE 'false' END
 WHEN 8 THEN CAST(l_suppkey % 3 AS STRING) || '.0'
 WHEN 9 THEN {_QTY} || '.25' WHEN 10 THEN {_QTY} || '.75'
 WHEN 11 THEN 'true'
 WHEN 12 THEN CASE WHEN l_linenumber = 6 THEN 'AMS-I.D' ELSE 'ACM0002' END
 WHEN 14 THEN {_DAY}
 WHEN 15 THEN CASE WHEN l_linenumber = 1 THEN '-5.0' ELSE {_QTY} || '.0' END
 END"""
_TYPE = f"""CASE WHEN {_CLASS} IN (0, 8, 9, 10) THEN 'double' WHEN {_CLASS} IN (1, 6) THEN 'int'
 WHEN {_CLASS} IN (7, 11) THEN 'bool' WHEN {_CLASS} = 13 THEN NULL
 WHEN {_CLASS} = 15 THEN CASE WHEN l_linenumber = 2 THEN 'string' ELSE 'double' END
 ELSE 'string' END"""
_UNIT = f"""CASE WHEN {_CLASS} < 2 THEN CASE WHEN l_linenumber = 2 THEN NULL ELSE 'MW' END
 WHEN {_CLASS} = 6 THEN 'years'
 WHEN {_CLASS} IN (8, 15) THEN CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE 'tCO2e' END
 WHEN {_CLASS} = 9 THEN 'MWh'
 WHEN {_CLASS} = 10 THEN CASE WHEN l_suppkey % 5 = 0 THEN 'kWh' ELSE 'MWh' END END"""
_PAGE = "((l_partkey * 8 + l_linenumber) * 1000 + l_suppkey % 1000)"
_PROJECT = "(l_orderkey - l_orderkey % 8)"

RECORDED = f"""
SELECT registry, project_id, parsed_document_id, document_version_id, extraction_run_id,
  validation_run_id, page_number, carbon || 'Recorded value: ' || coalesce(raw_value, '-') || chr(10)
    AS text,
  observation_index, field_name, raw_value, value_type,
  CASE WHEN value_type = 'string' THEN '"' || raw_value || '"' ELSE raw_value END AS value_json,
  unit, confidence,
  CASE WHEN raw_value IS NULL
       THEN CASE WHEN l_linenumber % 2 = 0 THEN 'ambiguous' ELSE 'not_found' END END
    AS missing_reason,
  CASE WHEN l_suppkey % 23 = 0 THEN 'V-other' ELSE document_version_id END AS evidence_version,
  CASE WHEN l_suppkey % 19 = 0 THEN page_number + 1 ELSE page_number END AS evidence_page,
  CASE WHEN l_suppkey % 11 = 0 THEN 'invented quote' ELSE 'Recorded value: ' || raw_value END
    AS quote,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE length(carbon) + CASE WHEN l_suppkey % 17 = 0
       THEN 1 ELSE 0 END END AS char_start,
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE length(carbon) + 16 + length(raw_value) END
    AS char_end,
  l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate
FROM (
  SELECT *,
    CASE WHEN {_PROJECT} % 3 = 0 THEN 'verra' WHEN {_PROJECT} % 3 = 1 THEN 'acr'
         ELSE 'gold_standard' END AS registry,
    'P' || CAST({_PROJECT} AS STRING) AS project_id,
    'D' || CAST(l_orderkey AS STRING) AS parsed_document_id,
    'V' || CAST(l_orderkey - l_orderkey % 2 AS STRING) AS document_version_id,
    'X' || CAST(l_orderkey AS STRING) AS extraction_run_id,
    'R' || CAST(l_orderkey AS STRING) AS validation_run_id,
    {_PAGE} AS page_number,
    {_PAGE} AS observation_index,
    {CARBON_TEXT} AS carbon,
    {_FIELD} AS field_name, {_RAW} AS raw_value, {_TYPE} AS value_type, {_UNIT} AS unit,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_discount * 10 END AS confidence
  FROM {{lineitem}}
) AS shaped
"""


#: The same in two steps: short columns are formed before lines are dealt, the rest after it. In one step
#: the generated method passes the 8,000 bytes up to which the JVM compiles, and stays interpreted.
_SHORT = f"{_RAW} AS raw_value, {_TYPE} AS value_type, {_UNIT} AS unit"
_PAGE_KEY = (
    "'D' || CAST(l_orderkey AS STRING) AS parsed_document_id",
    f"{_PAGE} AS page_number",
)
_WITH_SHORT = f"SELECT *, {_SHORT} FROM {{lineitem}}"
_WITH_PAGE = f"SELECT *, {_RAW} AS raw_value, {', '.join(_PAGE_KEY)} FROM {{lineitem}}"
_RECORDED_REST = RECORDED.replace(f", {_SHORT}", "")
_PAGES_REST = RECORDED.replace(f", {_RAW} AS raw_value", "")
for _made in _PAGE_KEY:
    _PAGES_REST = _PAGES_REST.replace(f"{_made},", "")
_VERSION = "'V' || CAST(l_orderkey - l_orderkey % 2 AS STRING) AS document_version_id"
_WITH_BLOCK = _WITH_PAGE.replace(" FROM", f", {_VERSION} FROM")
_BLOCKS_REST = _PAGES_REST.replace(f"{_VERSION},", "")

_OBSERVED = ("'X' || CAST(l_orderkey AS STRING) AS extraction_run_id", f"{_PAGE} AS observation_index")
_WITH_OBSERVED = f"SELECT *, {_SHORT}, {', '.join(_OBSERVED)} FROM {{lineitem}}"
_OBSERVED_REST = _RECORDED_REST
for _made in _OBSERVED:
    _OBSERVED_REST = _OBSERVED_REST.replace(f"{_made},", "")


def _dealt(lines: DataFrame, *keys: str) -> DataFrame:
    """Lines in as many tasks as the session's shuffles, however the file was laid out."""
    return lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def recorded(spark: SparkSession, folder: str) -> DataFrame:
    """Pages and observations in one frame; the narrower adapters project from it."""
    # Lines are dealt by order while they are narrow, so every later step has a document's pages
    # together.
    lines = _dealt(view(spark, folder, _WITH_SHORT), "l_orderkey")
    return spark.sql(_RECORDED_REST, lineitem=lines)


def carbon_pages(spark: SparkSession, folder: str) -> DataFrame:
    return recorded(spark, folder).select(
        "parsed_document_id", "document_version_id", "page_number", "text"
    )


def keyed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The same pages, dealt by document and page before their text is formed.

    A join on these two columns finds them in place, so no text is shuffled.
    """
    key = ("parsed_document_id", "page_number")
    lines = _dealt(view(spark, folder, _WITH_PAGE), *key)
    return spark.sql(_PAGES_REST, lineitem=lines).select(*key, "document_version_id", "text")


def block_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The same pages, dealt by document and block of pages before their text is formed, for extraction."""
    key = ("parsed_document_id", "document_version_id", "page_number")
    lines = view(spark, folder, _WITH_BLOCK).withColumn("_block", page_block())
    lines = _dealt(lines, *IDENTITY, "_block").drop("_block")
    return spark.sql(_BLOCKS_REST, lineitem=lines).select(*key, "text")


def observations(spark: SparkSession, folder: str) -> DataFrame:
    return _observed(recorded(spark, folder))


def keyed_observations(spark: SparkSession, folder: str) -> DataFrame:
    """The same observations, dealt by run and index before their values are formed, for validation."""
    lines = _dealt(view(spark, folder, _WITH_OBSERVED), "extraction_run_id", "observation_index")
    return _observed(spark.sql(_OBSERVED_REST, lineitem=lines))


def _observed(rows: DataFrame) -> DataFrame:
    evidence = F.struct(
        F.col("evidence_version").alias("document_version_id"),
        F.col("evidence_page").alias("page_number"),
        "quote",
        "char_start",
        "char_end",
    )
    return rows.select(
        "registry",
        "project_id",
        "document_version_id",
        "parsed_document_id",
        "extraction_run_id",
        "validation_run_id",
        "observation_index",
        "field_name",
        "raw_value",
        "value_type",
        "value_json",
        "unit",
        "confidence",
        "missing_reason",
        F.array().cast("array<string>").alias("issues"),
        F.when(F.col("raw_value").isNull(), F.array()).otherwise(F.array(evidence)).alias(
            "evidence"
        ),
    )


REPORT_VERSIONS = """
SELECT validation_run_id, document_version_id,
  'S' || CAST(l_orderkey - l_orderkey % 4 AS STRING) AS source_document_id
FROM (SELECT DISTINCT 'R' || CAST(l_orderkey AS STRING) AS validation_run_id,
        'V' || CAST(l_orderkey - l_orderkey % 2 AS STRING) AS document_version_id, l_orderkey
      FROM {lineitem}) AS reports
"""


# Documents: one page per document, one page per line, and content versions per source.
def document_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("parsed_document_id"),
        F.col("doc_id").alias("document_version_id"),
        F.lit(1).alias("page_number"),
        "text",
        "lang",
        "source",
    )


def turn_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as documents, their turns as pages."""
    return table(spark, folder, "conversations").select(
        F.col("conv_id").alias("parsed_document_id"),
        F.col("conv_id").alias("document_version_id"),
        F.col("turn").alias("page_number"),
        "text",
    )


def line_pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("parsed_document_id"),
        F.posexplode(F.split("text", "\n")).alias("_at", "text"),
    ).select("parsed_document_id", (F.col("_at") + 1).alias("page_number"), "text")


ARRIVALS = """
SELECT 'verra' AS registry, source AS registry_project_id,
  'https://example.org/' || source AS source_url, 'other' AS document_type,
  CASE WHEN source = 'src3' THEN lang ELSE source END AS title,
  sha256_of(text) AS sha256, 'text/plain' AS content_type,
  CAST(doc_id AS STRING) || '.txt' AS file_name, n_chars AS byte_size,
  CAST(NULL AS STRING) AS declared_version,
  CAST('2024-01-01' AS TIMESTAMP) + CAST(doc_id % 1000 AS INT) * INTERVAL 1 HOUR AS retrieved_at
FROM {documents}
"""


def arrivals(spark: SparkSession, folder: str) -> DataFrame:
    return view(spark, folder, ARRIVALS.replace("sha256_of(text)", "sha2(text, 256)"))


# Events: each is one human decision about one field of one project.
EVENT_FIELDS = (
    "country",
    "project_owner",
    "methodology_name",
    "installed_capacity_mw",
    "crediting_period_start",
    "crediting_period_end",
)
_EVENT_FIELD = (
    "CASE event_id % 6 "
    + " ".join(f"WHEN {n} THEN '{field}'" for n, field in enumerate(EVENT_FIELDS))
    + " END"
)
EVENT_DECISIONS = f"""
SELECT 'E' || CAST(event_id AS STRING) AS decision_id, event_id,
  'C' || CAST(user_id AS STRING) || '-' || CAST(event_id % 6 AS STRING) AS candidate_id,
  'U' || CAST(user_id AS STRING) AS project_id, {_EVENT_FIELD} AS field_name,
  CASE event_type WHEN 'error' THEN 'rejected' WHEN 'signup' THEN 'unresolved'
    ELSE 'approved' END AS status,
  CASE WHEN event_id % 6 = 4 THEN '"' || CAST(2015 + event_id % 7 AS STRING) || '-01-01"'
       WHEN event_id % 6 = 5 THEN '"' || CAST(2020 + event_id % 7 AS STRING) || '-01-01"'
       WHEN event_id % 6 = 2 THEN '"ACM0002"'
       WHEN event_id % 6 = 3 THEN CAST(event_id % 90 + 1 AS STRING) || '.5'
       ELSE '"value ' || CAST(event_id % 100 AS STRING) || '"' END AS value_json,
  CASE WHEN event_id % 29 = 0 THEN 'unit_unverified' END AS blocked_code,
  ts AS created_at
FROM {{events}}
"""

# A decision expects the last decision on its field that could have been approved; every eleventh
# expects nothing and is therefore usually late. LAST_BEFORE is spelled per engine.
EXPECTING = f"""
SELECT *, CASE WHEN event_id % 11 <> 0 THEN LAST_BEFORE END AS prior_decision
FROM (SELECT *, CASE WHEN status = 'approved' AND blocked_code IS NULL AND event_id % 11 <> 0
        THEN decision_id END AS likely_head FROM ({EVENT_DECISIONS}) AS decided) AS marked
"""
WINDOW_BEFORE = """(PARTITION BY project_id, field_name ORDER BY created_at, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def event_decisions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(decisions, candidates, verdicts) for the fold."""
    last = f"last_value(likely_head) IGNORE NULLS OVER {WINDOW_BEFORE}"
    rows = view(spark, folder, EXPECTING.replace("LAST_BEFORE", last))
    approved = F.col("status") == "approved"
    after = F.struct(
        "field_name",
        F.col("value_json").alias("raw_value"),
        F.when(F.col("value_json").startswith('"'), "string").otherwise("double").alias(
            "value_type"
        ),
        "value_json",
        F.lit(None).cast("string").alias("unit"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("string").alias("missing_reason"),
        F.array().cast("array<string>").alias("issues"),
        F.array().cast(f"array<{EVIDENCE}>").alias("evidence"),
    )
    decisions = rows.select(
        "decision_id",
        "candidate_id",
        F.lit("reader").alias("reviewer"),
        F.lit("read the page").alias("reason"),
        "status",
        F.when(F.col("prior_decision").isNotNull(), fact_id("prior_decision")).alias(
            "expected_current_fact_id"
        ),
        approved.alias("authority_confirmed"),
        F.when(approved, after).alias("after"),
        F.col("created_at").cast("timestamp").alias("created_at"),
    )
    candidates = rows.select(
        "candidate_id", F.lit("verra").alias("registry"), "project_id", "field_name"
    ).distinct()
    verdicts = rows.where("status = 'approved'").select(
        "decision_id",
        F.col("created_at").cast("timestamp").alias("created_at"),
        F.array_compact(F.array("blocked_code")).alias("blocked_codes"),
    )
    return decisions, candidates, verdicts


# Review: one candidate per user and field; those no event ever touched are undecided.
REVIEW_CANDIDATES = f"""
SELECT DISTINCT candidate_id, 'R' || CAST(user_id AS STRING) AS validation_run_id,
  CAST(event_id % 6 AS INT) AS observation_index, 'verra' AS registry,
  'U' || CAST(user_id AS STRING) AS project_id, field_name, user_id,
  CASE (user_id + event_id % 6) % 3 WHEN 0 THEN 'rejected' WHEN 1 THEN 'missing'
    ELSE 'needs_review' END AS validation_status,
  CASE (user_id + event_id % 6) % 7 WHEN 0 THEN ''
    WHEN 1 THEN 'unit_unverified,semantic_support_pending' WHEN 2 THEN 'candidate_conflict'
    WHEN 3 THEN 'confidence_unknown' WHEN 4 THEN 'date_format_unresolved,confidence_unknown'
    WHEN 5 THEN 'ambiguous_abstention' ELSE 'evidence_offsets_missing' END AS codes
FROM (SELECT e.*, 'C' || CAST(user_id AS STRING) || '-' || CAST(event_id % 6 AS STRING)
        AS candidate_id, {_EVENT_FIELD} AS field_name
      FROM (SELECT user_id, event_id FROM (SELECT DISTINCT user_id FROM {{events}}) AS users
            CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5)) AS fields(event_id)) AS e) AS named
"""
REVIEW_DECISIONS = f"""
SELECT decision_id, candidate_id, project_id, field_name, status, created_at
FROM ({EVENT_DECISIONS}) AS decided
"""
REVIEW_RUNS = """
SELECT DISTINCT 'R' || CAST(user_id AS STRING) AS pipeline_run_id,
  CAST('2024-01-05' AS TIMESTAMP) + CAST(user_id AS INT) * INTERVAL 1 HOUR AS finished_at
FROM {events}
"""

# Identity tables around the recorded reports, with a few broken ones.
_KEYS = "(SELECT DISTINCT l_orderkey AS k FROM {lineitem}) AS keys"
_KREG = """CASE WHEN (k - k % 8) % 3 = 0 THEN 'verra' WHEN (k - k % 8) % 3 = 1 THEN 'acr'
  ELSE 'gold_standard' END"""
_KP = "'P' || CAST(k - k % 8 AS STRING)"
_KV = "'V' || CAST(k - k % 2 AS STRING)"
_K = "CAST(k AS STRING)"
IDENTITIES = {
    "reports": f"""SELECT 'R' || {_K} AS validation_run_id, 'X' || {_K} AS extraction_run_id,
      'D' || {_K} AS parsed_document_id, {_KV} AS document_version_id, {_KREG} AS registry,
      {_KP} AS project_id FROM {_KEYS}""",
    "extractions": f"""SELECT 'X' || {_K} AS extraction_run_id, 'D' || {_K} AS parsed_document_id,
      {_KV} AS document_version_id, CASE WHEN k % 20 = 9 THEN 'nowhere' ELSE {_KREG} END AS registry,
      {_KP} AS project_id FROM {_KEYS}""",
    "runs": f"""SELECT 'X' || {_K} AS pipeline_run_id, 'baseline_extracted' AS stage,
      CASE WHEN k % 20 = 3 THEN 'failed' ELSE 'succeeded' END AS status, 'h' || {_K} AS input_hash
      FROM {_KEYS} UNION ALL
      SELECT 'R' || {_K}, 'quality_validated', 'succeeded',
      CASE WHEN k % 20 = 5 THEN 'other' ELSE 'h' || {_K} END FROM {_KEYS}""",
    "parsed": f"""SELECT CASE WHEN k % 20 = 11 THEN 'Lost' ELSE 'D' END || {_K} AS parsed_document_id,
      {_KV} AS document_version_id, 'h' || {_K} AS input_hash FROM {_KEYS}""",
    "versions": f"""SELECT DISTINCT {_KV} AS document_version_id,
      'S' || CAST(k - k % 8 AS STRING) AS source_document_id, 'sha' || {_KV} AS sha256
      FROM {_KEYS}""",
    "sources": f"""SELECT DISTINCT 'S' || CAST(k - k % 8 AS STRING) AS source_document_id,
      {_KREG} AS registry, CASE WHEN (k - k % 8) % 160 = 16 THEN 'other' ELSE {_KP} END
      AS registry_project_id, 'https://example.org/' || {_KP} AS source_url FROM {_KEYS}""",
}

# Assessment: every customer is a project with up to nineteen reviewed facts and one document.
FACT_FIELDS = (
    "project_id",
    "project_name",
    "grid_connection_status",
    "project_boundary_text",
    "technology_type",
    "installed_capacity_mw",
    "renewable_resource_type",
    "electricity_generated_mwh",
    "electricity_exported_mwh",
    "pe_applicable_flag",
    "pe_value_tco2e",
    "pe_method_text",
    "le_applicable_flag",
    "le_value_tco2e",
    "le_justification_text",
    "be_value_tco2e",
    "er_reported_tco2e",
    "methodology_name",
    "methodology_version",
)
PROJECT_FACTS = " UNION ALL ".join(
    f"SELECT 'verra' AS registry, 'P' || CAST(c_custkey AS STRING) AS project_id, c_custkey, "
    f"CASE WHEN (c_custkey + {n}) % 23 = 0 THEN 'unlisted_remark' ELSE '{field}' END "
    f"AS field_name, 'F' || CAST(c_custkey AS STRING) || '-{n}' AS fact_id, "
    + {
        "methodology_name": "CASE WHEN c_custkey % 9 = 0 THEN '\"AMS-I.D\"' ELSE '\"ACM0002\"' END",
        "methodology_version": "CASE WHEN c_custkey % 13 = 0 THEN '\"  \"' ELSE '\"v1\"' END",
        "be_value_tco2e": "CAST(1000 + c_custkey % 50 AS STRING) || '.0'",
        "pe_value_tco2e": "CAST(c_custkey % 10 AS STRING) || '.5'",
        "le_value_tco2e": "'5'",
        "er_reported_tco2e": "CASE WHEN c_custkey % 31 = 0 THEN '0' "
                             "ELSE CAST(990 + c_custkey % 37 AS STRING) END",
    }.get(field, "'\"given\"'")
    + " AS value_json, "
    + (
        "CASE WHEN c_custkey % 17 = 0 THEN 'kgCO2e' ELSE 'tCO2e' END"
        if field == "pe_value_tco2e"
        else "'tCO2e'"
        if field.endswith("_tco2e")
        else "CAST(NULL AS STRING)"
    )
    + " AS unit, 'D' || CAST(c_custkey AS STRING) AS parsed_document_id, "
    "'V' || CAST(c_custkey AS STRING) AS document_version_id "
    "FROM {customer}"
    for n, field in enumerate(FACT_FIELDS)
)
PROJECT_PAGES = """
SELECT 'D' || CAST(c_custkey AS STRING) AS parsed_document_id, 1 AS page_number,
  'Statement about ' || c_name || ' and its period.' AS text FROM {customer}
"""
BOUND = {
    "electricity_generated_mwh": 7,
    "electricity_exported_mwh": 8,
    "be_value_tco2e": 15,
    "pe_value_tco2e": 10,
    "le_value_tco2e": 13,
    "er_reported_tco2e": 16,
}


def project_contexts(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")

    def fact(n: int):
        return F.concat(F.lit("F"), key.cast("string"), F.lit(f"-{n}"))

    entries = F.array_compact(
        F.array(
            *[
                F.when(
                    (key % 14 != 0) if field == "le_value_tco2e" else F.lit(True),
                    F.struct(
                        F.lit(field),
                        F.when(key % 15 == 0, "wrong").otherwise(fact(n))
                        if field == "pe_value_tco2e"
                        else fact(n),
                    ),
                )
                for field, n in BOUND.items()
            ]
        )
    )
    quote = F.when(key % 21 == 0, "invented").otherwise(F.col("c_name"))
    evidence = F.struct(
        F.concat(F.lit("V"), key.cast("string")).alias("document_version_id"),
        F.lit(1).alias("page_number"),
        quote.alias("quote"),
        F.lit(16).alias("char_start"),
        (F.lit(16) + F.length(quote)).alias("char_end"),
    )
    # Every fourth context is about a project that has no facts, and theirs have no context.
    return table(spark, folder, "customer").select(
        F.lit("verra").alias("registry"),
        F.concat(F.when(key % 4 == 0, "Q").otherwise("P"), key.cast("string")).alias("project_id"),
        (key % 6 != 0).alias("authority_confirmed"),
        F.when(key % 10 == 0, "wrong").otherwise(fact(17)).alias("methodology_fact_id"),
        fact(18).alias("methodology_version_fact_id"),
        F.map_from_entries(entries).alias("period_fact_ids"),
        F.array(evidence).alias("evidence"),
        F.lit("reader").alias("reviewer"),
        F.when(key % 40 == 1, " ").otherwise("checked").alias("reason"),
        F.when(key % 16 == 1, "2020").otherwise("2020-01-01").alias("period_start"),
        F.when(key % 18 == 1, "2019-12-31").otherwise("2020-12-31").alias("period_end"),
    )


JUDGED = """
SELECT l_orderkey AS request_id,
  CASE WHEN l_partkey % 97 = 0 THEN 'D13.C1' ELSE 'D' || CASE WHEN l_partkey % 12 < 9 THEN '0'
    ELSE '' END || CAST(l_partkey % 12 + 1 AS STRING) || '.C' || CAST(l_suppkey % 3 + 1 AS STRING)
    END AS criterion_id, min(l_linenumber) AS line
FROM {lineitem} GROUP BY 1, 2
"""
_OUTCOMES = ("supported", "not_supported", "insufficient", "conflicting", "not_applicable")
JUDGMENT_OUTCOME = (
    "CASE line % 5 " + " ".join(f"WHEN {n} THEN '{o}'" for n, o in enumerate(_OUTCOMES)) + " END"
)


def judged(spark: SparkSession, folder: str) -> DataFrame:
    """One row per judged criterion; a request's lines are dealt first and stay together.

    Every later group has the request in its key, so none needs another shuffle, and no task gets
    more than its share: small rows shuffled later would be put together until they fill its memory.
    """
    lines = _dealt(table(spark, folder, "lineitem"), "l_orderkey")
    return spark.sql(JUDGED, lineitem=lines)


# Comparison and gold labels over the recorded candidates.
GOLD_LABELS = f"""
SELECT registry AS dataset_version, extraction_run_id AS sample_id, registry, project_id,
  document_version_id, extraction_run_id, field_name,
  CASE WHEN l_orderkey % 24 >= 16 THEN 'test' WHEN l_orderkey % 24 >= 8 THEN 'validation'
    ELSE 'development' END AS split,
  CASE WHEN count(raw_value) % 3 = 2 THEN 'unknown' ELSE 'confirmed' END AS label_status,
  CASE WHEN count(raw_value) % 3 <> 2 THEN min(value_json) END AS value_json,
  CASE WHEN count(raw_value) % 3 <> 2 THEN min(unit) END AS unit,
  CASE WHEN l_orderkey % 30 = 0 THEN 'draft' ELSE 'frozen' END AS sample_status
FROM ({RECORDED}) AS recorded
GROUP BY registry, extraction_run_id, project_id, document_version_id, field_name, l_orderkey
"""

# Registry payloads wrapped around the documents.
GROUP_PAYLOADS = """
SELECT 'verra' AS registry, source AS project_id, CAST('2024-01-01' AS TIMESTAMP) AS discovered_at,
  '{{"documentGroups":[{{"documents":[{{"id":' || CAST(doc_id AS STRING) ||
  ',"uri":"files/' || CAST(doc_id AS STRING) || '.pdf","documentName":"Report ' || lang ||
  '","version":"' || CAST(doc_id % 3 AS STRING) || '"}},{{"id":null,"uri":"/abs/' || lang ||
  '","documentName":""}},{{"id":7,"uri":null}}]}},{{"documents":[]}}]}}' AS body
FROM {documents}
"""
REQUEST_PAYLOADS = """
SELECT 'gold_standard' AS registry, source AS project_id,
  CAST('2024-01-01' AS TIMESTAMP) AS discovered_at,
  '{{"requests":[{{"documents":[{{"id":' || CAST(doc_id AS STRING) || ',"name":"Doc ' || lang ||
  '"}},{{"name":"no id"}},{{"id":"x' || CAST(doc_id AS STRING) || '","name":""}}]}}]}}' AS body
FROM {documents}
"""
RESPONSES = """
SELECT page_id, 'acr' AS registry, url,
  CASE page_id % 9 WHEN 0 THEN 403 WHEN 1 THEN 404 WHEN 2 THEN 429 WHEN 3 THEN 503 WHEN 4 THEN 302
    WHEN 5 THEN NULL ELSE 200 END AS http_status,
  CASE page_id % 5 WHEN 0 THEN 'Application/JSON; charset=utf-8' WHEN 1 THEN 'text/html'
    WHEN 2 THEN 'application/xhtml+xml' WHEN 3 THEN 'application/json' ELSE 'text/plain' END
    AS content_type,
  CASE WHEN page_id % 5 = 0 THEN '[' || CAST(page_id AS STRING) || ']'
    WHEN page_id % 7 = 0 THEN html || '404 Not Found' ELSE html END AS body
FROM {pages}
"""
SYNC_RUNS = """
SELECT event_id AS sync_run_id,
  CASE user_id % 3 WHEN 0 THEN 'verra' WHEN 1 THEN 'acr' ELSE 'gold_standard' END AS registry,
  'c' || CAST(event_id - 1 AS STRING) AS cursor_before, 'c' || CAST(event_id AS STRING)
    AS next_cursor, event_id % 4 AS discovered_projects, ts AS finished_at
FROM {events}
"""
SYNC_FAILURES = """
SELECT event_id AS sync_run_id, CASE WHEN user_id % 4 = 0 THEN 'registry' ELSE 'project' END AS scope
FROM {events} WHERE event_type = 'error'
UNION ALL SELECT event_id, 'other' FROM {events} WHERE event_type = 'error' AND user_id % 2 = 0
"""

# Projects that sources name and no fact is about.
SOURCE_PROJECTS = """
SELECT 'verra' AS registry, 'S' || CAST(s_suppkey AS STRING) AS project_id FROM {supplier}
"""

# A manifest's lines: a header, and per document a row, some of them broken in one of several ways.
MANIFEST_LINES = """
SELECT CASE WHEN doc_id % 50 = 7 THEN '{{"relative_path":"' || source || '/'
  WHEN doc_id % 50 = 8 THEN '["' || source || '"]'
  ELSE '{{"relative_path":"' || CASE doc_id % 50 WHEN 9 THEN '' WHEN 10 THEN source || '/same.txt'
      ELSE source || '/' || CAST(doc_id AS STRING) || '.txt' END
    || '","size_bytes":' || CASE doc_id % 50 WHEN 11 THEN '0' WHEN 12 THEN '"many"'
      ELSE CAST(n_chars AS STRING) END
    || ',"sha256":"' || CASE doc_id % 50 WHEN 13 THEN 'xyz' ELSE sha256_of(text) END
    || '","content_type":"' || CASE doc_id % 50 WHEN 14 THEN '' ELSE 'text/plain' END
    || '","registry":' || CASE doc_id % 50 WHEN 15 THEN '"nowhere"' WHEN 16 THEN 'null' ELSE '"verra"' END
    || ',"source_url":"' || CASE doc_id % 50 WHEN 17 THEN 'files' ELSE 'https://example.org' END || '/x"}}'
  END AS value
FROM {documents}
UNION ALL SELECT '{{"root_label":"documents","row_count":' || CAST(count(*) AS STRING) || ',"total_bytes":1}}'
FROM {documents}
UNION ALL SELECT '  '
"""

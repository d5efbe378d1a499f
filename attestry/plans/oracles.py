"""The same results as plain SQL for an independent engine, one text per query."""

from __future__ import annotations

import re

from attestry.catalog import (
    APPLICABILITY_PAIRS,
    BOOLEAN_FIELDS,
    DATE_FIELDS,
    DATE_PAIRS,
    ENERGY_PAIR,
    EXPECTED_UNITS,
    EXTRACTION_RULES,
    FIELDS,
    INTEGER_FIELDS,
    KEYWORDS,
    NUMBER_FIELDS,
    PROJECT_FIELDS,
    TEXT_FIELDS,
)
from attestry.sources import adapters
from attestry.sources.adapters import TABLES

ORACLES: dict[str, str] = {}


def local(sql: str) -> str:
    """Adapter SQL with table marks replaced by plain names."""
    for name in TABLES:
        sql = sql.replace("{" + name + "}", name)
    return sql.replace("sha256_of(", "sha256(").replace("{{", "{").replace("}}", "}")


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


WORD = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_]"


def re2(pattern: str) -> str:
    """Whole words spelled without look-around."""
    word = re.fullmatch(r"\\b(.+)\\b", pattern)
    return rf"(?:^|{NON_WORD}){word.group(1)}(?:$|{NON_WORD})" if word else pattern


def uuid5_sql(name: str) -> str:
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"
    return (
        f"(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || "
        f"substr('89ab89ab89ab89ab', strpos('0123456789abcdef', substr(h, 17, 1)), 1) || "
        f"substr(h, 18, 3) || '-' || substr(h, 21, 12) FROM (SELECT {digest} AS h))"
    )


# ------------------------------------------------------------------------------- keywords
def _hits(scope: str) -> str:
    columns = []
    for dimension, (_, strong, weak) in KEYWORDS.items():
        for level, patterns in (("high", strong), ("mid", weak)):
            for at, pattern in enumerate(patterns):
                columns.append(
                    f"max(CAST(regexp_matches(text, {text_literal('(?i)' + re2(pattern))}) AS INT)) "
                    f"AS {dimension}_{level}_{at}"
                )
    return f"SELECT {scope}, {', '.join(columns)} FROM documents GROUP BY ALL"


def _counts(dimension: str) -> tuple[str, str]:
    _, strong, weak = KEYWORDS[dimension]
    high = " + ".join(f"{dimension}_high_{at}" for at in range(len(strong)))
    mid = " + ".join(f"{dimension}_mid_{at}" for at in range(len(weak)))
    return f"({high})", f"({mid})"


def _score(dimension: str) -> str:
    high, mid = _counts(dimension)
    return (
        f"CASE WHEN {high} >= 3 THEN 3 WHEN {high} >= 1 OR {mid} >= 2 THEN 2 "
        f"WHEN {mid} >= 1 THEN 1 ELSE 0 END"
    )


_SCORES = ", ".join(f"{_score(d)} AS {d}" for d in KEYWORDS)
_TOTAL = " + ".join(KEYWORDS)
ORACLES["keyword_totals"] = f"""
WITH hits AS ({_hits("doc_id AS parsed_document_id")}),
scores AS (SELECT parsed_document_id, {_SCORES} FROM hits)
SELECT *, {_TOTAL} AS total_score, ({_TOTAL}) / 36.0::DOUBLE AS keyword_score_ratio FROM scores
"""


def _scores_sql(column: str, alias: str) -> str:
    parts = []
    for dimension, (name, _, _) in KEYWORDS.items():
        high, mid = _counts(dimension)
        parts.append(
            f"SELECT {alias}, '{dimension}' AS dimension_id, {text_literal(name)} AS "
            f"dimension_name, {high} AS hit_count_high, {mid} AS hit_count_mid, "
            f"{_score(dimension)} AS score FROM hits"
        )
    return f"WITH hits AS ({_hits(column)}) " + " UNION ALL ".join(parts)


ORACLES["keyword_scores"] = _scores_sql("doc_id AS parsed_document_id", "parsed_document_id")
ORACLES["keyword_scores_by_source"] = _scores_sql("source", "source")

_EVIDENCE = []
for _dimension, (_, _strong, _weak) in KEYWORDS.items():
    _leveled = [("high", p) for p in _strong] + [("mid", p) for p in _weak]
    for _at, (_level, _pattern) in enumerate(_leveled):
        _word = re.fullmatch(r"\\b(.+)\\b", _pattern)
        _core = _word.group(1) if _word else _pattern
        _before = rf"(?:^|{NON_WORD})" if _word else ""
        _after = rf"(?:$|{NON_WORD})" if _word else ""
        _whole = text_literal(f"(?is)^(.*?{_before})({_core}){_after}")
        _test = text_literal(f"(?i){_before}{_core}{_after}")
        _EVIDENCE.append(
            f"SELECT doc_id, text, '{_dimension}' AS dimension_id, '{_level}' AS level, "
            f"{_at} AS position, {text_literal(_pattern)} AS pattern, "
            f"length(regexp_extract(text, {_whole}, 1)) AS s, "
            f"length(regexp_extract(text, {_whole}, 2)) AS n "
            f"FROM documents WHERE regexp_matches(text, {_test})"
        )
ORACLES["keyword_evidence"] = f"""
WITH found AS ({" UNION ALL ".join(_EVIDENCE)}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, dimension_id ORDER BY position) AS rn
           FROM found),
placed AS (SELECT *, greatest(0, s - 120) AS char_start, least(length(text), s + n + 120) AS char_end
           FROM ranked WHERE rn <= 3)
SELECT doc_id AS parsed_document_id, dimension_id, level, pattern, char_start, char_end,
  substr(text, char_start + 1, char_end - char_start) AS quote FROM placed
"""

# Conversations are documents of many pages: a pattern counts once, at its first turn.
_TURNS = (("doc_id AS parsed_document_id", "conv_id AS parsed_document_id"), ("FROM documents", "FROM conversations"))
_EVIDENCE_OF_TURNS = [
    part.replace("SELECT doc_id, text,", "SELECT conv_id AS doc_id, turn, text,").replace(*_TURNS[1])
    for part in _EVIDENCE
]
ORACLES["turn_keyword_totals"] = ORACLES["keyword_totals"].replace(*_TURNS[0]).replace(*_TURNS[1])
ORACLES["turn_keyword_evidence"] = f"""
WITH found AS ({" UNION ALL ".join(_EVIDENCE_OF_TURNS)}),
firsts AS (SELECT * FROM found QUALIFY
  row_number() OVER (PARTITION BY doc_id, dimension_id, position ORDER BY turn) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, dimension_id ORDER BY position) AS rn
           FROM firsts),
placed AS (SELECT *, greatest(0, s - 120) AS char_start, least(length(text), s + n + 120) AS char_end
           FROM ranked)
SELECT doc_id AS parsed_document_id, turn AS page_number, dimension_id, level, pattern,
  CAST(rn AS INT) AS evidence_rank, char_start, char_end,
  substr(text, char_start + 1, char_end - char_start) AS quote FROM placed
"""

# ---------------------------------------------------------------------------------- pages
_NON_SPACE = r"length(regexp_replace({0}, '[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]', '', 'g'))"
_ALNUM = r"length(regexp_replace({0}, '[^\p{{L}}\p{{N}}]', '', 'g'))"


def _quality(text: str) -> str:
    solid, alnum = _NON_SPACE.format(text), _ALNUM.format(text)
    odd = f"(length({text}) - length(replace({text}, chr(65533), '')))"
    return f"""length({text}) AS character_count, {solid} AS non_whitespace_count,
    CASE WHEN {solid} = 0 THEN 0.0 ELSE {alnum} / {solid} END AS alphanumeric_ratio,
    CASE WHEN length({text}) = 0 THEN 0.0 ELSE {odd} / length({text}) END
      AS replacement_character_ratio"""


ORACLES["text_quality"] = f"""
SELECT doc_id AS parsed_document_id, 1 AS page_number, {_quality("text")} FROM documents
"""
LINES = """SELECT doc_id AS parsed_document_id, n AS page_number, parts[n] AS text
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts,
        unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n FROM documents)"""
ROUTED = f"""SELECT *, CASE
    WHEN non_whitespace_count >= 80 AND replacement_character_ratio <= 0.02 THEN 'native'
    WHEN ink_ratio < 0.001 THEN 'blank' ELSE 'ocr_required' END AS route
  FROM (SELECT parsed_document_id, page_number, text, {_quality("text")},
          CASE WHEN page_number % 5 <> 0 THEN (page_number % 4) / 2000.0 END AS ink_ratio
        FROM ({LINES}))"""
ORACLES["ocr_routing"] = f"""
SELECT parsed_document_id, page_number, route, non_whitespace_count,
  CASE WHEN route = 'blank' THEN 'page ' || page_number || ': blank page skipped OCR' END AS warning
FROM ({ROUTED})
"""
MERGED = f"""SELECT parsed_document_id, page_number, route,
    route = 'ocr_required' AND page_number % 3 = 0 AS used_ocr,
    CASE WHEN route = 'ocr_required' AND page_number % 3 = 0 THEN 'scan: ' || text ELSE text END AS text
  FROM ({ROUTED})"""
ORACLES["ocr_merge"] = f"""
SELECT parsed_document_id, page_number, used_ocr, length(text) AS character_count,
  sha256(text) AS text_hash FROM ({MERGED})
"""
ORACLES["parse_summary"] = f"""
SELECT parsed_document_id, count(*) AS page_count, count(*) FILTER (used_ocr) AS ocr_page_count,
  count(*) FILTER (route = 'blank') AS warning_count
FROM ({MERGED}) GROUP BY 1
"""
ORACLES["page_sequence"] = """
SELECT conv_id AS parsed_document_id, count(*) AS page_count,
  count(DISTINCT turn) AS distinct_pages, min(turn + 1) AS first_page, max(turn + 1) AS last_page,
  min(turn) = 0 AND max(turn) + 1 = count(*) AND count(DISTINCT turn) = count(*) AS sequential
FROM conversations GROUP BY 1
"""
_CONFIG = """sha256('{"inspection_dpi":36,"inspection_min_ink_ratio":"0.001",'
  || '"inspection_white_threshold":245,"max_replacement_character_ratio":"0.02",'
  || '"min_non_whitespace_count":80,"ocr_dpi":300,'
  || CASE WHEN doc_id % 2 = 0 THEN '"ocr_engine_name":"engine","ocr_engine_version":"5.3",'
     ELSE '"ocr_engine_name":null,"ocr_engine_version":null,' END
  || '"ocr_language":"' || lang || '","parser_name":"' || source || '","parser_version":"1.0"}')"""
ORACLES["configuration_hash"] = f"""
SELECT 'V' || doc_id AS document_version_id, {_CONFIG} AS configuration_hash FROM documents
"""
ORACLES["unparsed_versions"] = """
SELECT 'V' || doc_id AS document_version_id, 'P' || doc_id AS parsed_document_id
FROM documents WHERE doc_id % 4 <> 1
"""
ORACLES["read_parsed_pages"] = f"""
SELECT 'P' || parsed_document_id AS parsed_document_id, d.lang AS ocr_language, page_number,
  length(l.text) AS characters
FROM ({LINES}) l JOIN documents d ON d.doc_id = l.parsed_document_id
"""

# ------------------------------------------------------------------- manifest and versions
MANIFEST = """SELECT relative_path, size_bytes, sha256, CASE WHEN relative_path LIKE '%.PDF'
    THEN 'application/pdf' WHEN relative_path LIKE '%.txt' THEN 'text/plain'
    ELSE 'application/octet-stream' END AS content_type,
  CASE WHEN contains(relative_path, '/') THEN source END AS project_id
FROM (SELECT source, CASE WHEN doc_id % 13 = 0 THEN '' ELSE source || '/' END
    || CASE WHEN doc_id % 17 = 0 THEN '.' WHEN doc_id % 11 = 0 THEN '_' ELSE '' END || doc_id
    || CASE WHEN doc_id % 5 = 0 THEN '.PDF' WHEN doc_id % 7 = 0 THEN '' ELSE '.txt' END AS relative_path,
  octet_length(encode(text)) AS size_bytes, sha256(text) AS sha256, doc_id FROM documents)
WHERE doc_id % 17 <> 0"""
ORACLES["file_manifest"] = MANIFEST
ORACLES["manifest_header"] = f"""
SELECT count(*) AS row_count, sum(size_bytes) AS total_bytes FROM ({MANIFEST})
"""
ORACLES["manifest_sample"] = f"""
WITH ranked AS (SELECT *, row_number() OVER (
    ORDER BY substr(sha256('7:' || relative_path), 1, 16), relative_path) AS rn FROM ({MANIFEST}))
SELECT relative_path, size_bytes, sha256, content_type,
  CASE WHEN rn <= 60 THEN 'development' WHEN rn <= 80 THEN 'validation' ELSE 'test' END
    AS sample_split
FROM ranked WHERE rn <= 100
"""
_SOURCE_ID = uuid5_sql(
    "'source:' || registry || '|' || registry_project_id || '|' || source_url || '|' || document_type"
)
ARRIVED = f"""
arrived AS (SELECT a.*, {_SOURCE_ID} AS source_document_id FROM ({local(adapters.ARRIVALS)}) a),
stored_sources AS (
  SELECT source_document_id, arg_min(title, (retrieved_at, file_name)) AS title FROM arrived
  WHERE file_name LIKE '%7.txt' GROUP BY 1),
stored AS (
  SELECT DISTINCT a.source_document_id, sha256 FROM arrived a
  JOIN stored_sources s ON s.source_document_id = a.source_document_id AND s.title = a.title
  WHERE file_name LIKE '%7.txt'),
titles AS (
  SELECT source_document_id, any_value(registry_project_id) AS registry_project_id,
    coalesce(any_value(s.title), arg_min(a.title, (retrieved_at, file_name))) AS title
  FROM arrived a LEFT JOIN stored_sources s USING (source_document_id) GROUP BY 1),
conflicts AS (
  SELECT source_document_id, file_name FROM arrived a JOIN titles t USING (source_document_id)
  WHERE a.title IS DISTINCT FROM t.title),
taken AS (
  SELECT a.*, {uuid5_sql("'version:' || a.source_document_id || ':' || a.sha256")}
      AS document_version_id,
    row_number() OVER (PARTITION BY source_document_id, sha256
      ORDER BY retrieved_at, file_name) AS rn
  FROM arrived a WHERE (source_document_id, file_name) NOT IN (SELECT (source_document_id, file_name) FROM conflicts))
"""
ORACLES["ingest_new_versions"] = f"""
WITH {ARRIVED} SELECT source_document_id, document_version_id, sha256, file_name, byte_size
FROM taken WHERE rn = 1 AND (source_document_id, sha256) NOT IN (SELECT (source_document_id, sha256)
  FROM stored)
"""
ORACLES["ingest_new_sources"] = f"""
WITH {ARRIVED} SELECT source_document_id, registry_project_id, title FROM titles
WHERE source_document_id NOT IN (SELECT source_document_id FROM stored_sources)
"""
ORACLES["ingest_duplicates"] = f"""
WITH {ARRIVED}, grouped AS (
  SELECT t.source_document_id, t.sha256, t.document_version_id, count(*) -
    CASE WHEN bool_or(s.sha256 IS NOT NULL) THEN 0 ELSE 1 END AS duplicates
  FROM taken t LEFT JOIN stored s USING (source_document_id, sha256) GROUP BY 1, 2, 3)
SELECT sha256, document_version_id, duplicates FROM grouped WHERE duplicates > 0
"""
ORACLES["ingest_conflicts"] = f"""
WITH {ARRIVED} SELECT source_document_id, file_name, 'source_metadata_conflict' AS rule FROM conflicts
"""
ORACLES["version_history"] = f"""
SELECT registry_project_id AS source_document_id, file_name AS document_version_id, sha256,
  row_number() OVER w AS version_number, lag(sha256) OVER w AS previous_sha256
FROM ({local(adapters.ARRIVALS)})
WINDOW w AS (PARTITION BY registry_project_id ORDER BY retrieved_at, file_name)
"""
ORACLES["object_keys"] = f"""
SELECT file_name AS document_version,
  CASE WHEN file_name NOT LIKE '%9.txt' THEN registry || '/' || registry_project_id || '/' ||
    document_type || '/' || file_name || '/' || sha256 END AS object_key,
  CASE WHEN file_name LIKE '%9.txt' THEN 'unsafe_component' END AS rule
FROM ({local(adapters.ARRIVALS)})
"""
_STAGES = ("parsed", "extracted", "validated", "reviewed")
_DONE = " || ".join(
    f"CASE WHEN bool_or(stage = '{s}') THEN ',{s}' ELSE '' END" for s in _STAGES
)
_OPEN = " || ".join(
    f"CASE WHEN coalesce(bool_or(stage = '{s}'), false) THEN '' ELSE ',{s}' END" for s in _STAGES
)
ORACLES["reprocess_gate"] = f"""
WITH stages AS (SELECT l_orderkey AS v, CASE WHEN l_partkey % 97 = 0 THEN 'guessed' ELSE
    (ARRAY[{quoted(_STAGES)}])[l_linenumber % 4 + 1] END AS stage FROM lineitem),
gates AS (SELECT o_orderkey AS document_version_id,
    substr(coalesce({_DONE}, ''), 2) AS completed_stages, substr({_OPEN}, 2) AS missing_stages,
    CASE WHEN bool_or(stage = 'guessed') THEN 'unknown_stage'
         WHEN o_orderkey % 50 = 0 THEN 'version_equals_predecessor' END AS rule
  FROM orders LEFT JOIN stages ON v = o_orderkey GROUP BY o_orderkey)
SELECT *, missing_stages = '' AND rule IS NULL AS promotable FROM gates
"""
ORACLES["name_based_ids"] = f"""
SELECT c_custkey, {uuid5_sql("c_name")} AS customer_uuid FROM customer
"""

# ----------------------------------------------------------------------------- extraction
RECORDED = local(adapters.RECORDED)


def _rule_sql(position: int, rule, pattern_position: int, pages: str) -> str:
    suffix = rule.suffix.replace(r"(?![\d/-])", r"(?:[^\d/-]|$)")
    flags = "(?im)" if rule.multiline else "(?i)"
    whole = text_literal(f"{flags}((?s:.*?))({rule.prefix})({rule.value})({suffix})")
    look = "0" if "(?!" in rule.suffix else "length(p[4])"
    parts = ", ".join(f"regexp_extract_all(text, {whole}, {g}) AS g{g}" for g in (1, 2, 3, 4))
    return f"""
    SELECT parsed_document_id, page_number, text, {position} AS field_position,
      {pattern_position} AS pattern_position, '{rule.field}' AS field_name,
      '{rule.kind}' AS kind, {text_literal(rule.unit) if rule.unit else "CAST(NULL AS VARCHAR)"}
        AS unit, p[3] AS raw_value,
      skipped + length(p[1]) AS match_start,
      skipped + length(p[1]) + length(p[2]) + length(p[3]) + {look} AS match_end
    FROM (SELECT *, coalesce(sum(length(p[1]) + length(p[2]) + length(p[3]) + length(p[4])) OVER (
            PARTITION BY parsed_document_id, page_number ORDER BY n
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS skipped
      FROM (SELECT parsed_document_id, page_number, text, n, [g1[n], g2[n], g3[n], g4[n]] AS p
        FROM (SELECT *, unnest(range(1, len(g1) + 1)) AS n
          FROM (SELECT parsed_document_id, page_number, text, {parts} FROM ({pages})))))"""


def extraction_sql(pages: str, rule_list=EXTRACTION_RULES, field_list=FIELDS) -> str:
    """CTEs that end in ``extracted``: candidates and abstentions with their index."""
    seen: dict[str, int] = {}
    rules = []
    for rule in rule_list:
        at = seen.get(rule.field, 0)
        seen[rule.field] = at + 1
        rules.append(_rule_sql(list(field_list).index(rule.field), rule, at, pages))
    stop = r"(?i)\b(?:considered|analysis|common practice|shall|therefore|because)\b"
    fields = ", ".join(f"({n}, '{f}')" for n, f in enumerate(field_list))
    return f"""
raw_matches AS ({" UNION ALL ".join(rules)}),
cleaned AS (SELECT *, trim(regexp_replace(raw_value, '\\s+', ' ', 'g')) AS t,
    try_cast(replace(raw_value, ',', '') AS DOUBLE) AS amount FROM raw_matches),
kept AS (SELECT *, greatest(0, match_start - 120) AS char_start,
    least(length(text), match_end + 120) AS char_end
  FROM cleaned WHERE CASE kind
    WHEN 'text' THEN NOT contains(t, 'http://') AND NOT contains(t, 'https://')
      AND NOT contains(lower(t), 'risk?') AND len(regexp_extract_all(t, '[A-Za-z]')) >= 3
    WHEN 'title' THEN length(t) BETWEEN 2 AND 240 AND len(string_split(t, ' ')) <= 12
      AND NOT regexp_matches(t, {text_literal(stop)})
    WHEN 'company' THEN length(t) BETWEEN 2 AND 180
    WHEN 'number' THEN amount IS NOT NULL ELSE true END),
candidates AS (SELECT parsed_document_id, field_position, pattern_position, field_name, raw_value,
    CASE kind WHEN 'number' THEN CAST(amount AS VARCHAR) WHEN 'integer' THEN raw_value
      WHEN 'keyword' THEN '"grid-connected"' WHEN 'text' THEN '"' || t || '"'
      ELSE '"' || t || '"' END AS value_json, unit, CAST(NULL AS VARCHAR) AS missing_reason,
    CASE kind WHEN 'number' THEN 'broad_numeric_rule' ||
        CASE WHEN unit IS NULL THEN ',unit_not_verified' ELSE '' END
      WHEN 'keyword' THEN 'keyword_presence_not_business_status'
      WHEN 'date' THEN 'date_not_validated' ||
        CASE WHEN regexp_full_match(t, '\\d{{4}}') THEN ',year_only_date'
          WHEN regexp_full_match(t, '\\d{{1,2}}[/-]\\d{{1,2}}[/-]\\d{{2,4}}')
          THEN ',ambiguous_numeric_date' ELSE '' END
      WHEN 'company' THEN 'company_entity_not_resolved' ELSE '' END AS issues,
    page_number, match_start, char_start, char_end,
    substr(text, char_start + 1, char_end - char_start) AS quote FROM kept),
fields(field_position, field_name) AS (VALUES {fields}),
abstentions AS (SELECT d.parsed_document_id, f.field_position, 0, f.field_name, NULL, NULL, NULL,
    CASE WHEN f.field_name IN ({quoted(seen)}) THEN 'not_found' ELSE 'unsupported_by_baseline' END,
    '', NULL, NULL, NULL, NULL, NULL
  FROM (SELECT DISTINCT parsed_document_id FROM ({pages})) d CROSS JOIN fields f
  WHERE NOT EXISTS (SELECT 1 FROM candidates c WHERE c.parsed_document_id = d.parsed_document_id
    AND c.field_position = f.field_position)),
extracted AS (SELECT *, row_number() OVER (PARTITION BY parsed_document_id
    ORDER BY field_position, pattern_position, page_number, match_start) - 1 AS observation_index
  FROM (SELECT * FROM candidates UNION ALL SELECT * FROM abstentions))"""


CARBON = f"SELECT parsed_document_id, page_number, text FROM ({RECORDED})"
ORACLES["regex_extraction"] = f"""
WITH {extraction_sql(CARBON)}
SELECT parsed_document_id, observation_index, field_name, raw_value, value_json, unit,
  missing_reason, issues, page_number, char_start, char_end, quote FROM extracted
"""
ORACLES["regex_extraction_page_subset"] = f"""
WITH {extraction_sql(CARBON + " WHERE page_number % 2 = 0")}
SELECT parsed_document_id, field_name, raw_value, page_number, char_start FROM candidates
"""
ORACLES["extraction_summary"] = f"""
WITH {extraction_sql(CARBON)}, per_field AS (
  SELECT parsed_document_id, field_name, bool_or(missing_reason IS NULL) AS matched,
    count(DISTINCT value_json) AS n FROM extracted GROUP BY 1, 2)
SELECT parsed_document_id, count(*) FILTER (matched) AS matched_fields,
  count(*) FILTER (NOT matched) AS missing_fields,
  count(*) FILTER (n > 1) AS candidate_conflict_fields,
  count(*) FILTER (matched) / count(*) AS matched_field_coverage
FROM per_field GROUP BY 1
"""
ORACLES["extracted_quotes_grounded"] = f"""
WITH {extraction_sql(CARBON)}
SELECT field_name, 'grounded' AS outcome, count(*) AS quotes FROM candidates GROUP BY 1
"""

# ------------------------------------------------------------------ grounding and validation
GROUNDED = f"""
recorded AS ({RECORDED}),
outcomes AS (SELECT r.*, p.text AS page_text, CASE WHEN p.text IS NULL THEN 'page_missing'
    WHEN trim(r.quote) = '' OR NOT contains(p.text, r.quote) THEN 'quote_missing'
    WHEN r.char_start IS NULL THEN 'offsets_missing'
    WHEN r.char_end > length(p.text)
      OR substr(p.text, r.char_start + 1, r.char_end - r.char_start) <> r.quote
      THEN 'offsets_mismatch' ELSE 'grounded' END AS outcome
  FROM recorded r LEFT JOIN recorded p ON p.parsed_document_id = r.parsed_document_id
    AND p.page_number = r.evidence_page WHERE r.raw_value IS NOT NULL)"""
ORACLES["evidence_grounding"] = f"""
WITH {GROUNDED} SELECT parsed_document_id, observation_index, outcome FROM outcomes
"""
ORACLES["grounding_report"] = f"""
WITH {GROUNDED} SELECT parsed_document_id, count(*) AS checked_evidence,
  count(*) FILTER (outcome = 'page_missing') AS missing_page,
  count(*) FILTER (outcome = 'offsets_missing') AS missing_offsets,
  count(*) FILTER (outcome IN ('quote_missing', 'offsets_mismatch')) AS quote_mismatch,
  bool_and(outcome = 'grounded') AS valid
FROM outcomes GROUP BY 1
"""
ORACLES["quote_location"] = """
WITH quotes AS (SELECT doc_id, text, substr(text, 40, 3 + doc_id % 20) AS quote FROM documents),
placed AS (SELECT *, instr(text, quote) AS first_at FROM quotes WHERE quote <> ''),
marked AS (SELECT *, CASE WHEN instr(substr(text, first_at + 1), quote) > 0 THEN 'ambiguous'
    ELSE 'unique' END AS occurrence FROM placed)
SELECT doc_id AS parsed_document_id, occurrence,
  CASE WHEN occurrence = 'unique' THEN first_at - 1 END AS char_start,
  CASE WHEN occurrence = 'unique' THEN first_at - 1 + length(quote) END AS char_end FROM marked
"""

_IS_TEXT = f"field_name IN ({quoted(DATE_FIELDS + TEXT_FIELDS)})"
_IS_NUMBER = f"field_name IN ({quoted(INTEGER_FIELDS + NUMBER_FIELDS)})"
TYPED = f"""CASE WHEN field_name IN ({quoted(BOOLEAN_FIELDS)}) THEN value_type = 'bool'
  WHEN field_name IN ({quoted(INTEGER_FIELDS)}) THEN value_type = 'int'
  WHEN field_name IN ({quoted(NUMBER_FIELDS)}) THEN value_type IN ('int', 'double')
  WHEN {_IS_TEXT} THEN value_type = 'string' AND trim(raw_value) <> '' ELSE true END"""
_RANGE = f"""(field_name IN ({quoted(INTEGER_FIELDS)}) AND number < 0
  OR field_name = 'installed_capacity_mw' AND number <= 0)"""
_UNITS = "CASE field_name " + " ".join(
    f"WHEN '{f}' THEN '{u}'" for f, u in EXPECTED_UNITS.items()
) + " END"
_ISO = r"regexp_full_match(raw_value, '\d{4}-\d{2}-\d{2}')"
_DATED = f"typed AND field_name IN ({quoted(DATE_FIELDS)})"
CODES = ", ".join(
    f"CASE WHEN {condition} THEN '{code}' END"
    for code, condition in (
        ("field_contract_pending", f"NOT ({_IS_TEXT}) AND NOT ({_IS_NUMBER}) AND field_name NOT IN "
                                   f"({quoted(BOOLEAN_FIELDS)})"),
        ("field_type_invalid", "NOT typed"),
        ("numeric_range_invalid", f"typed AND {_IS_NUMBER} AND {_RANGE}"),
        ("negative_value_requires_domain_rule",
         f"typed AND {_IS_NUMBER} AND NOT {_RANGE} AND number < 0"),
        ("date_format_unresolved", f"{_DATED} AND NOT {_ISO}"),
        ("date_calendar_invalid", f"{_DATED} AND {_ISO} AND try_cast(raw_value AS DATE) IS NULL"),
        ("unit_unverified", f"{_UNITS} IS NOT NULL AND unit IS DISTINCT FROM {_UNITS}"),
        ("confidence_unknown", "confidence IS NULL"),
        ("confidence_below_threshold", "confidence < 0.8"),
        ("candidate_conflict", "kinds > 1"),
        ("semantic_support_pending", "true"),
    )
)
VALIDATED = f"""{GROUNDED},
kinds AS (SELECT extraction_run_id, field_name,
    count(DISTINCT value_json || '|' || coalesce('u' || unit, '-')) AS kinds
  FROM recorded WHERE raw_value IS NOT NULL GROUP BY 1, 2),
prepared AS (SELECT r.*, k.kinds, o.outcome,
    CASE WHEN value_type IN ('int', 'double') THEN CAST(r.raw_value AS DOUBLE) END AS number,
    {TYPED.replace("raw_value", "r.raw_value").replace("field_name", "r.field_name").replace("value_type", "r.value_type")} AS typed
  FROM recorded r LEFT JOIN kinds k ON k.extraction_run_id = r.extraction_run_id
    AND k.field_name = r.field_name
  LEFT JOIN (SELECT extraction_run_id, observation_index, outcome FROM outcomes) o
    ON o.extraction_run_id = r.extraction_run_id AND o.observation_index = r.observation_index),
coded AS (SELECT *, CASE WHEN raw_value IS NULL
    THEN CASE WHEN missing_reason = 'ambiguous' THEN 'ambiguous_abstention' ELSE '' END
    ELSE concat_ws(',', CASE WHEN evidence_version <> document_version_id
        THEN 'evidence_version_invalid' ELSE CASE outcome
          WHEN 'page_missing' THEN 'evidence_page_invalid'
          WHEN 'quote_missing' THEN 'evidence_quote_missing'
          WHEN 'offsets_missing' THEN 'evidence_offsets_missing'
          WHEN 'offsets_mismatch' THEN 'evidence_offsets_invalid' END END, {CODES})
    END AS issue_codes FROM prepared),
checks AS (SELECT *, CASE WHEN regexp_matches(issue_codes,
      'evidence_version|evidence_page|evidence_quote|offsets_invalid|field_type|numeric_range|calendar')
    THEN 'rejected' WHEN issue_codes <> '' THEN 'needs_review' ELSE 'missing' END AS status
  FROM coded)"""
ORACLES["candidate_validation"] = f"""
WITH {VALIDATED} SELECT extraction_run_id, observation_index, status, issue_codes FROM checks
"""
ORACLES["validation_counts"] = f"""
WITH {VALIDATED} SELECT extraction_run_id, count(*) FILTER (status = 'missing') AS missing,
  count(*) FILTER (status = 'rejected') AS rejected,
  count(*) FILTER (status = 'needs_review') AS needs_review FROM checks GROUP BY 1
"""
ORACLES["candidate_conflicts"] = f"""
WITH {VALIDATED} SELECT extraction_run_id, field_name FROM kinds WHERE kinds > 1
"""

# ---------------------------------------------------------------------------- consistency
ACTIVE = f"""{VALIDATED},
active AS (SELECT *, value_json || '|' || coalesce('u' || unit, '-') AS value_key FROM checks
  WHERE status <> 'rejected' AND raw_value IS NOT NULL),
singles AS (SELECT registry, project_id, validation_run_id, field_name,
    count(DISTINCT value_key) = 1 AS is_unique, min(raw_value) AS v, min(value_type) AS t,
    min(unit) AS u FROM active GROUP BY 1, 2, 3, 4)"""
_P = "registry, project_id"


def _pair(first: str, second: str, code: str) -> str:
    return f"""SELECT registry, project_id, '{first},{second}' AS fields, validation_run_id,
    {code} AS code FROM (SELECT registry, project_id, validation_run_id,
      coalesce(bool_or(field_name = '{first}' AND is_unique)
        AND bool_or(field_name = '{second}' AND is_unique), false) AS both_unique,
      max(CASE WHEN field_name = '{first}' THEN v END) AS v1,
      max(CASE WHEN field_name = '{second}' THEN v END) AS v2,
      max(CASE WHEN field_name = '{first}' THEN u END) AS u1,
      max(CASE WHEN field_name = '{second}' THEN u END) AS u2
    FROM singles WHERE field_name IN ('{first}', '{second}') GROUP BY 1, 2, 3)"""


_DAY = r"CASE WHEN regexp_full_match({0}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN try_cast({0} AS DATE) END"
_PAIRS = [
    _pair(
        *pair,
        f"""CASE WHEN NOT both_unique THEN 'date_pair_incomplete_or_conflicting'
      WHEN {_DAY.format("v1")} IS NULL OR {_DAY.format("v2")} IS NULL THEN 'date_pair_not_evaluable'
      WHEN {_DAY.format("v1")} > {_DAY.format("v2")} THEN 'date_order_reversed' END""",
    )
    for pair in DATE_PAIRS
]
_PAIRS += [
    _pair(
        *pair,
        "CASE WHEN both_unique AND v1 = 'false' AND try_cast(v2 AS DOUBLE) <> 0 "
        "THEN 'applicability_value_difference' END",
    )
    for pair in APPLICABILITY_PAIRS
]
_PAIRS.append(
    _pair(
        *ENERGY_PAIR,
        "CASE WHEN both_unique AND u1 IS DISTINCT FROM u2 THEN 'energy_unit_difference' END",
    )
)
CONSISTENT = f"""{ACTIVE},
reports AS ({local(adapters.REPORT_VERSIONS)}),
sets AS (SELECT {_P}, field_name, validation_run_id,
    string_agg(DISTINCT value_key, ';' ORDER BY value_key) AS signature
  FROM active WHERE field_name IN ({quoted(PROJECT_FIELDS)}) GROUP BY ALL),
signatures AS (SELECT {_P}, field_name, count(DISTINCT signature) AS signatures,
    count(DISTINCT r.source_document_id) AS sources, count(DISTINCT r.document_version_id) AS versions
  FROM sets JOIN reports r USING (validation_run_id) GROUP BY ALL),
issues AS (SELECT * FROM ({" UNION ALL ".join(_PAIRS)}) WHERE code IS NOT NULL
  UNION ALL
  SELECT registry, project_id, 'methodology_name', NULL, 'methodology_scope_unconfirmed'
  FROM (SELECT DISTINCT {_P} FROM checks) p WHERE NOT EXISTS (SELECT 1 FROM active a
      WHERE a.registry = p.registry AND a.project_id = p.project_id
        AND a.field_name = 'methodology_name')
    OR EXISTS (SELECT 1 FROM active a WHERE a.registry = p.registry AND a.project_id = p.project_id
        AND a.field_name = 'methodology_name' AND a.raw_value <> 'ACM0002')
  UNION ALL
  SELECT registry, project_id, field_name, NULL, CASE WHEN sources > 1
    THEN 'cross_document_difference' WHEN versions > 1 THEN 'cross_version_difference'
    ELSE 'extractor_difference' END FROM signatures WHERE signatures > 1)"""
ORACLES["consistency_issues"] = f"""
WITH {CONSISTENT} SELECT registry, project_id, code, fields, validation_run_id FROM issues
"""
ORACLES["consistency_links"] = f"""
WITH {CONSISTENT} SELECT i.registry, i.project_id, i.code, count(*) AS links,
  sum(a.observation_index) AS index_sum
FROM issues i JOIN active a ON a.registry = i.registry AND a.project_id = i.project_id
  AND list_contains(string_split(i.fields, ','), a.field_name)
  AND (i.validation_run_id IS NULL OR i.validation_run_id = a.validation_run_id)
GROUP BY ALL
"""
ORACLES["comparison_status"] = f"""
WITH {CONSISTENT} SELECT p.registry, p.project_id,
  CASE WHEN coalesce(bool_or(s.versions > 1), false) THEN 'performed' ELSE 'not_possible' END
    AS cross_document_comparison
FROM (SELECT DISTINCT {_P} FROM checks) p LEFT JOIN signatures s
  ON s.registry = p.registry AND s.project_id = p.project_id GROUP BY ALL
"""
ORACLES["active_candidates"] = f"""
WITH {ACTIVE} SELECT field_name, count(*) AS candidates, count(DISTINCT value_key) AS value_count
FROM active GROUP BY 1
"""
ORACLES["unique_report_values"] = f"""
WITH {ACTIVE} SELECT DISTINCT a.validation_run_id, a.field_name, a.value_json, a.unit
FROM active a JOIN singles s USING (validation_run_id, field_name) WHERE s.is_unique
"""

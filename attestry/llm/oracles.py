"""DuckDB statements for the corpus queries that SQL can express."""

from attestry.llm import licenses

ORACLES: dict[str, str] = {"op3_licenses": licenses.oracle()}

ORACLES["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position
  FROM documents
), keyed AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM lines
), held AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, h.keeper IS NOT NULL AND h.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN held h USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

ORACLES["op10_decontamination"] = r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents
), item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size,
         array_to_string(list_slice(words, i, i + least(10, len(words)) - 1), ' ') AS phrase
  FROM (SELECT *, unnest(generate_series(1, greatest(1, len(words) - 9))) AS i FROM item_words WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(list_slice(words, i, i + size - 1), ' ') AS phrase
  FROM (SELECT d.*, s.size, unnest(generate_series(1, len(words) - s.size + 1)) AS i FROM doc_words d, sizes s)
), occurrences AS (
  SELECT d.doc_id, d.size, d.i, w.item_id FROM doc_windows d JOIN item_windows w USING (size, phrase)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM occurrences) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occurrences) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

#: crc32 goes byte by byte through a table that its polynomial gives.
ORACLES["op11_spelling"] = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, step: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
), runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 5 GROUP BY doc_id, run
), bytes AS (
  SELECT doc_id, run, times, list_transform(range(length(code) // 2),
           lambda i: CAST('0x' || substr(code, CAST(2 * i + 1 AS INT), 2) AS BIGINT)) AS codes
  FROM (SELECT *, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS code FROM runs)
), hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, codes),
           lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM bytes, crc
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT))
              || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, CAST(sum(times) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(times) >= 3
), shorter AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT *, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b USING (rest, i) WHERE a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(rank := -other_n, form := other)) AS best FROM near GROUP BY word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best.rank >= 2 * w.n THEN best.form END AS form,
         CASE WHEN -best.rank >= 2 * w.n THEN -best.rank END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chains AS (
  SELECT word, word AS root FROM judged WHERE form IS NULL
  UNION ALL SELECT j.word, c.root FROM judged j JOIN chains c ON j.form = c.word
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN chains USING (word)
"""

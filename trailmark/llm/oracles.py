"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"'[^\x20\x09-\x0D]+'"

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_WORDS}) AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM d, UNNEST(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS t(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT reach.doc_id, y FROM reach JOIN both_ways ON r = x)
SELECT doc_id, coalesce(max(n), 0) AS n_shingles, min(r) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

SUBSTRING_DEDUP = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
windows AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) AS nth
  FROM d, UNNEST(range(1, len(w) - 18)) AS t(i)),
removed AS (SELECT DISTINCT doc_id, i + k AS i FROM windows, UNNEST(range(0, 20)) AS u(k) WHERE nth > 1),
placed AS (SELECT doc_id, i, w[i] AS word FROM d, UNNEST(range(1, len(w) + 1)) AS t(i)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS words, count(*) AS n
  FROM placed ANTI JOIN removed USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(words, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

SEARCH = f"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_TERMS})) AS term
  FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
asked AS (
  SELECT DISTINCT item_id,
    unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), {_TERMS})) AS term
  FROM benchmark),
held AS (
  SELECT term, doc_id, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, totals GROUP BY term),
parts AS (
  SELECT term, doc_id, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))) AS part
  FROM held JOIN weights USING (term) JOIN sizes USING (doc_id), totals),
scores AS (
  SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN parts USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 10"""

ORACLES = {"op3_ngram_join": NGRAM_JOIN, "op6_substring_dedup": SUBSTRING_DEDUP, "op11_search": SEARCH}

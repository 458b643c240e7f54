"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

#: Characters stripped from a line's ends, and the A-Z fold.
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_FOLD = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _key(line: str) -> str:
    return f"translate(trim({line}, {_TRIM}), {_FOLD})"


OP5 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, {_key("line")} AS k FROM lines
), shared AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE keep IS NOT NULL AND keep <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keep IS NULL OR keep = doc_id), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (k)
GROUP BY doc_id
"""

OP10 = f"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, source FROM documents
), lines AS (
  SELECT doc_id, source, line, {_key("line")} AS k,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS nw
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM base)
), held AS (
  SELECT source, k, count(DISTINCT doc_id) AS docs FROM lines WHERE k <> '' GROUP BY ALL
), per_line AS (
  SELECT l.doc_id, count(*) FILTER (WHERE l.k <> '') - count(DISTINCT l.line) FILTER (WHERE l.k <> '') AS n_dup_lines,
         coalesce(sum(l.nw) FILTER (WHERE h.docs > 20), 0) AS removed_words
  FROM lines l LEFT JOIN held h ON l.source IS NOT DISTINCT FROM h.source AND l.k = h.k
  GROUP BY l.doc_id
), ws AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM base
), grams AS (
  SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, array_to_string(w[i : i + 7], ' ') AS g FROM ws WHERE len(w) >= 8
), many AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1
), cover AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM many, range(0, 8) AS r(j) GROUP BY doc_id
), feats AS (
  SELECT ws.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(removed_words AS BIGINT) AS removed_words
  FROM ws JOIN per_line USING (doc_id) LEFT JOIN cover USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND NOT 100 * (n_words - removed_words) < 30 * n_words AS kept
FROM feats
"""

OP11 = """
WITH label AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), doc AS (
  SELECT d.doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents AS d LEFT JOIN label USING (doc_id)
), failing AS (
  SELECT part, good, toxic,
         CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM doc
), mask AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6)) AS step)
), hit AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS here, fails = f AS alone,
         translate(fails, before, '') = fails AS reached
  FROM steps, mask
), step_rows AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, f,
         coalesce(sum(n) FILTER (WHERE reached AND NOT here), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE reached AND here), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE here AND NOT reached), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE alone), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE reached AND here), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE reached AND here), 0) AS toxic_lost
  FROM hit GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM step_rows
"""

ORACLES = {"op5_line_dedup": OP5, "op10_quality": OP10, "op11_filter_audit": OP11}

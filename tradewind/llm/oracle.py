"""SQL twins of the training-data queries, for DuckDB, where SQL can express them."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op7_decontaminate"] = f"""
WITH item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
span AS (
  SELECT item_id, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i, w FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM span),
size AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM doc, size WHERE len(w) >= n),
cut AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM place),
hit AS (SELECT doc_id, item_id, i, n FROM cut JOIN win USING (n, t)),
word AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

ORACLES["op1_minhash_dedup"] = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
place AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM doc WHERE len(w) > 0),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM place),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * pair.n >= 85 * (x.n + y.n - pair.n)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.other)
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN size USING (doc_id)
"""

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES["op8_line_dedup"] = f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM line),
many AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT keyed.*, keeper IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN many USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# kind, pattern, group, least length of the group; base kinds first.
_SECRETS = [
    ("assign", """(?i)(password|passwd|secret|token|api_?key)["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("code_host", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("web_token", "eyJ[A-Za-z0-9_-]{8,}\\\\.eyJ[A-Za-z0-9_-]{8,}\\\\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("url_login", "://[^\\\\s/:@]+:[^\\\\s/:@]+@", 0, 1),
]


def _secret(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, start, stop FROM (
    SELECT doc_id, g, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS stop, stop - length(m) AS start
    FROM (
      SELECT doc_id, unnest(string_split_regex(text, {p})) AS gap,
             unnest(regexp_extract_all(text, {p}, 0)) AS m, unnest(regexp_extract_all(text, {p}, {group})) AS g,
             generate_subscripts(string_split_regex(text, {p}), 1) AS i
      FROM documents WHERE regexp_matches(text, {p})) WHERE m IS NOT NULL)
  WHERE length(g) >= {least}"""


ORACLES["op5_secret_index"] = f"""
WITH span AS ({" UNION ALL ".join(_secret(i, *r) for i, r in enumerate(_SECRETS))}),
part AS (
  SELECT doc_id, rank, kind, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS s FROM span),
per AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(s, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base, string_agg(s, ',' ORDER BY start, rank) AS spans
  FROM part GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN per USING (doc_id)
"""

ORACLES["op13_filter_audit"] = """
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
same AS (SELECT text, min(doc_id) AS keeper FROM doc GROUP BY text),
mark AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
bad AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN keeper IS NOT NULL AND (doc_id IS NULL OR doc_id > keeper) THEN 'E' ELSE '' END AS fails
  FROM doc JOIN same USING (text) LEFT JOIN mark USING (doc_id)),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
turn AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
step AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM turn),
seen AS (
  SELECT bad.*, o, step, contains(fails, o[step]) AS failing,
         length(translate(o[1:step - 1], fails, '')) < step - 1 AS gone
  FROM bad, step),
tally AS (
  SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step,
         count(*) FILTER (WHERE NOT failing AND NOT gone) AS kept, count(*) FILTER (WHERE failing AND NOT gone) AS removed,
         count(*) FILTER (WHERE failing AND gone) AS redundant, count(*) FILTER (WHERE fails = o[step]) AS unique_fails,
         count(*) FILTER (WHERE failing AND NOT gone AND good) AS good_lost,
         count(*) FILTER (WHERE failing AND NOT gone AND toxic) AS toxic_lost
  FROM seen GROUP BY part, o, step)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM tally
"""

ORACLES["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""

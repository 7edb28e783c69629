"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

# Whole conversations; an escape adds one backslash to each control string of a text.
CHAT = r"""
WITH told AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### ') + length(role) + 2 * len(regexp_extract_all(role, '[%:#<\n\r]')) + length(': ')
    + length(text) + len(regexp_extract_all(text, '### |</turn>')) + length('_</turn>_')) AS BIGINT) AS formatted_chars
FROM told GROUP BY conv_id
"""

# All pairs within a label, then what links reach.
DEDUP = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
named AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN named ON named.a = v.vec_id LEFT JOIN counted ON counted.a = v.vec_id
"""


def vector_codes(rounds: int = 6) -> str:
    """Assign and average ``rounds`` times; `b` codebooks, `a` the nearest entry of every part."""
    assign = """
a{0} AS MATERIALIZED (
  SELECT r, p.part, min(list_sum(list_transform(list_zip(p.x, b.x), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT))) * 16 + entry) AS k
  FROM p JOIN b{0} b ON b.part = p.part GROUP BY r, p.part)"""
    average = """
m{1} AS (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
  FROM (SELECT p.part, a.k % 16 AS entry, i, sum(p.x[i]) AS s, count(*) AS n
        FROM p JOIN a{0} a ON a.r = p.r AND a.part = p.part, LATERAL (SELECT unnest(range(1, len(p.x) + 1)) AS i)
        GROUP BY p.part, a.k % 16, i)
  GROUP BY part, entry),
b{1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{0} b LEFT JOIN m{1} m ON m.part = b.part AND m.entry = b.entry)"""
    steps = ",".join(assign.format(n) + "," + average.format(n, n + 1) for n in range(rounds)) + "," + assign.format(rounds)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS HUGEINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT r, part, e[part * len(e) // 8 + 1 : (part + 1) * len(e) // 8] AS x FROM v, LATERAL (SELECT unnest(range(8)) AS part)),
b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x FROM p WHERE r <= 16),{steps},
books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM b{rounds}),
coded AS (
  SELECT r, string_agg(lpad(lower(hex(CAST(k % 16 AS BIGINT))), 2, '0'), '' ORDER BY part) AS code, CAST(sum(k // 16) AS BIGINT) AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM v JOIN coded ON coded.r = v.r, books
"""



# All terms of all pairs, zeros included.
AUDIT = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
t AS MATERIALIZED (
  SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term, count(*) AS lang_n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS MATERIALIZED (
  SELECT lang, source, coalesce((SELECT sum(n) FROM c WHERE c.lang = s.lang AND c.source = s.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) s),
shares AS MATERIALIZED (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 1)::HUGEINT) // (total + v) AS p,
    1 + (1000000000 * (lang_n + 1)::HUGEINT) // (lang_total + v) AS q
  FROM g JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
  ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
  SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // q AS BIGINT) AS value FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
  CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT * FROM (
  SELECT lang, source, 'term', item, value,
    CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms)
WHERE rank <= 200
"""

STATEMENTS = {"op6_embedding_dedup": DEDUP, "op9_chat_format": CHAT, "op11_vector_codes": vector_codes(), "op12_source_divergence": AUDIT}

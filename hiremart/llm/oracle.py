"""DuckDB SQL of the subpackage's queries, where SQL can express them."""

from __future__ import annotations

from hiremart.llm.secret_scan import PATTERNS

SQL: dict[str, str] = {}

SQL["op3_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
          FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS doc_id, a AS r FROM edge
          UNION SELECT reach.doc_id, edge.b FROM reach JOIN edge ON reach.r = edge.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.r, d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT doc_id, min(r) AS r FROM reach GROUP BY 1) c USING (doc_id)
"""

SQL["op1_source_mix"] = r"""
WITH l AS (SELECT doc_id, max(quality) AS q FROM labels GROUP BY 1),
d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             CASE q WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS q
      FROM documents LEFT JOIN l USING (doc_id)),
k AS (SELECT *, -ln((('0x' || md5('17|' || coalesce(doc_id::VARCHAR, 'null') || '|' || size)[1:13])::BIGINT + 0.5::DOUBLE)
                    / 4503599627370496::DOUBLE) / q AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS z,
             [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
      FROM d GROUP BY source),
r AS (SELECT a.source, a.z, a.w, 3 * sum(b.z)::BIGINT AS budget2,
             4 * coalesce(sum(b.z) FILTER (b.z * a.w < a.z * b.w), 0)::BIGINT AS capped2,
             coalesce(sum(b.w) FILTER (b.z * a.w >= a.z * b.w), 0)::BIGINT AS free_w
      FROM s a, s b GROUP BY ALL),
level AS (SELECT arg_min(budget2 - capped2, z / w) AS num, arg_min(free_w, z / w) AS den
          FROM r WHERE (budget2 - capped2) * w < 4 * z * free_w),
t AS (SELECT source, z, CASE WHEN num IS NULL OR num * w >= 4 * z * den THEN 2 * z ELSE num * w // (2 * den) END AS words,
             CASE WHEN num IS NULL OR num * w >= 4 * z * den THEN (2 * z)::DOUBLE
                  ELSE (num * w)::DOUBLE / (2 * den)::DOUBLE END AS target
      FROM s, level),
p AS (SELECT k.*, z, target, words, words // nullif(z, 0) AS e,
             coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, z AS source_size, target,
       (coalesce(e, 0) * size + greatest(0, least(size, words - coalesce(e, 0) * z - before)))::BIGINT AS taken
FROM p
"""

_COVER = """
SELECT doc_id, n, sum(chars)::BIGINT AS chars, count(*) AS n_words FROM (
  SELECT DISTINCT doc_id, n, i + j AS i
  FROM (SELECT doc_id, n, i, count(*) OVER (PARTITION BY doc_id, n, gram) AS k
        FROM (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i,
                     unnest([array_to_string(w[x:x + n - 1], ' ') for x in range(1, len(w) - n + 2)]) AS gram
              FROM w, (SELECT unnest([3, 5, 8, 10]) AS n))),
       unnest(range(0, n)) AS o(j)
  WHERE k > 1)
JOIN (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest([len(x) for x in w]) AS chars FROM w) USING (doc_id, i)
GROUP BY ALL
"""

SQL["op6_warc_archive"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, unhex(sha1(html))::BIT::VARCHAR AS bits, html FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY bits) AS first FROM h)
SELECT page_id, payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + 16 * bits[5*i+1]::INT + 8 * bits[5*i+2]::INT + 4 * bits[5*i+3]::INT + 2 * bits[5*i+4]::INT + bits[5*i+5]::INT, 1)
           for i in range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
"""

SQL["op7_repetition_rules"] = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
c AS (""" + _COVER + r"""),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
worded AS (SELECT doc_id, line, count(*) AS k, len(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
           FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
l AS (SELECT doc_id, sum(k - 1)::BIGINT AS n_dup_lines, sum((k - 1) * chars)::BIGINT AS dup_line_chars FROM worded GROUP BY 1),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([len(x) for x in w]), 0)::BIGINT AS word_chars,
             len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(c3.n_words, 0) AS n_repeat_words,
             coalesce(c5.chars, 0) AS dup_5, coalesce(c8.chars, 0) AS dup_8, coalesce(c10.chars, 0) AS dup_10,
             coalesce(dup_line_chars, 0) AS dup_line_chars
      FROM w LEFT JOIN l USING (doc_id)
      LEFT JOIN c c3 ON c3.doc_id = w.doc_id AND c3.n = 3 LEFT JOIN c c5 ON c5.doc_id = w.doc_id AND c5.n = 5
      LEFT JOIN c c8 ON c8.doc_id = w.doc_id AND c8.n = 8 LEFT JOIN c c10 ON c10.doc_id = w.doc_id AND c10.n = 10)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND 100 * dup_5 <= 30 * word_chars
       AND 100 * dup_8 <= 25 * word_chars AND 100 * dup_10 <= 20 * word_chars
       AND 100 * dup_line_chars <= 30 * word_chars AS kept
FROM m
"""


def _finds(kind: str, place: int, pattern: str, value: str) -> str:
    p = pattern.replace("'", "''")
    return f"""
SELECT doc_id, source, '{kind}' AS kind, {place} AS k, {value.format(p=p)} AS value, finish - len(hit) AS start, finish
FROM (SELECT doc_id, source, hit, sum(len(gap) + len(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS finish
      FROM (SELECT doc_id, source, unnest(range(len(m))) AS i, unnest(m) AS hit, unnest(g[1:len(m)]) AS gap
            FROM (SELECT doc_id, source, regexp_extract_all(text, '{p}') AS m, regexp_split_to_array(text, '{p}') AS g
                  FROM documents WHERE text IS NOT NULL)))"""


SQL["op8_secret_scan"] = f"""
WITH f AS ({" UNION ALL ".join([
    _finds("assign", 0, PATTERNS["assign"], "regexp_extract(hit, '{p}', 2)"),
    _finds("access", 1, PATTERNS["access"], "hit"), _finds("hex", 2, PATTERNS["hex"], "hit"),
    _finds("bare", 3, PATTERNS["bare"], "hit")])}),
g AS (SELECT * FROM f WHERE (k > 0 OR len(value) >= 8) AND (k < 3 OR (regexp_matches(value, '[0-9]')
      AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')
      AND len(list_distinct(string_split(value, ''))) >= 12))),
h AS (SELECT * FROM g WHERE k < 3 OR NOT EXISTS (SELECT 1 FROM g b WHERE b.k < 3 AND b.doc_id = g.doc_id
      AND b.start < g.finish AND g.start < b.finish)),
o AS (SELECT value, count(DISTINCT coalesce(source, '')) AS owners FROM h GROUP BY 1),
j AS (SELECT h.*, owners FROM h JOIN o USING (value) WHERE k < 3 OR owners < 3),
a AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, k) FILTER (k < 3) AS base,
             string_agg(kind || ':' || start || ':' || finish, ',' ORDER BY start, k) AS spans,
             count(*) FILTER (owners = 1) AS n_live, count(*) FILTER (owners >= 3) AS n_example
      FROM j GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM documents d LEFT JOIN a USING (doc_id)
"""


_ROUND = """
b{r} AS MATERIALIZED (
  SELECT rid, any_value(x) AS x, min(list_sum([(x[i] - y[i]) * (x[i] - y[i]) for i in range(1, 65)])::HUGEINT
         * 64 + cluster) AS m
  FROM (SELECT rid, v.x, c.x AS y, cluster FROM v, c{r} AS c) GROUP BY rid),
"""
_MEANS = """
s{r} AS (SELECT cluster, i, sum(e)::HUGEINT AS s, count(*)::HUGEINT AS n
         FROM (SELECT (m % 64)::BIGINT AS cluster, unnest(range(1, 65)) AS i, unnest(x) AS e FROM b{r}) GROUP BY ALL),
c{next} AS MATERIALIZED (
  SELECT cluster, coalesce(y, x) AS x FROM c{r}
  LEFT JOIN (SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y FROM s{r} GROUP BY 1) USING (cluster)),
"""

SQL["op12_centroid_clusters"] = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, [floor(256 * c::DOUBLE)::BIGINT for c in embedding] AS x
  FROM embeddings WHERE len(embedding) = 64 AND len([1 for c in embedding if c IS NULL OR NOT isfinite(c)]) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x
  FROM (SELECT sha256('2:' || vec_id) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT 40)),
""" + "".join(_ROUND.format(r=r) + (_MEANS.format(r=r, next=r + 1) if r < 5 else "") for r in range(6)) + """
o AS (SELECT rid, (m % 64)::INTEGER AS cluster, (m // 64)::BIGINT AS distance FROM b5)
SELECT vec_id, o.cluster, distance, (sum(distance) OVER (PARTITION BY o.cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c5.x, ',')) AS centroid_sha256
FROM o JOIN v USING (rid) JOIN c5 ON c5.cluster = o.cluster
"""


def sql() -> dict[str, str]:
    return dict(SQL)

"""DuckDB SQL for the queries whose whole result SQL can state."""

from __future__ import annotations

#: Base32 of the SHA-1: each 10 hex digits are 8 characters of 5 bits.
_BASE32 = " || ".join(
    f"(SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {k}, 10))::BIGINT >> (35 - 5 * j)) & 31) + 1)::INT, 1), '' ORDER BY j) FROM range(8) t(j))"
    for k in (1, 11, 21, 31)
)

_WARC = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS r,
         first_value(page_id) OVER (PARTITION BY coalesce(html, '') ORDER BY page_id NULLS LAST) AS f
  FROM pages)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN r > 1 THEN f END AS refers_to
FROM p
"""

#: CRC-32 of the decimal id: each byte is folded in by eight shifts.
_CRC = """
xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(c::VARCHAR) + 1), lambda k: ascii(substr(c::VARCHAR, k::INT, 1))::BIGINT)),
  lambda acc, b: list_reduce(list_concat([xor(acc, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))
"""

_TRIE = f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS s, strlen(coalesce(text, '')) AS b
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT c, {_CRC} % 9 AS h FROM (SELECT DISTINCT c FROM t)),
heads AS (SELECT c.c, t.p AS d, t.s, t.b FROM c JOIN t ON t.c = c.c - c.c % 5 AND t.p <= c.h),
taken AS (SELECT c.c, c.h, (SELECT count(*) FROM heads WHERE heads.c = c.c) AS n FROM c),
r AS (SELECT * FROM heads UNION ALL SELECT t.c, taken.n + t.p - taken.h, t.s, t.b FROM t JOIN taken ON t.c = taken.c WHERE t.p > taken.h),
m AS (SELECT c, d, b, sha256(string_agg(s, ',' ) OVER (PARTITION BY c ORDER BY d)) AS path FROM r
      UNION ALL SELECT c, 0, 0, '' FROM c),
w AS (SELECT *, lag(path) OVER (PARTITION BY c ORDER BY d) AS up, lead(path) OVER (PARTITION BY c ORDER BY d) AS down FROM m),
n AS (SELECT path, any_value(d) AS d, min(c) AS conv_id, any_value(up) AS up, any_value(b) AS b, count(*) AS n_convs, count(DISTINCT down) AS n_children,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE down IS NULL), '') AS ends
      FROM w GROUP BY path),
sub AS (SELECT a.path, sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(CASE WHEN x.d > 0 THEN (x.n_convs - 1) * x.b ELSE 0 END) AS saved
        FROM n x JOIN w y ON y.c = x.conv_id AND y.d <= x.d JOIN n a ON a.path = y.path GROUP BY a.path)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, n.n_children::BIGINT AS n_children,
       sub.n_leaves::BIGINT AS n_leaves, sub.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN sub USING (path) LEFT JOIN n u ON u.path = n.up
"""

_NEGATIVES = """
WITH e AS (
  SELECT vec_id AS i, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.i AS a, b.i AS b, a.l = b.l AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.i <> b.i WHERE a.i % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r FROM s WHERE same) WHERE r <= 5),
f AS (SELECT p.a, p.b AS p, p.score AS ps, s.b AS n, s.score AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS r
      FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT a AS anchor_id, p AS positive_id, r::INT AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM f WHERE r <= 10
"""

ORACLE_SQL: dict[str, str] = {"op11_warc": _WARC, "op12_prefix_trie": _TRIE, "op13_hard_negatives": _NEGATIVES}

"""The results of some queries as DuckDB SQL."""

from __future__ import annotations

import string

JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) m USING (doc_id)"""

# CRC-32 by its definition: the reversed polynomial, a table of 256 remainders, one step a byte.
SHARDS = """
WITH bits AS (
  SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
  FROM (SELECT unnest(range(256)) AS b)),
crc AS (SELECT list(t ORDER BY b) AS t FROM bits),
d AS (SELECT doc_id, encode(coalesce(text, '')) AS raw, text FROM documents),
c AS (
  SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 1 ELSE octet_length(raw) + 1 END AS BIGINT) AS size,
    xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(raw), '..'), lambda h: CAST('0x' || h AS BIGINT))),
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32 FROM d, crc),
u AS (
  SELECT DISTINCT doc_id, s, (CAST('0x' || substr(md5(doc_id || ':' || s), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents, (SELECT unnest(range(9)) AS s)),
k AS (SELECT doc_id, CAST(arg_max(s, -1.0::DOUBLE / ln(u)) FILTER (s < 8) AS INTEGER) AS shard, CAST(arg_max(s, -1.0::DOUBLE / ln(u)) AS INTEGER) AS grown_shard FROM u GROUP BY 1)
SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM c JOIN k USING (doc_id)"""

"""Registered queries of HyperMinHash, sharded Lloyd and the prefix trie, with DuckDB counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricehouse.llm import hyperminhash, sharded_kmeans, turn_trie
from pricehouse.llm.text import let_workers_import


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op11_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return hyperminhash.near_duplicates(_table(spark, folder, "documents"))


def op12_sharded_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    return sharded_kmeans.with_digests(*sharded_kmeans.cluster(_table(spark, folder, "embeddings")))


def op13_turn_trie(spark: SparkSession, folder: str) -> DataFrame:
    return turn_trie.report(_table(spark, folder, "conversations"))


_OP11 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS x
  FROM d),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.r < b.r GROUP BY a.r, b.r),
l AS (SELECT a, b FROM p JOIN n na ON a = na.r JOIN n nb ON b = nb.r WHERE 100 * c >= 85 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT r AS f, r AS t FROM d UNION SELECT f, b FROM reach JOIN both_ways ON t = a),
least AS (SELECT f AS r, min(doc_id) AS component_id FROM reach JOIN d ON t = d.r GROUP BY f)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, coalesce(doc_id = component_id, false) AS kept
FROM d JOIN least USING (r) LEFT JOIN n USING (r)
"""

_LLOYD = """
e{i} AS (SELECT r, k, sum((x - y) * (x - y)) AS dist FROM v JOIN c{i} USING (i) GROUP BY r, k),
a{i} AS MATERIALIZED (SELECT r, arg_min(k, row(dist, k)) AS k, min(dist) AS dist FROM e{i} GROUP BY r)"""
_MOVED = """,
m{i} AS (SELECT k, i, sum(x) AS s, count(*) AS n FROM a{i} JOIN v USING (r) GROUP BY k, i),
c{j} AS MATERIALIZED (SELECT k, i, coalesce((s - ((s % n) + n) % n) // n, y) AS y FROM c{i} LEFT JOIN m{i} USING (k, i)),"""

_OP12 = (
    r"""
WITH u AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
v AS MATERIALIZED (
  SELECT r, vec_id, generate_subscripts(embedding, 1) AS i, CAST(floor(1024 * CAST(unnest(embedding) AS DOUBLE)) AS HUGEINT) AS x FROM u),
f AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS k FROM u QUALIFY k < 8),
c0 AS MATERIALIZED (SELECT k, i, x AS y FROM f JOIN v USING (r)),"""
    + "".join(_LLOYD.format(i=i) + (_MOVED.format(i=i, j=i + 1) if i < 10 else "") for i in range(11))
    + r"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia,
       sha256(g) AS centroid_sha256
FROM a10 JOIN u USING (r) JOIN (SELECT k, string_agg(CAST(y AS VARCHAR), ',' ORDER BY i) AS g FROM c10 GROUP BY k) USING (k)
"""
)

# DuckDB has no crc32: eight steps a byte, the first of which takes the byte in.
_OP13 = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS x FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, x, xor(list_reduce(
           list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT) % 9 AS h
  FROM o),
s AS (
  SELECT h.conv_id AS c, list_concat(coalesce(b.x[1:h.h], []), h.x[h.h + 1:]) AS x
  FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT c, x[1:d] AS k, d, len(x) = d AS ended FROM (SELECT c, x, unnest(range(0, len(x) + 1)) AS d FROM s)),
n AS MATERIALIZED (
  SELECT k, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256,
         CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * strlen(k[-1].text) END AS saved
  FROM p GROUP BY k, d),
ch AS (SELECT k[1:depth - 1] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch ON n.k = ch.k),
sub AS (
  SELECT k[1:a] AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT k, n_children, saved, unnest(range(0, depth + 1)) AS a FROM m) GROUP BY 1)
SELECT m.conv_id, m.depth, CASE WHEN m.depth > 0 THEN q.conv_id END AS parent_conv_id, m.n_convs, m.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM m JOIN sub ON m.k = sub.k LEFT JOIN n q ON m.depth > 0 AND q.k = m.k[1:m.depth - 1]
"""

QUERIES = {
    "op11_hyperminhash": op11_hyperminhash,
    "op12_sharded_lloyd": op12_sharded_lloyd,
    "op13_turn_trie": op13_turn_trie,
}

ORACLES = {"op11_hyperminhash": _OP11, "op12_sharded_lloyd": _OP12, "op13_turn_trie": _OP13}

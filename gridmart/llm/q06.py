"""Query and SQL of the jump-hash sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.llm.common import table
from gridmart.llm.sharding import assign_shards

NAME = "op6_jump_shards"
SHARDS = 16


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot under the ``key`` law."""
    return assign_shards(table(spark, sf_dir, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


#: The checksum and the jumps are computed anew: the CRC over a table made by its
#: rule, in pieces of 256 bytes that are joined by advancing the state over as many
#: zeros; the generator in 128-bit integers. The slot of a row follows
#: one bucket per shard, as the query has up to 1.6 million rows.
SQL = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(0, 9), lambda c, i: CASE WHEN i = 0 THEN c WHEN c & 1 = 1
         THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t
  FROM (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS n)
), zeros AS (
  SELECT list(list_reduce(range(0, 256), lambda c, i: xor(c >> 8, t[1 + (c & 255)]), s) ORDER BY j, v) AS z
  FROM (SELECT j, v, v << (8 * j) AS s FROM (SELECT unnest(range(0, 4)) AS j), (SELECT CAST(unnest(range(0, 256)) AS BIGINT) AS v)), crc
), hexed AS (
  SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents
), parts AS (
  SELECT r, i, CASE WHEN i = 0 THEN substr(h, 1, length(h) % 512)
                    ELSE substr(h, length(h) % 512 + 512 * (i - 1) + 1, 512) END AS p
  FROM (SELECT r, h, unnest(range(0, length(h) // 512 + 1)) AS i FROM hexed)
), part_crc AS (
  SELECT r, i, list_reduce(
           list_transform(range(0, length(p) // 2), lambda k: CAST('0x' || substr(p, 2 * k + 1, 2) AS BIGINT)),
           lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]),
           CASE WHEN i = 0 THEN CAST(4294967295 AS BIGINT) ELSE 0 END) AS c
  FROM parts, crc
), joined AS (
  SELECT r, max(c) FILTER (i = 0) AS head, coalesce(list(c ORDER BY i) FILTER (i > 0), []) AS rest
  FROM part_crc GROUP BY r
), summed AS (
  SELECT doc_id, CAST(length(h) // 2 + 1 AS BIGINT) AS size,
         xor(list_reduce(rest, lambda s, c: xor(c, xor(
           xor(z[1 + (s & 255)], z[257 + ((s >> 8) & 255)]),
           xor(z[513 + ((s >> 16) & 255)], z[769 + (s >> 24)]))), head), 4294967295) AS text_crc32
  FROM joined JOIN hexed USING (r), zeros
), jump(doc_id, n, k, b, j) AS (
  SELECT doc_id, n, CAST(doc_id AS HUGEINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
  FROM (SELECT DISTINCT doc_id FROM documents), (SELECT unnest([16, 17]) AS n)
  UNION ALL
  SELECT doc_id, n, k2, j, CAST(floor((j + 1) * (2147483648.0::DOUBLE / CAST(k2 // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616::HUGEINT AS k2 FROM jump WHERE j < n)
), done AS (SELECT doc_id, n, CAST(max(b) AS INTEGER) AS b FROM jump GROUP BY doc_id, n)
SELECT doc_id, size, text_crc32, 'key' AS law, s.b AS shard,
       CAST(row_number() OVER (PARTITION BY s.b ORDER BY doc_id, text_crc32, size) - 1 AS BIGINT) AS slot,
       g.b AS grown_shard
FROM summed JOIN done s USING (doc_id) JOIN done g USING (doc_id) WHERE s.n = 16 AND g.n = 17
"""

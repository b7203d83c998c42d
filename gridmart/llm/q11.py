"""Query and SQL of the ranked lexical search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import table
from gridmart.llm.lexical_search import search

NAME = "op11_lexical_search"
TOP = 10


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that match each benchmark item best."""
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"), TOP)


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
          r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

SQL = f"""
WITH wanted AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents
), long AS (
  SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n, ts FROM docs WHERE len(ts) > 0
), corpus AS (
  SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM long
), tf AS (
  SELECT r, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf
  FROM (SELECT r, doc_id, n, unnest(ts) AS term FROM long)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, doc_id, n, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM tf, corpus GROUP BY term, big_n
), parts AS (
  SELECT item_id, r, doc_id, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))) AS p
  FROM wanted JOIN tf USING (term) JOIN weights USING (term), corpus
), scored AS (
  SELECT item_id, r, doc_id, CAST(sum(p) AS BIGINT) AS score FROM parts GROUP BY item_id, r, doc_id HAVING sum(p) > 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""

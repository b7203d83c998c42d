"""Query and SQL of the line dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.llm.common import table
from gridmart.llm.line_dedup import drop_common_lines

NAME = "op12_line_dedup"
MIN_DOCS = 10
MIN_CHARS = 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, dropped lines and the digest of what stays."""
    return drop_common_lines(table(spark, sf_dir, "documents"), MIN_DOCS, MIN_CHARS).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, doc_id, unnest(ls) AS line, unnest(range(0, len(ls))) AS pos FROM rows
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), common AS (
  SELECT k FROM keyed WHERE length(k) >= {MIN_CHARS}
  GROUP BY k HAVING count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS INTEGER)) >= {MIN_DOCS}
), marked AS (
  SELECT keyed.*, k IN (SELECT k FROM common) AS gone FROM keyed
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

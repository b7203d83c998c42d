"""Query and SQL of the quality-rule cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.llm.common import table
from gridmart.llm.quality_rules import BASE_RULES, judge

NAME = "op8_quality_rules"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document (null text: empty)."""
    rows = judge(table(spark, sf_dir, "documents"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"),
        (~base & F.col("rejected_by").isNull()).alias("kept"),
    )


assert set(BASE_RULES) == {"few_words", "repeated_windows"}

#: One row per document with its counts; ``{docs}`` is the table or subquery read.
COUNTS_SQL = r"""
w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM {docs}
), win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), dup AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM dup, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id
), ln AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), counts AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN ln USING (doc_id)
), verdict AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > n_words OR 10 * n_dup_lines > 6 * n_lines
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR n_upper > n_lower AS method_failed
  FROM counts
)
"""

SQL = "WITH " + COUNTS_SQL.replace("{docs}", "documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       base_failed, NOT base_failed AND NOT method_failed AS kept
FROM verdict
"""

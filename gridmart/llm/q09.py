"""Query of the SimHash near-duplicate operator (XXH64 is not in SQL: no oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmart.llm.common import table
from gridmart.llm.simhash_dedup import near_duplicates

NAME = "op9_simhash_dedup"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

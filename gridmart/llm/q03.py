"""Query of the benchmark decontamination (SimHash is not in SQL: no oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import table
from gridmart.llm.decontamination import find_matches

NAME = "op3_decontaminate"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with every benchmark item it holds."""
    return find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

"""Query of the embedding whitening (exact algebra: no SQL oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import table
from gridmart.llm.whitening import whiten

NAME = "op13_whitening"
SQL = None
COMPONENTS = 8


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the eight components of the largest variance."""
    return whiten(table(spark, sf_dir, "embeddings"), COMPONENTS)

"""Query of the co-trained quality classifier (fitted: no SQL oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import table
from gridmart.llm.quality_cotraining import fit, score

NAME = "op2_quality_cotraining"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by each view and by both."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))

"""Query of the main-text extraction (a trained model: no SQL oracle)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmart.llm.common import table
from gridmart.llm.html_extract import extract, fit

NAME = "op5_html_extract"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, fit(pages))

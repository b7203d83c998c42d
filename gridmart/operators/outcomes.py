"""Classify how a feed fetch ended: only transient failures are worth a retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRANSIENT, PERMANENT, OK = "transient", "permanent", "ok"


def outcome(error_kind: Column, http_status: Column) -> Column:
    """no data -> permanent; HTTP 429 or >= 500 -> transient; other HTTP ->
    permanent; connection / timeout -> transient; no error -> ok; anything
    else is passed through as ``unclassified``."""
    return (
        F.when(error_kind.isNull(), F.lit(OK))
        .when(error_kind == "no_data", F.lit(PERMANENT))
        .when((error_kind == "http") & ((http_status == 429) | (http_status >= 500)), F.lit(TRANSIENT))
        .when(error_kind == "http", F.lit(PERMANENT))
        .when(error_kind.isin("connection", "timeout"), F.lit(TRANSIENT))
        .otherwise(F.lit("unclassified"))
    )


def classify(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("outcome", outcome(F.col("error_kind"), F.col("http_status"))).withColumn(
        "retryable", F.col("outcome") == TRANSIENT
    )

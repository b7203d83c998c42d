"""Price-series selection and window boundaries for landed batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.operators.keys import null_safe_join

# Preference order of the published day-ahead series.
SERIES_PREFERENCE = ("15min", "60min")


def first_available_series(
    df: DataFrame,
    batch: Sequence[str],
    series_col: str = "series_resolution",
    preference: Sequence[str] = SERIES_PREFERENCE,
) -> DataFrame:
    """Keep, per batch, only the rows of the most preferred series present.

    Series are never mixed inside a batch. Batches with no preferred series
    at all are absent from the result; ``batches_emptied`` names them for the
    ledger. Null parts of a batch key are values like any other.
    """
    pref = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(series_col))
    ranked = df.withColumn("_pref", pref).filter(F.col("_pref") > 0)
    best = ranked.groupBy(*batch).agg(F.min("_pref").alias("_best"))
    return (
        null_safe_join(ranked, best, batch)
        .filter(F.col("_pref") == F.col("_best"))
        .drop("_pref", "_best")
    )


def batches_emptied(
    df: DataFrame, batch: Sequence[str], end_col: str, ts: str = "ts_utc",
    series_col: str = "series_resolution", preference: Sequence[str] = SERIES_PREFERENCE,
) -> DataFrame:
    """Batches of ``df`` that the series choice and the boundary leave without rows.

    With the landed row count and ``has_series``: false where no row is of a preferred
    series, true where all rows of the chosen one lie at or after the end. One
    aggregate: rows are left if and only if the best series before the end is the best of all.
    """
    pref = F.array_position(F.array(*[F.lit(p) for p in preference]), F.col(series_col))
    known = F.when(pref > 0, pref)
    return df.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("rows"), F.min(known).alias("_best"),
        F.min(F.when(before_end(end_col, ts), known)).alias("_left"),
    ).filter(
        F.col("_left").isNull() | (F.col("_left") > F.col("_best"))
    ).withColumn("has_series", F.col("_best").isNotNull()).drop("_best", "_left")


def before_end(end_col: str, ts: str = "ts_utc") -> Column:
    """``ts < end``; true for a null stamp or a null end."""
    return F.coalesce(F.col(ts) < F.col(end_col), F.lit(True))


def drop_end_boundary(df: DataFrame, end_col: str, ts: str = "ts_utc") -> DataFrame:
    """Keep ``ts < end``: a feed that includes its end stamp would overlap days.

    A null stamp (or a null end) stays, so that the contract can reject it.
    """
    return df.filter(before_end(end_col, ts))

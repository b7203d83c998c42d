"""Job grid: which (source, zone, market day) batches a run expects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.text import csv_list
from gridmart.functions.time import market_window_end, market_window_start


def run_days(run_date: Column | str, lag_days: int = 1) -> Column:
    """Market day a scheduled run ingests: yesterday by default (a daily
    schedule that waits for revisions uses ``lag_days=2``)."""
    d = F.to_date(F.lit(run_date)) if isinstance(run_date, str) else run_date
    return F.date_sub(d, lag_days)


def backfill_days(bounds: DataFrame, first: str = "first_day", last: str = "last_day") -> DataFrame:
    """One row per market day between the bounds (inclusive)."""
    return bounds.select(
        F.explode(F.sequence(F.col(first), F.col(last), F.expr("INTERVAL 1 DAY"))).alias("market_day")
    )


def with_market_window(days: DataFrame, day: str = "market_day") -> DataFrame:
    """Add the UTC window of each Berlin market day and its length in hours."""
    start, end = market_window_start(day), market_window_end(day)
    return days.select(
        "*",
        start.alias("window_start_utc"),
        end.alias("window_end_utc"),
        ((F.unix_seconds(end) - F.unix_seconds(start)) / F.lit(3600)).cast("bigint").alias("window_hours"),
    )


def job_grid(days: DataFrame, sources: Sequence[str], zones_csv: str | Column) -> DataFrame:
    """sources x zones for every day, generated per day row (no join).

    The zone list arrives as comma text ("DE_LU, AT ,NL") and is split,
    trimmed and emptied of blanks on the executors.
    """
    zones = csv_list(F.lit(zones_csv) if isinstance(zones_csv, str) else zones_csv)
    return days.select(
        "*",
        F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"),
    ).select("*", F.explode(zones).alias("zone_code"))

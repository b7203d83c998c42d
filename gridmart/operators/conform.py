"""Conform bronze revisions to hourly staging rows (one per zone-hour[-type])."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions.time import hour_floor
from gridmart.operators.revisions import latest_revision
from gridmart.specs import MIN_TS, SOURCES


def hourly(
    bronze: DataFrame,
    keys: Sequence[str],
    measure: str,
    since: str = MIN_TS,
) -> DataFrame:
    """Latest revision per interval, nulls dropped after ranking, hourly mean.

    The mean is unweighted over whatever intervals exist in the hour (1 to 4);
    ``intervals_aggregated`` says how many, so derived hourly values are
    visible. On a 15 -> 60 switch the stale quarter-hours still enter the mean;
    on 60 -> 15 the new on-the-hour row replaces the hourly one.
    """
    extra = [k for k in keys if k not in ("zone_code", "ts_utc")]
    recent = bronze.filter(F.col("ts_utc") >= F.lit(since).cast("timestamp"))
    latest = latest_revision(recent, keys)
    # After ranking: a null (or NaN, which Spark does not treat as null and
    # which would poison the mean) latest revision retracts the interval.
    valued = latest.filter(F.col(measure).isNotNull() & ~F.isnan(F.col(measure)))
    # One shuffle on the fact's join keys. After de-duplication a (zone, hour)
    # holds at most a few intervals per type, so this key cannot be hot; the
    # hourly aggregate, the mix aggregate and the fact's left joins all reuse
    # this partitioning instead of shuffling again.
    hourly_rows = valued.withColumn("ts_hour_utc", hour_floor("ts_utc")).repartition(
        "zone_code", "ts_hour_utc"
    )
    return hourly_rows.groupBy("zone_code", "ts_hour_utc", *extra).agg(
        F.avg(measure).alias(measure),
        F.count(F.lit(1)).alias("intervals_aggregated"),
        F.max("resolution_minutes").cast("bigint").alias("source_resolution_minutes"),
        F.max("ingested_at").alias("ingested_at"),
    )


def stg_load(raw_load: DataFrame) -> DataFrame:
    spec = SOURCES["load"]
    return hourly(raw_load, spec.key, spec.measure)


def stg_generation(raw_generation: DataFrame) -> DataFrame:
    spec = SOURCES["generation"]
    return hourly(raw_generation, spec.key, spec.measure)


def stg_price(raw_price: DataFrame) -> DataFrame:
    spec = SOURCES["price"]
    return hourly(raw_price, spec.key, spec.measure)

"""The two jobs a deployment runs: ingest landed files, build the mart.

``ingest_landing`` covers the sources found under one landing root in one call,
for one scheduled market day or for everything that is landed, and returns the
summary of this call; a non-zero ``failures`` is the job's failure signal.
``build_mart`` rebuilds the fact from bronze and publishes it through the gate
(the incremental alternative is ``gridmart.streaming.incremental.refresh``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart import dims, session
from gridmart.functions.text import csv_list
from gridmart.operators import checks, contracts, grid
from gridmart.operators.keys import null_safe_join
from gridmart.plans import ingest as I
from gridmart.plans.fact import fct_from_bronze
from gridmart.plans.publish import publish_fct
from gridmart.sources import bronze, drift, landing
from gridmart.specs import MIN_TS, SOURCES


def _schema(source: str, types: Sequence[str] | None) -> T.StructType:
    if source == "load":
        return landing.LANDING_LOAD
    if source == "price":
        return landing.LANDING_PRICE
    return landing.landing_generation_wide(types) if types else landing.LANDING_GENERATION_TWO_LEVEL


def _read_sound(spark: SparkSession, path: str, source: str, fmt: str, types: Sequence[str] | None,
                scratch: session.Scratch) -> tuple[DataFrame | None, DataFrame | None]:
    """The landed rows of the files that fit their schema, and the verdicts of the others.

    Paths of files reach the driver only if some file is unfit; there are no more than
    the scan itself lists there.
    """
    schema = _schema(source, types)
    verdicts = scratch.stage(drift.file_verdicts(spark, path, schema, fmt), f"files-{source}")
    unfit = verdicts.where("reason IS NOT NULL")
    if unfit.isEmpty():
        return landing.read_landing(spark, path, schema, fmt), None
    fit = [r["file"] for r in verdicts.where("reason IS NULL").select("file").collect()]
    rows = landing.read_landing(spark, fit, schema, fmt, base_path=path) if fit else None
    return rows, unfit.select(F.lit(source).alias("source"), "file", "rows", "reason", F.lit("rejected").alias("status"))


def _normalize(landed: DataFrame, source: str, types: Sequence[str] | None) -> DataFrame:
    if source == "load":
        return I.normalize_load(landed)
    if source == "price":
        return I.normalize_price(landed)
    return I.normalize_generation_wide(landed, types) if types else I.normalize_generation_two_level(landed)


def _absent(spark: SparkSession, landed: DataFrame | None, source: str, run_date: str, lag_days: int,
            zones: str) -> DataFrame:
    """The zones of the run's market day that landed nothing."""
    day = spark.range(1).select(grid.run_days(run_date, lag_days).alias("market_day"))
    expected = grid.job_grid(day, [source], zones)
    if landed is None:
        return expected
    return null_safe_join(expected, landed.select("zone_code", "market_day"), ["zone_code", "market_day"], "left_anti")


def ingest_landing(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    ledger_path: str,
    formats: dict[str, str] | None = None,
    generation_types: Sequence[str] | None = None,
    ingested_at: datetime | None = None,
    mode: str = "batch",
    run_date: str | None = None,
    lag_days: int = 1,
    zones: str | None = None,
    sources: Sequence[str] = tuple(SOURCES),
    job_id: str | None = None,
) -> DataFrame:
    """Ingest ``<landing_root>/{load,generation,price}`` -> bronze + ledger.

    ``formats`` maps source -> parquet / json / csv (default parquet).
    Generation is read in the two-level form (name, measure, value) unless
    ``generation_types`` lists the columns of a wide file.

    With ``run_date`` only the market day that this run is due for
    (``lag_days`` before) is read; the predicate prunes a landing root that is
    partitioned by ``market_day``. Lines whose day cannot be read are kept, and
    rejected. ``zones`` (comma text) restricts the run and, with ``run_date``,
    makes every zone without landed rows a failure. Only this call's batches
    are summarised; ``job_id`` names its folder in the ledger.

    Every landed file is compared with the declared schema first. One that lacks a
    column, has a column of another type or holds a torn line is left out whole
    and ledgered under its own name, whatever days it holds.
    """
    formats = formats or {}
    job_id = job_id or uuid.uuid4().hex
    for source in sources:
        path = os.path.join(landing_root, source)
        with session.Scratch(spark) as scratch:
            landed, outcomes = None, []
            if bronze.path_exists(spark, path, landing.LANDING_LOAD):
                landed, unfit = _read_sound(spark, path, source, formats.get(source, "parquet"), generation_types, scratch)
                if unfit is not None:
                    outcomes.append(unfit)
            if landed is not None and run_date is not None:
                due = F.col("market_day") == grid.run_days(run_date, lag_days)
                landed = landed.filter(F.col("market_day").isNull() | due)
            if landed is not None and zones is not None:
                landed = landed.filter(F.col("zone_code").isNull()
                                       | F.array_contains(csv_list(F.lit(zones)), F.col("zone_code")))
            if run_date is not None and zones is not None:
                outcomes.append(_absent(spark, landed, source, run_date, lag_days, zones))
            if landed is not None and source == "price":
                outcomes.append(I.price_batches_lost(landed))
            missing = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outcomes) if outcomes else None
            if landed is not None:
                prepared = I.prepare(_normalize(landed, source, generation_types), source, scratch)
                I.ingest(spark, prepared, source, bronze_root, ledger_path, ingested_at, mode, missing, job_id)
            elif missing is not None:
                nothing = spark.createDataFrame([], I.LEDGER_SCHEMA).withColumn("passed", F.lit(True))
                I.write_ledger(contracts.ledger(nothing, missing), ledger_path, job_id)
    return contracts.summary(I.read_ledger(spark, ledger_path, job_id))


class StaleSourceError(RuntimeError):
    """Source freshness is ``error``: the build does not start."""


def check_freshness(spark: SparkSession, bronze_root: str, now: datetime) -> DataFrame:
    """Freshness of the three bronze feeds at ``now`` (scans only the last 30 days)."""
    since = now - timedelta(days=checks.FRESHNESS_LOOKBACK_DAYS)
    feeds = {name: bronze.read_bronze(spark, bronze_root, spec, since) for name, spec in SOURCES.items()}
    return checks.freshness(feeds, [now])


def build_mart(
    spark: SparkSession,
    bronze_root: str,
    mart_path: str,
    start: str = MIN_TS,
    freshness_now: datetime | None = None,
    seed_path: str | None = None,
) -> DataFrame:
    """Full rebuild from bronze, published through the 14 checks.

    The whole mart is replaced, so a month without rows left is gone; a rebuild
    without any row is refused. ``seed_path`` names a CSV seed of the
    production-type dimension to use in place of the inline rows.

    With ``freshness_now``, source freshness runs first and a feed in
    ``error`` stops the build before anything is computed (``warn`` goes on).
    """
    if freshness_now is not None:
        stale = [
            r["source"]
            for r in check_freshness(spark, bronze_root, freshness_now).filter("status = 'error'").collect()
        ]
        if stale:
            raise StaleSourceError(f"sources too old to build from: {stale}")
    feeds = {name: bronze.read_bronze(spark, bronze_root, spec, start) for name, spec in SOURCES.items()}
    types = dims.read_production_type_seed(spark, seed_path) if seed_path else None
    fct = fct_from_bronze(spark, feeds["load"], feeds["generation"], feeds["price"], with_month=True,
                          production_types=types)
    return publish_fct(spark, fct, mart_path)

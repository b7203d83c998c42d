"""Bulk ingest: landed files for many (source, zone, market day) batches in one job.

landed rows -> normalise (UTC, header flatten, melt, first series, end
boundary) -> resolution per batch -> contract flags -> per-batch verdicts ->
append accepted batches to bronze -> record every batch in the ledger.

Two tables are staged and deleted at the end: the normalised rows (once) and
one row per batch (its resolution, its verdict), which Spark broadcasts when it
measures them small. The ledger is written after the append, so "loaded" is
never recorded for rows that are not there.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart import session
from gridmart.functions.time import market_window_end, parse_instant
from gridmart.operators import contracts, reshape, resolution, series
from gridmart.operators.keys import null_safe_join
from gridmart.sources import bronze
from gridmart.specs import SOURCES, SourceSpec

BATCH_IN = ("zone_code", "market_day", "run_id")


def _utc(ts_col: str = "ts") -> Column:
    """Landed stamp (ISO text, or a timestamp already) -> UTC instant."""
    return parse_instant(F.col(ts_col).cast("string"))


def normalize_load(landed: DataFrame, value_cols: Sequence[str] | None = None) -> DataFrame:
    """(batch, ts, value...) -> (batch, ts_utc, load_mw); the first value column wins."""
    values = list(value_cols) if value_cols else [c for c in landed.columns if c not in (*BATCH_IN, "ts")]
    if not values:
        raise contracts.ContractError("load landing has no value column")
    return landed.select(*BATCH_IN, _utc().alias("ts_utc"), F.col(values[0]).alias("load_mw"))


def normalize_generation_wide(landed: DataFrame, type_cols: Sequence[str]) -> DataFrame:
    """Wide frame, one column per (flattened) type -> long rows, nulls kept."""
    flat = landed.select(*BATCH_IN, _utc().alias("ts_utc"), *type_cols)
    return reshape.melt(flat, [*BATCH_IN, "ts_utc"], type_cols, "production_type", "generation_mw")


def normalize_generation_two_level(landed: DataFrame) -> DataFrame:
    """(batch, ts, name, measure, value) -> long rows with flattened type names."""
    return landed.select(
        *BATCH_IN,
        _utc().alias("ts_utc"),
        reshape.flatten_header(F.col("name"), F.col("measure")).alias("production_type"),
        F.col("value").alias("generation_mw"),
    )


def normalize_price(landed: DataFrame) -> DataFrame:
    """Pick the preferred published series per batch, drop the window-end stamp."""
    rows = landed.select(
        *BATCH_IN, _utc().alias("ts_utc"), "price_eur_mwh", "series_resolution"
    )
    picked = series.first_available_series(rows, list(BATCH_IN))
    bounded = picked.withColumn("_end", market_window_end("market_day"))
    return series.drop_end_boundary(bounded, "_end").drop("_end", "series_resolution")


def price_batches_lost(landed: DataFrame) -> DataFrame:
    """Landed price batches that ``normalize_price`` leaves without rows, for the ledger.

    Without a known series a batch is ``missing``; with nothing before the window
    end in the picked series it is ``empty``, which is no failure.
    """
    rows = landed.select(*BATCH_IN, _utc().alias("ts_utc"), "series_resolution")
    rows = rows.withColumn("_end", market_window_end("market_day"))
    lost = series.batches_emptied(rows, list(BATCH_IN), "_end")
    reason = F.when(F.col("has_series"), F.lit("no price before the window end")).otherwise(F.lit("no price series"))
    status = F.when(F.col("has_series"), F.lit("empty")).otherwise(F.lit("missing"))
    return lost.withColumns({"source": F.lit("price"), "reason": reason, "status": status}).drop("has_series")


def prepare(normalized: DataFrame, source: str, scratch: session.Scratch | None = None) -> DataFrame:
    """Attach source and per-batch resolution (the most common stamp gap).

    With ``scratch`` the normalised rows and the per-batch table are staged:
    resolution detection joins the rows with an aggregate of themselves, and
    without the cut every such join would repeat the whole landing plan.
    """
    rows = normalized.withColumn("source", F.lit(source))
    if scratch is None:
        return resolution.with_resolution(rows, list(contracts.BATCH))
    rows = scratch.stage(rows, f"normalized-{source}")
    found = scratch.stage(resolution.detect_resolution(rows, list(contracts.BATCH)), f"resolution-{source}")
    return null_safe_join(rows, found, contracts.BATCH)


LEDGER_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("zone_code", T.StringType()),
    T.StructField("market_day", T.DateType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("rows_loaded", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("digest", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
    T.StructField("file", T.StringType()),
])


def write_ledger(ledger: DataFrame, ledger_path: str, job_id: str, ingested_at: datetime | None = None) -> None:
    """Append a job's rows; ``job_id=...`` folders keep the jobs apart."""
    at = F.lit(None if ingested_at is None else bronze.instant_text(ingested_at)).cast("timestamp")
    for name in ("digest", "file"):
        if name not in ledger.columns:
            ledger = ledger.withColumn(name, F.lit(None).cast("string"))
    (ledger.withColumn("ingested_at", at).select(*LEDGER_SCHEMA.fieldNames()).withColumn("job_id", F.lit(job_id))
     .write.mode("append").partitionBy("job_id").parquet(ledger_path))


def read_ledger(spark: SparkSession, ledger_path: str, job_id: str | None = None) -> DataFrame:
    """The rows of one job (only its folder is listed) or of all; nothing is inferred."""
    path = ledger_path if job_id is None else f"{ledger_path}/job_id={job_id}"
    if not bronze.path_exists(spark, path, LEDGER_SCHEMA):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def ingest(
    spark: SparkSession,
    prepared: DataFrame,
    source: str,
    bronze_root: str,
    ledger_path: str,
    ingested_at: datetime | None = None,
    mode: str = "batch",
    missing: DataFrame | None = None,
    job_id: str | None = None,
) -> int:
    """Validate all batches, append the accepted ones, record the ledger.

    Returns the number of bronze rows written. ``ingested_at`` is one
    driver-side instant for the whole write (default: now, UTC). ``missing``
    are batches that left no rows (see ``contracts.ledger``).

    A batch whose rows are those that it loaded last (by the digest in the ledger) is
    not appended again and is ledgered as replayed. The ledger is written after the
    append: a run that dies in between appends again when it is repeated, as one more
    revision of the same values, which the resolution of revisions absorbs.
    """
    spec: SourceSpec = SOURCES[source]
    at = ingested_at or datetime.now(UTC)
    flagged = contracts.flag_rows(prepared, spec.contract)
    with session.Scratch(spark) as scratch:
        found = contracts.verdicts(flagged, spec.contract, digest=True)
        loaded = read_ledger(spark, ledger_path).where((F.col("source") == source) & (F.col("status") == "loaded"))
        verdict = scratch.stage(contracts.mark_replays(found, loaded), f"verdict-{source}")
        again = verdict.where("replayed").select(*contracts.BATCH)
        fresh = flagged if again.isEmpty() else null_safe_join(flagged, again, contracts.BATCH, "left_anti")
        accepted = contracts.valid_rows(fresh, verdict, spec.contract, mode=mode)
        written = bronze.write_bronze(accepted, bronze_root, spec, ingested_at=at)
        write_ledger(contracts.ledger(verdict, missing), ledger_path, job_id or uuid.uuid4().hex, at)
    return written

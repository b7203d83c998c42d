"""Recompute only the zone-hours that received new bronze data.

A Structured Streaming query over the three bronze tables (file source,
``trigger(availableNow=True)``) sees each newly appended file once. Per
micro-batch, ``foreachBatch`` writes the distinct (zone, UTC hour) keys of the new
rows. For the months they lie in, bronze is semi-joined with the keys, so only
all revisions of the touched hours are ranked, conformed and joined; the untouched
rows of the month are carried over from the published mart by an anti join. A month
that the mart does not have yet is built whole. The result is published through
the gate as one version; a month with no rows left is gone. An hour's
fact depends on no other hour, so the result equals a full rebuild.

No watermark: late revisions of any age must still be applied, and no state
is kept beyond the file-source log in the checkpoint. Replaying a batch
recomputes the same hours from bronze, so a retried epoch is idempotent.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import session
from gridmart.functions.time import hour_floor
from gridmart.plans.fact import KEYS, fct_from_bronze
from gridmart.plans.publish import publish_fct
from gridmart.sources import bronze, mart
from gridmart.specs import SOURCES


@dataclass(frozen=True)
class Refreshed:
    """What one micro-batch did: months, touched zone-hours, rows computed anew and carried over."""

    months: list[date]
    keys: int
    computed: int
    carried: int


def touched_keys(batch: DataFrame) -> DataFrame:
    """Distinct (zone, UTC hour, month) of a micro-batch."""
    return batch.select("zone_code", hour_floor("ts_utc").alias("ts_hour_utc"), "ts_month").distinct()


def rebuild(spark: SparkSession, bronze_root: str, months: list[date], keys: DataFrame | None = None) -> DataFrame:
    """The fact of the listed months, or of the listed zone-hours in them.

    The semi join comes before the ranking of revisions, so untouched hours are
    scanned and dropped, not shuffled (a side is broadcast only when measured small).
    """
    feeds = {}
    for name, spec in SOURCES.items():
        rows = bronze.read_bronze_months(spark, bronze_root, spec, months)
        if keys is not None:
            wanted = keys.select(F.col("zone_code").alias("_zone"), F.col("ts_hour_utc").alias("_hour"))
            same = (F.col("zone_code") == F.col("_zone")) & (hour_floor("ts_utc") == F.col("_hour"))
            rows = rows.join(wanted, same, "left_semi")
        feeds[name] = rows
    return fct_from_bronze(spark, feeds["load"], feeds["generation"], feeds["price"], with_month=True)


def refresh_keys(spark: SparkSession, bronze_root: str, mart_path: str, keys: DataFrame) -> Refreshed:
    """Publish the mart with the stored ``keys`` (see ``touched_keys``) computed anew from bronze."""
    months = sorted(r["ts_month"] for r in keys.select("ts_month").distinct().collect())  # bounded by the calendar
    known = mart.published(spark, mart_path)
    old = [m for m in months if m.isoformat() in known]
    new = [m for m in months if m.isoformat() not in known]
    fact = None
    if new:
        fact = rebuild(spark, bronze_root, new)
    if old:
        part = rebuild(spark, bronze_root, old, keys.filter(F.col("ts_month").isin(*old)))
        kept = mart.read_months(spark, mart_path, {m.isoformat(): known[m.isoformat()] for m in old})
        part = part.unionByName(kept.join(keys.select(*KEYS), KEYS, "left_anti"))
        fact = part if fact is None else fact.unionByName(part)
    publish_fct(spark, fact, mart_path, months)
    done = mart.published(spark, mart_path)
    done = mart.read_months(spark, mart_path, {m: v for m, v in done.items() if date.fromisoformat(m) in months})
    rows, computed = done.count(), done.join(keys.select(*KEYS), KEYS, "left_semi").count()
    return Refreshed(months, keys.count(), computed, rows - computed)


def refresh(
    spark: SparkSession,
    bronze_root: str,
    mart_path: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> list[date]:
    """Run one availableNow refresh; returns the months that got new rows."""
    reports = refresh_reports(spark, bronze_root, mart_path, checkpoint, max_files_per_trigger)
    return sorted({m for r in reports for m in r.months})


def refresh_reports(
    spark: SparkSession,
    bronze_root: str,
    mart_path: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> list[Refreshed]:
    """Run one availableNow refresh; returns what every micro-batch did.

    If the gate rejects a rebuild, the micro-batch fails before its commit:
    nothing is published, and the next refresh re-reads the same files
    (plus any correcting revisions appended since).
    """
    streams = []
    for spec in SOURCES.values():
        # The checkpoint records its sources, so all three must exist from the
        # first refresh on, even before a feed's first append.
        bronze.ensure_table(spark, bronze_root, spec)
        reader = spark.readStream.schema(bronze.stored_schema(spec))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        stream = reader.parquet(bronze.table_path(bronze_root, spec))
        streams.append(stream.select("zone_code", "ts_utc", "ts_month"))
    changes = streams[0]
    for s in streams[1:]:
        changes = changes.unionByName(s)
    reports: list[Refreshed] = []

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        with session.Scratch(spark) as scratch:
            found = touched_keys(batch)
            path = scratch.path("touched-keys")
            found.write.parquet(path)
            # From here on ordinary batch jobs over stored tables, in the caller's
            # session (micro-batch sessions run with AQE switched off).
            keys = spark.read.schema(found.schema).parquet(path)
            if not keys.isEmpty():
                reports.append(refresh_keys(spark, bronze_root, mart_path, keys))

    query = (
        changes.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return reports

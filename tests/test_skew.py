"""A key, batch or group of copies holding a large share of all rows.

The plans must reduce such groups on the map side, before any shuffle, so
that no task receives the whole group.
"""

from metrics import exchanges
from pyspark.sql import functions as F

from gridmart.operators import contracts, conform
from gridmart.specs import LOAD_CONTRACT

HOT, NORMAL, MAPS = 200_000, 2_000, 8


def _bronze(spark):
    """HOT revisions of one interval plus NORMAL intervals with one revision each."""
    ids = spark.range(HOT + NORMAL, numPartitions=MAPS)
    hot = F.col("id") < HOT
    slot = F.when(hot, F.lit(0)).otherwise(F.col("id") - HOT + 1)
    return ids.select(
        # Not a literal, so the optimizer cannot fold the key away.
        F.when(F.col("id") >= 0, F.lit("DE_LU")).alias("zone_code"),
        (F.lit("2026-08-01 00:00:00").cast("timestamp") + F.make_interval(mins=(slot * 15).cast("int"))).alias("ts_utc"),
        F.lit(15).cast("bigint").alias("resolution_minutes"),
        (F.col("id") * 1.0).alias("load_mw"),
        (F.lit("2026-09-01 00:00:00").cast("timestamp") + F.make_interval(secs=F.col("id").cast("decimal(18,6)"))).alias("ingested_at"),
        F.col("id").cast("string").alias("run_id"),
    )


def test_hot_revision_key_ships_one_row_per_map_task(spark):
    stg = conform.stg_load(_bronze(spark))
    rows = stg.collect()
    first = [r for r in rows if str(r["ts_hour_utc"]) == "2026-08-01 00:00:00"][0]
    # Newest revision of the hot 00:00 slot wins; 00:15, 00:30, 00:45 are normal keys.
    assert first["intervals_aggregated"] == 4
    assert first["load_mw"] == (HOT - 1 + HOT + HOT + 1 + HOT + 2) / 4
    shipped = exchanges(stg)
    revision_shuffle = shipped[-1]  # the deepest exchange: right after the scan
    assert revision_shuffle[0] == "WindowGroupLimit"
    assert revision_shuffle[1] <= NORMAL + MAPS, shipped


def test_hot_batch_is_combined_before_the_shuffle(spark):
    b = _bronze(spark).select(
        F.lit("load").alias("source"), "zone_code", F.lit("2026-08-01").cast("date").alias("market_day"),
        F.lit("run-1").alias("run_id"), "ts_utc", "load_mw", "resolution_minutes",
    )
    flagged = contracts.flag_rows(b, LOAD_CONTRACT)
    counts = flagged.groupBy(*contracts.BATCH).agg(F.count(F.lit(1)).alias("rows"))
    [row] = counts.collect()
    assert row["rows"] == HOT + NORMAL
    [(_, written)] = exchanges(counts)
    assert written <= MAPS  # one partial aggregate per map task


def test_verdicts_of_a_hot_batch_with_a_hot_duplicate_key(spark):
    b = _bronze(spark).select(
        F.lit("load").alias("source"), "zone_code", F.lit("2026-08-01").cast("date").alias("market_day"),
        F.when(F.col("run_id") >= "", F.lit("run-1")).alias("run_id"), "ts_utc", "load_mw", "resolution_minutes",
    )
    v = contracts.verdicts(contracts.flag_rows(b, LOAD_CONTRACT), LOAD_CONTRACT)
    [row] = v.collect()
    assert row["rows"] == HOT + NORMAL and row["duplicate_keys"] == 1 and not row["passed"]
    per_key, per_batch = exchanges(v)[-1], exchanges(v)[0]
    assert per_key[1] <= NORMAL + MAPS  # the 200k copies of one key arrive as one row per map task
    assert per_batch[1] <= MAPS

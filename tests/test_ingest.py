"""Landed files -> normalise -> contracts -> bronze + ledger, end to end."""

import csv
import json
import os

from pyspark.sql import functions as F

from gridmart import dims, session
from gridmart.operators import contracts
from gridmart.plans import ingest as I
from gridmart.sources import bronze, landing
from gridmart.specs import SOURCES


def _write_csv(path, header, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


def test_load_files_to_bronze_with_batch_verdicts(spark):
    base = session.fresh_path(spark, "t-landing")
    day = "2026-08-01"
    good = [("DE_LU", day, "run-a", f"2026-08-01T{h:02d}:00:00+02:00", 50_000.0 + h) for h in range(24)]
    bad = [("AT", day, "run-b", f"2026-08-01T{h:02d}:00:00+02:00", 7_000.0) for h in range(23)]
    bad.append(("AT", day, "run-b", "2026-08-01T23:00:00+02:00", 900_000.0))  # one implausible value
    _write_csv(f"{base}/load", ["zone_code", "market_day", "run_id", "ts", "load_mw"], good + bad)
    landed = landing.read_landing(spark, f"{base}/load", landing.LANDING_LOAD, fmt="csv")
    prepared = I.prepare(I.normalize_load(landed), "load")
    assert {r["resolution_minutes"] for r in prepared.collect()} == {60}
    root, ledger = f"{base}/bronze", f"{base}/ledger"
    assert I.ingest(spark, prepared, "load", root, ledger) == 24
    back = bronze.read_bronze(spark, root, SOURCES["load"], start="2026-07-01")
    assert {r["zone_code"] for r in back.collect()} == {"DE_LU"}
    # 02:00 local (+02:00) is 00:00 UTC.
    assert str(back.agg(F.min("ts_utc")).first()[0]) == "2026-07-31 22:00:00"
    rows = {r["run_id"]: r for r in spark.read.parquet(ledger).collect()}
    assert rows["run-a"]["status"] == "loaded" and rows["run-b"]["status"] == "rejected"
    assert rows["run-b"]["reason"] == "out_of_range"


def test_generation_two_level_and_wide_forms_agree(spark):
    base = session.fresh_path(spark, "t-landing")
    day = "2026-08-01"
    two = []
    for q in range(4):
        ts = f"2026-08-01T10:{15 * q:02d}:00+00:00"
        two += [
            ("DK_1", day, "r", ts, "Hydro Pumped Storage", "Actual Aggregated", 10.0 + q),
            ("DK_1", day, "r", ts, "Hydro Pumped Storage", "Actual Consumption", 3.0),
            ("DK_1", day, "r", ts, "Wind Onshore", "Actual Aggregated", None),
        ]
    os.makedirs(f"{base}/gen2", exist_ok=True)
    with open(f"{base}/gen2/part-0.json", "w") as fh:
        for z, d, r, ts, n, m, v in two:
            fh.write(json.dumps(dict(zone_code=z, market_day=d, run_id=r, ts=ts, name=n, measure=m, value=v)) + "\n")
    long2 = I.normalize_generation_two_level(
        landing.read_landing(spark, f"{base}/gen2", landing.LANDING_GENERATION_TWO_LEVEL, fmt="json")
    )
    cols = ["Hydro Pumped Storage", "Hydro Pumped Storage Consumption", "Wind Onshore"]
    wide_rows = [("DK_1", day, "r", f"2026-08-01T10:{15 * q:02d}:00+00:00", 10.0 + q, 3.0, None) for q in range(4)]
    from pyspark.sql import types as T

    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name == "market_day" else f.dataType)
        for f in landing.landing_generation_wide(cols).fields
    ])
    wide = spark.createDataFrame(wide_rows, text_schema).withColumn("market_day", F.to_date("market_day"))
    longw = I.normalize_generation_wide(wide, cols)
    key = ["ts_utc", "production_type"]
    # Text formats keep measures as text until the contract coerces them.
    long2 = long2.withColumn("generation_mw", F.col("generation_mw").cast("double"))
    a = [r.asDict() for r in long2.orderBy(*key).collect()]
    b = [r.asDict() for r in longw.select(*long2.columns).orderBy(*key).collect()]
    assert a == b and len(a) == 12
    prepared = I.prepare(long2, "generation")
    assert {r["resolution_minutes"] for r in prepared.collect()} == {15}


def test_price_prefers_quarter_hours_and_drops_window_end(spark):
    day = "2026-08-01"  # Berlin summer time: window is 07-31 22:00 .. 08-01 22:00 UTC
    rows = [("NL", day, "r", f"2026-08-01T{h:02d}:00:00+00:00", 40.0, "60min") for h in range(22)]
    rows.append(("NL", day, "r", "2026-08-01T22:00:00+00:00", 41.0, "60min"))  # window end, dropped
    rows.append(("FR", day, "r", "2026-08-01T10:00:00+00:00", 10.0, "60min"))
    rows.append(("FR", day, "r", "2026-08-01T10:15:00+00:00", 11.0, "15min"))
    df = spark.createDataFrame(rows, "zone_code string, market_day string, run_id string, ts string, price_eur_mwh double, series_resolution string").withColumn("market_day", F.to_date("market_day"))
    out = I.normalize_price(df)
    by_zone = {}
    for r in out.collect():
        by_zone.setdefault(r["zone_code"], []).append(r["price_eur_mwh"])
    assert len(by_zone["NL"]) == 22 and 41.0 not in by_zone["NL"]
    assert by_zone["FR"] == [11.0]


def test_seed_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "dim_production_type.csv")
    dims.write_production_type_seed(spark, path)
    seed = dims.read_production_type_seed(spark, path)
    assert seed.count() == 36
    assert sorted(map(tuple, seed.collect())) == sorted(map(tuple, dims.dim_production_type(spark).collect()))


def test_malformed_number_in_a_text_file_rejects_its_batch(spark):
    base = session.fresh_path(spark, "t-landing")
    rows = [("NL", "2026-08-01", "ok", f"2026-08-01T{h:02d}:00:00+00:00", "100.5") for h in range(3)]
    rows += [("NL", "2026-08-01", "bad", f"2026-08-01T{h:02d}:00:00+00:00", v) for h, v in [(0, "7"), (1, "12,5")]]
    _write_csv(f"{base}/load", ["zone_code", "market_day", "run_id", "ts", "load_mw"], rows)
    landed = landing.read_landing(spark, f"{base}/load", landing.LANDING_LOAD, fmt="csv")
    prepared = I.prepare(I.normalize_load(landed), "load")
    assert I.ingest(spark, prepared, "load", f"{base}/bronze", f"{base}/ledger") == 3
    ledger = {r["run_id"]: r for r in spark.read.parquet(f"{base}/ledger").collect()}
    assert ledger["ok"]["status"] == "loaded" and ledger["bad"]["reason"] == "bad_type"


LOAD_HEADER = ["zone_code", "market_day", "run_id", "ts", "load_mw"]


def test_no_batch_vanishes_and_no_rejected_row_is_written(spark):
    base = session.fresh_path(spark, "t-landing")
    day = "2026-08-01"
    stamps = [f"{day}T{h:02d}:00:00+00:00" for h in range(4)]
    rows = [("NL", day, "fine", t, "5.0") for t in stamps]
    rows += [("NL", day, "no-time", "soon", "5.0") for _ in stamps]
    rows += [("", day, "no-zone", t, "5.0") for t in stamps]
    rows += [("NL", day, "", t, "5.0") for t in stamps]
    rows += [("NL", "someday", "no-day", t, "5.0") for t in stamps]
    _write_csv(f"{base}/load", LOAD_HEADER, rows)
    with open(f"{base}/load/part-1.csv", "w") as fh:
        fh.write(",".join(LOAD_HEADER) + "\nbroken line\n")
    landed = landing.read_landing(spark, f"{base}/load", landing.LANDING_LOAD, fmt="csv")
    with session.Scratch(spark) as scratch:
        prepared = I.prepare(I.normalize_load(landed), "load", scratch)
        assert I.ingest(spark, prepared, "load", f"{base}/bronze", f"{base}/ledger", job_id="j") == 4
    ledger = I.read_ledger(spark, f"{base}/ledger", "j").collect()
    assert sum(r["rows"] for r in ledger) == len(rows) + 1 and len(ledger) == 6
    assert [r["run_id"] for r in ledger if r["status"] == "loaded"] == ["fine"]
    assert all("null_required" in r["reason"] for r in ledger if r["status"] == "rejected")
    back = bronze.read_bronze(spark, f"{base}/bronze", SOURCES["load"], start="2026-07-01")
    assert {r["run_id"] for r in back.collect()} == {"fine"}


def test_price_rows_with_junk_stamps_or_no_series_fail_their_batch(spark):
    day = "2026-08-01"
    rows = [("NL", day, "junk", f"{day}T{h:02d}:00:00+00:00", 1.0, "60min") for h in range(3)]
    rows += [("NL", day, "junk", "half past", 1.0, "60min"), ("AT", day, "odd", f"{day}T01:00:00+00:00", 1.0, "30min")]
    df = spark.createDataFrame(
        rows, "zone_code string, market_day string, run_id string, ts string, price_eur_mwh double, "
        "series_resolution string").withColumn("market_day", F.to_date("market_day"))
    base = session.fresh_path(spark, "t-price")
    prepared = I.prepare(I.normalize_price(df), "price")
    n = I.ingest(spark, prepared, "price", f"{base}/b", f"{base}/l", missing=I.price_batches_lost(df), job_id="j")
    got = {r["run_id"]: (r["status"], r["rows"], r["reason"]) for r in I.read_ledger(spark, f"{base}/l", "j").collect()}
    assert n == 0
    assert got == {"junk": ("rejected", 4, "null_required"), "odd": ("missing", 1, "no price series")}


def test_price_batch_of_the_window_end_alone_is_ledgered(spark):
    day, end = "2026-08-01", "2026-08-01T22:00:00+00:00"  # the Berlin day ends at 22:00 UTC
    rows = [("NL", day, "end", end, 1.0, "60min"), ("NL", day, "end", end, 2.0, "60min"),
            # The quarter-hourly end stamp wins the choice over the hourly rows of the day.
            ("NL", day, "mixed", end, 1.0, "15min"), ("NL", day, "mixed", f"{day}T01:00:00+00:00", 1.0, "60min"),
            ("NL", day, "mixed", f"{day}T02:00:00+00:00", 1.0, "60min"), (None, day, None, end, 1.0, "15min"),
            ("NL", day, "both", end, 1.0, "60min"), ("NL", day, "both", f"{day}T01:00:00+00:00", 1.0, "15min"),
            ("NL", day, "both", f"{day}T01:15:00+00:00", 1.0, "15min"),
            ("NL", None, "no-day", end, 1.0, "60min"), ("AT", day, "odd", end, 1.0, "30min")]
    df = spark.createDataFrame(
        rows, "zone_code string, market_day string, run_id string, ts string, price_eur_mwh double, "
        "series_resolution string").withColumn("market_day", F.to_date("market_day"))
    base = session.fresh_path(spark, "t-price")
    prepared = I.prepare(I.normalize_price(df), "price")
    n = I.ingest(spark, prepared, "price", f"{base}/b", f"{base}/l", missing=I.price_batches_lost(df), job_id="j")
    ledger = I.read_ledger(spark, f"{base}/l", "j").collect()
    got = {r["run_id"]: (r["status"], r["rows"], r["reason"]) for r in ledger}
    gone = "no price before the window end"
    assert n == 2 and len(ledger) == len(got)
    assert got.pop("no-day")[:2] == ("rejected", 1)
    assert got == {"end": ("empty", 2, gone), "mixed": ("empty", 3, gone), None: ("empty", 1, gone),
                   "both": ("loaded", 2, None), "odd": ("missing", 1, "no price series")}
    total = contracts.summary(I.read_ledger(spark, f"{base}/l", "j")).first()
    assert (total["batches"], total["failures"]) == (6, 2)  # no day, no series; empty batches are no failures


def test_intermediate_tables_are_deleted(spark):
    import glob

    root = session.shared_root(spark)
    before = set(glob.glob(f"{root}/stage-*"))
    base = session.fresh_path(spark, "t-scratch")
    rows = [("NL", "2026-08-01", "r", f"2026-08-01T{h:02d}:00:00+00:00", "5.0") for h in range(3)]
    _write_csv(f"{base}/load", LOAD_HEADER, rows)
    landed = landing.read_landing(spark, f"{base}/load", landing.LANDING_LOAD, fmt="csv")
    with session.Scratch(spark) as scratch:
        prepared = I.prepare(I.normalize_load(landed), "load", scratch)
        I.ingest(spark, prepared, "load", f"{base}/bronze", f"{base}/ledger")
    assert set(glob.glob(f"{root}/stage-*")) == before

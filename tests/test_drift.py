"""Landed files against their schema: one verdict a file, and what the ingest job does with it."""

import json
import os
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from gridmart import session
from gridmart.plans import ingest as I
from gridmart.plans import jobs
from gridmart.sources import drift, landing

HEADER = "zone_code,market_day,run_id,ts,load_mw"
LINE = "AT,2026-08-01,r,2026-08-01T00:00:00+00:00,1.0"


@pytest.fixture
def folder(spark):
    path = session.fresh_path(spark, "t-drift")
    os.makedirs(path)
    return path


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w" if isinstance(text, str) else "wb") as f:
        f.write(text)


def found(spark, folder, schema, fmt):
    rows = drift.file_verdicts(spark, folder, schema, fmt).collect()
    return {os.path.relpath(r["file"].removeprefix("file:").replace("//", "/"), folder): (r["rows"], r["reason"]) for r in rows}


def test_csv_files(spark, folder):
    put(f"{folder}/good.csv", f"{HEADER}\n{LINE}\n{LINE}\n")
    put(f"{folder}/crlf.csv", f"{HEADER}\r\n{LINE}\r\n")
    put(f"{folder}/odd-values.csv", f"{HEADER}\n,never,,no time,many\n")  # for the contract, not for the file
    put(f"{folder}/torn.csv", f"{HEADER}\n{LINE}\nAT,2026-08-0\n")
    put(f"{folder}/swapped.csv", f"market_day,zone_code,run_id,ts,load_mw\n{LINE}\n")
    put(f"{folder}/short.csv", "zone_code,market_day,run_id,ts\nAT,2026-08-01,r,x\n")
    put(f"{folder}/long.csv", f"{HEADER},note\n{LINE},hi\n")
    put(f"{folder}-days/market_day=2026-08-02/part.csv", "zone_code,run_id,ts,load_mw\nAT,r,2026-08-02T00:00:00+00:00,1.0\n")
    put(f"{folder}-days/market_day=2026-08-03/part.csv", "zone_code,run_id,ts,load_mw\nAT,r,2026-08-02T00:00:00+00:00\n")
    assert found(spark, folder, landing.LANDING_LOAD, "csv") == {
        "good.csv": (2, None), "crlf.csv": (1, None), "odd-values.csv": (1, None), "torn.csv": (2, "torn lines: 1"),
        "swapped.csv": (1, "columns in another order"), "short.csv": (1, "missing column: load_mw"),
        "long.csv": (1, "undeclared column: note")}
    assert found(spark, f"{folder}-days", landing.LANDING_LOAD, "csv") == {
        "market_day=2026-08-02/part.csv": (1, None), "market_day=2026-08-03/part.csv": (1, "torn lines: 1")}


def test_json_files(spark, folder):
    row = dict(zone_code="AT", market_day="2026-08-01", run_id="r", ts="2026-08-01T00:00:00+00:00", load_mw=1.0)
    put(f"{folder}/good.json", json.dumps(row) + "\n" + json.dumps(row | {"extra": [1]}) + "\n\n")
    put(f"{folder}/null-measure.json", json.dumps({k: v for k, v in row.items() if k != "load_mw"}))
    put(f"{folder}/no-zone.json", json.dumps({k: v for k, v in row.items() if k != "zone_code"}))
    put(f"{folder}/torn.json", json.dumps(row) + "\n" + json.dumps(row)[:30] + "\n" + json.dumps(row)[9:])
    assert found(spark, folder, landing.LANDING_LOAD, "json") == {
        "good.json": (2, None), "null-measure.json": (1, None), "no-zone.json": (1, "missing column: zone_code"),
        "torn.json": (3, "torn lines: 2")}


def test_parquet_files(spark, folder):
    def table(**types):
        kinds = dict(zone_code=pa.string(), market_day=pa.date32(), run_id=pa.string(), ts=pa.string(), load_mw=pa.float64()) | types
        return pa.table({k: pa.array([None] * 3, t) for k, t in kinds.items() if t is not None})

    for name, t in {"good": table(), "more": table(note=pa.int32()), "single": table(load_mw=pa.float32()),
                    "whole": table(load_mw=pa.int64()), "text-day": table(market_day=pa.string()),
                    "two": table(ts=None, run_id=pa.int32())}.items():
        pq.write_table(t, f"{folder}/{name}.parquet")
    put(f"{folder}/junk.parquet", b"not at all a parquet file PAR1")
    put(f"{folder}/tiny.parquet", b"x")
    with open(f"{folder}/good.parquet", "rb") as f:
        put(f"{folder}/cut.parquet", f.read()[:-20])
    assert found(spark, folder, landing.LANDING_LOAD, "parquet") == {
        "good.parquet": (3, None), "more.parquet": (3, None), "single.parquet": (3, None),
        "whole.parquet": (3, "wrong type: load_mw is int64"), "text-day.parquet": (3, "wrong type: market_day is string"),
        "two.parquet": (3, "wrong type: run_id is int32; missing column: ts"),
        "junk.parquet": (0, "no Parquet file"), "tiny.parquet": (0, "no Parquet file"), "cut.parquet": (0, "no Parquet file")}


def test_the_job_leaves_unfit_files_out_and_names_them(spark, folder):
    put(f"{folder}/landing/load/good.csv", f"{HEADER}\n{LINE}\n")
    put(f"{folder}/landing/load/torn.csv", f"{HEADER}\nNL,2026-08-01,r,2026-08-01T00:00:00+00:00,1.0\nNL,2026\n")
    summary = jobs.ingest_landing(spark, f"{folder}/landing", f"{folder}/bronze", f"{folder}/ledger",
                                  formats={"load": "csv"}, job_id="j").first()
    assert (summary["batches"], summary["failures"], summary["rows_loaded"]) == (2, 1, 1)
    rows = {r["status"]: r for r in I.read_ledger(spark, f"{folder}/ledger", "j").collect()}
    assert rows["loaded"]["zone_code"] == "AT" and rows["loaded"]["file"] is None
    assert rows["rejected"]["file"].endswith("torn.csv") and rows["rejected"]["reason"] == "torn lines: 1"
    # Only unfit files: nothing to load, and still a ledger.
    put(f"{folder}/other/load/torn.csv", f"{HEADER}\nNL,2026\n")
    jobs.ingest_landing(spark, f"{folder}/other", f"{folder}/bronze", f"{folder}/ledger", formats={"load": "csv"}, job_id="k")
    assert [r["status"] for r in I.read_ledger(spark, f"{folder}/ledger", "k").collect()] == ["rejected"]


def test_a_replayed_batch_writes_nothing_until_its_rows_change(spark):
    from pyspark.sql import functions as F

    from gridmart.plans import queries as Q
    from gridmart.sources import bronze
    from gridmart.specs import MIN_TS, SOURCES

    root, ledger, written = Q.ingest_twice(spark, "/root/testdata/sf0.001", revise=False)
    assert written[0] > 0 and written[1] == 0
    counts = {r["status"] for r in I.read_ledger(spark, ledger, "second").select("status").distinct().collect()}
    assert counts == {"replayed", "rejected"}
    assert sum(bronze.read_bronze(spark, root, s, MIN_TS).count() for s in SOURCES.values()) == written[0]
    # A value that was replaced and comes back is new: the last load counts, not any.
    base = session.fresh_path(spark, "t-back")
    day = spark.createDataFrame([("load", "AT", 10.0 * h, f"2024-01-08 0{h}:00:00") for h in (1, 2, 3)], "source string, zone_code string, load_mw double, ts string")
    day = day.select("source", "zone_code", F.lit("2024-01-08").cast("date").alias("market_day"), F.lit("r").alias("run_id"),
                     F.col("ts").cast("timestamp").alias("ts_utc"), F.lit(60).cast("long").alias("resolution_minutes"), "load_mw")
    other = day.withColumn("load_mw", F.col("load_mw") + 1)
    shuffled = day.orderBy(F.desc("load_mw")).repartition(3)
    got = [I.ingest(spark, d, "load", f"{base}/b", f"{base}/l", datetime(2024, 1, 9 + i, tzinfo=UTC), job_id=str(i))
           for i, d in enumerate((day, shuffled, other, day, day))]
    assert got == [3, 0, 3, 3, 0]

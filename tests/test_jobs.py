"""A deployment's day: landed files in three formats -> bronze -> mart -> page."""

import json
import os
from datetime import UTC, datetime

from test_ingest import _write_csv

from gridmart import dims, session
from gridmart.operators import serve
from gridmart.plans import jobs
from gridmart.sources import mart


def test_landing_to_served_page(spark):
    base = session.fresh_path(spark, "t-jobs")
    day = "2026-08-01"  # Berlin summer time: 07-31 22:00 .. 08-01 22:00 UTC
    hours = [f"2026-08-01T{h:02d}:00:00+00:00" for h in range(22)]
    _write_csv(f"{base}/landing/load", ["zone_code", "market_day", "run_id", "ts", "load_mw"],
               [("AT", day, "r1", ts, 7000.0 + i) for i, ts in enumerate(hours)]
               + [("FR", day, "r1", ts, 900_000.0) for ts in hours])  # implausible: rejected batch
    os.makedirs(f"{base}/landing/generation", exist_ok=True)
    with open(f"{base}/landing/generation/part-0.json", "w") as fh:
        for ts in hours:
            for name, measure, value in [("Solar", "Actual Aggregated", 3000.0),
                                         ("Fossil Gas", "Actual Aggregated", 1000.0),
                                         ("Hydro Pumped Storage", "Actual Consumption", 200.0)]:
                fh.write(json.dumps(dict(zone_code="AT", market_day=day, run_id="g1", ts=ts,
                                         name=name, measure=measure, value=value)) + "\n")
    price = spark.createDataFrame(
        [("AT", day, "p1", ts, 80.0, "60min") for ts in hours] + [("AT", day, "p1", "2026-08-01T22:00:00+00:00", 99.0, "60min")],
        "zone_code string, market_day string, run_id string, ts string, price_eur_mwh double, series_resolution string",
    ).selectExpr("zone_code", "CAST(market_day AS DATE) AS market_day", "run_id", "ts", "price_eur_mwh", "series_resolution")
    price.write.parquet(f"{base}/landing/price")

    summary = {r["source"]: r for r in jobs.ingest_landing(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/ledger",
        formats={"load": "csv", "generation": "json"}).collect()}
    assert summary["load"]["batches"] == 2 and summary["load"]["failures"] == 1
    assert summary["generation"]["rows_loaded"] == 66 and summary["price"]["rows_loaded"] == 22

    results = jobs.build_mart(spark, f"{base}/bronze", f"{base}/mart").collect()
    assert len(results) == 14 and all(r["passed"] for r in results)

    fct = mart.read_fct(spark, f"{base}/mart")
    req = serve.PageRequest.make("AT", datetime(2026, 8, 1, tzinfo=UTC), datetime(2026, 8, 2, tzinfo=UTC), limit=10)
    rows, cursor = serve.hourly_page(fct, req)
    assert len(rows) == 10 and cursor is not None
    first = rows[0]
    assert first["load_mw"] == 7000.0 and first["renewable_pct"] == 75.0 and first["price_eur_mwh"] == 80.0
    assert first["carbon_intensity_g_kwh"] == round((3000 * 48 + 1000 * 490) / 4000, 1)
    assert fct.filter("zone_code = 'FR'").count() == 0


def test_stale_sources_stop_the_build(spark):
    import pytest

    import builders as B
    from gridmart.sources import bronze
    from gridmart.specs import SOURCES

    root = session.fresh_path(spark, "t-jobs-bronze")
    rows = [("AT", "2024-01-10 05:00:00", 60, 1.0, "2024-01-11 00:00:00", "r")]
    bronze.write_bronze(B.load(spark, rows), root, SOURCES["load"])
    bronze.write_bronze(B.generation(spark, [("AT", "2024-01-10 05:00:00", 60, "Solar", 1.0, "2024-01-11 00:00:00", "g")]), root, SOURCES["generation"])
    bronze.write_bronze(B.price(spark, [("AT", "2024-01-10 05:00:00", 60, 1.0, "2024-01-11 00:00:00", "p")]), root, SOURCES["price"])
    status = {r["source"]: r["status"] for r in jobs.check_freshness(spark, root, datetime(2024, 1, 12, 6, tzinfo=UTC)).collect()}
    assert status == {"load": "warn", "generation": "warn", "price": "warn"}
    results = jobs.build_mart(spark, root, session.fresh_path(spark, "t-jobs-mart"),
                              freshness_now=datetime(2024, 1, 12, 6, tzinfo=UTC))
    assert all(r["passed"] for r in results.collect())  # warn does not stop the build
    with pytest.raises(jobs.StaleSourceError):
        jobs.build_mart(spark, root, session.fresh_path(spark, "t-jobs-mart"),
                        freshness_now=datetime(2024, 1, 14, tzinfo=UTC))


def _load_files(base, days):
    rows = [("AT", d, f"run-{d}", f"{d}T{h:02d}:00:00+00:00", 10.0) for d in days for h in range(5)]
    _write_csv(f"{base}/landing/load", ["zone_code", "market_day", "run_id", "ts", "load_mw"], rows)


def test_a_run_reads_its_own_day_and_reports_its_own_batches(spark):
    from gridmart.plans import ingest as I
    from gridmart.sources import bronze
    from gridmart.specs import SOURCES

    base = session.fresh_path(spark, "t-daily")
    _load_files(base, ["2026-08-01", "2026-08-02", "2026-08-03"])

    def run(date, job):
        return {r["source"]: r for r in jobs.ingest_landing(
            spark, f"{base}/landing", f"{base}/bronze", f"{base}/ledger", formats={"load": "csv"},
            run_date=date, zones="AT, NL", sources=["load", "price"], job_id=job).collect()}

    first = run("2026-08-02", "a")  # yesterday: 1 August
    assert (first["load"]["batches"], first["load"]["failures"], first["load"]["rows_loaded"]) == (2, 1, 5)
    assert (first["price"]["batches"], first["price"]["failures"]) == (2, 2)  # nothing landed at all
    second = run("2026-08-03", "b")
    assert (second["load"]["batches"], second["load"]["rows_loaded"]) == (2, 5)
    back = bronze.read_bronze(spark, f"{base}/bronze", SOURCES["load"], start="2026-07-01")
    assert sorted(r["run_id"] for r in back.select("run_id").distinct().collect()) == ["run-2026-08-01", "run-2026-08-02"]
    ledger = I.read_ledger(spark, f"{base}/ledger", "b").collect()
    assert {(r["zone_code"], r["status"]) for r in ledger if r["source"] == "load"} == {("AT", "loaded"), ("NL", "missing")}
    # A later clean run is not failed by an earlier one.
    clean = {r["source"]: r for r in jobs.ingest_landing(
        spark, f"{base}/landing", f"{base}/bronze", f"{base}/ledger", formats={"load": "csv"},
        run_date="2026-08-04", zones="AT", sources=["load"]).collect()}
    assert clean["load"]["failures"] == 0


def test_full_rebuild_drops_a_withdrawn_month_and_refuses_to_empty_the_mart(spark):
    import pytest

    import builders as B
    from gridmart.operators import checks
    from gridmart.sources import bronze
    from gridmart.specs import SOURCES

    root, path = session.fresh_path(spark, "t-full"), session.fresh_path(spark, "t-full-mart")
    rows = [("AT", "2024-01-10 05:00:00", 60, 1.0, "2024-01-11 00:00:00", "r"),
            ("AT", "2024-02-10 05:00:00", 60, 2.0, "2024-02-11 00:00:00", "r")]
    bronze.write_bronze(B.load(spark, rows), root, SOURCES["load"])
    seed = session.fresh_path(spark, "t-seed")
    dims.write_production_type_seed(spark, seed)
    jobs.build_mart(spark, root, path, seed_path=seed)
    assert mart.read_fct(spark, path).count() == 2
    gone = [("AT", "2024-01-10 05:00:00", 60, None, "2024-03-01 00:00:00", "w")]
    bronze.write_bronze(B.load(spark, gone), root, SOURCES["load"])
    jobs.build_mart(spark, root, path)
    assert [r["load_mw"] for r in mart.read_fct(spark, path).collect()] == [2.0]
    with pytest.raises(checks.CheckFailed):
        jobs.build_mart(spark, session.fresh_path(spark, "t-nothing"), path)
    assert mart.read_fct(spark, path).count() == 1

"""Incremental refresh equals a full rebuild and only rebuilds touched months."""

from datetime import date

import builders as B

from gridmart import session
from gridmart.plans.fact import fct_from_bronze
from gridmart.sources import bronze, mart
from gridmart.specs import SOURCES
from gridmart.streaming.incremental import refresh

KEY = ["zone_code", "ts_hour_utc"]


def _load(ts, mw, ing, run="r"):
    return ("DE_LU", ts, 60, mw, ing, run)


def test_refresh_matches_full_rebuild(spark):
    root = session.fresh_path(spark, "t-inc-bronze")
    mart_path = session.fresh_path(spark, "t-inc-mart")
    ckpt = session.fresh_path(spark, "t-inc-ckpt")
    first = [_load("2024-01-10 05:00:00", 10.0, "2024-01-11 00:00:00"),
             _load("2024-02-10 05:00:00", 20.0, "2024-02-11 00:00:00")]
    gen = [("DE_LU", "2024-01-10 05:00:00", 60, "Solar", 4.0, "2024-01-11 00:00:00", "g")]
    price = [("DE_LU", "2024-02-10 05:00:00", 60, 50.0, "2024-02-11 00:00:00", "p")]
    bronze.write_bronze(B.load(spark, first), root, SOURCES["load"])
    bronze.write_bronze(B.generation(spark, gen), root, SOURCES["generation"])
    bronze.write_bronze(B.price(spark, price), root, SOURCES["price"])
    assert [str(m) for m in refresh(spark, root, mart_path, ckpt)] == ["2024-01-01", "2024-02-01"]

    # Second increment: a late revision for January and a new March hour.
    late = [_load("2024-01-10 05:00:00", 11.0, "2024-03-20 00:00:00", "r2"),
            _load("2024-03-01 00:00:00", 30.0, "2024-03-02 00:00:00")]
    bronze.write_bronze(B.load(spark, late), root, SOURCES["load"])
    assert [str(m) for m in refresh(spark, root, mart_path, ckpt)] == ["2024-01-01", "2024-03-01"]
    assert refresh(spark, root, mart_path, ckpt) == []  # nothing new

    got = B.collect_dicts(mart.read_fct(spark, mart_path).drop("ts_month"), KEY)
    full = fct_from_bronze(
        spark, B.load(spark, first + late), B.generation(spark, gen), B.price(spark, price)
    )
    assert got == B.collect_dicts(full, KEY)
    assert [r["load_mw"] for r in got] == [11.0, 20.0, 30.0]


def test_many_micro_batches_and_a_rejected_rebuild(spark):
    import pytest
    from pyspark.errors import StreamingQueryException

    root = session.fresh_path(spark, "t-inc-bronze")
    mart_path = session.fresh_path(spark, "t-inc-mart")
    ckpt = session.fresh_path(spark, "t-inc-ckpt")
    for i, month in enumerate(["2024-01", "2024-02", "2024-03"]):
        bronze.write_bronze(B.load(spark, [_load(f"{month}-05 05:00:00", 10.0 + i, f"{month}-06 00:00:00")]), root, SOURCES["load"])
    bronze.write_bronze(B.generation(spark, [("DE_LU", "2024-01-05 05:00:00", 60, "Solar", 4.0, "2024-01-06 00:00:00", "g")]), root, SOURCES["generation"])
    bronze.write_bronze(B.price(spark, [("DE_LU", "2024-01-05 05:00:00", 60, 5.0, "2024-01-06 00:00:00", "p")]), root, SOURCES["price"])
    rebuilt = refresh(spark, root, mart_path, ckpt, max_files_per_trigger=1)
    assert [str(m) for m in rebuilt] == ["2024-01-01", "2024-02-01", "2024-03-01"]
    before = B.collect_dicts(mart.read_fct(spark, mart_path).drop("ts_month"), KEY)

    # Negative generation pushes the renewable share past 100 %: the gate refuses.
    bad = [("DE_LU", "2024-02-05 05:00:00", 60, "Solar", 100.0, "2024-02-07 00:00:00", "g2"),
           ("DE_LU", "2024-02-05 05:00:00", 60, "Fossil Gas", -50.0, "2024-02-07 00:00:00", "g2")]
    bronze.write_bronze(B.generation(spark, bad), root, SOURCES["generation"])
    with pytest.raises(StreamingQueryException):
        refresh(spark, root, mart_path, ckpt)
    assert B.collect_dicts(mart.read_fct(spark, mart_path).drop("ts_month"), KEY) == before

    # A correcting revision arrives; the failed batch's files are read again.
    fix = [("DE_LU", "2024-02-05 05:00:00", 60, "Fossil Gas", 50.0, "2024-02-08 00:00:00", "g3")]
    bronze.write_bronze(B.generation(spark, fix), root, SOURCES["generation"])
    assert [str(m) for m in refresh(spark, root, mart_path, ckpt)] == ["2024-02-01"]
    feb = [r for r in B.collect_dicts(mart.read_fct(spark, mart_path).drop("ts_month"), KEY)
           if str(r["ts_hour_utc"]).startswith("2024-02")]
    assert feb[0]["renewable_pct"] == 66.67 and feb[0]["total_generation_mw"] == 150.0


def test_refresh_before_every_feed_has_data(spark):
    root = session.fresh_path(spark, "t-inc-bronze")
    mart_path = session.fresh_path(spark, "t-inc-mart")
    ckpt = session.fresh_path(spark, "t-inc-ckpt")
    assert refresh(spark, root, mart_path, ckpt) == []  # no bronze at all yet
    bronze.write_bronze(B.load(spark, [_load("2024-01-10 05:00:00", 10.0, "2024-01-11 00:00:00")]), root, SOURCES["load"])
    assert [str(m) for m in refresh(spark, root, mart_path, ckpt)] == ["2024-01-01"]
    [row] = mart.read_fct(spark, mart_path).collect()
    assert row["load_mw"] == 10.0 and row["total_generation_mw"] is None and row["price_eur_mwh"] is None
    # A feed that starts later is picked up by the same checkpoint.
    bronze.write_bronze(B.price(spark, [("DE_LU", "2024-01-10 05:00:00", 60, 42.0, "2024-01-12 00:00:00", "p")]), root, SOURCES["price"])
    assert [str(m) for m in refresh(spark, root, mart_path, ckpt)] == ["2024-01-01"]
    [row] = mart.read_fct(spark, mart_path).collect()
    assert row["price_eur_mwh"] == 42.0


def test_publishing_some_months_keeps_the_others_even_in_static_mode(spark):
    from gridmart.plans.publish import publish_fct

    path = session.fresh_path(spark, "t-mart")
    jan = fct_from_bronze(spark, B.load(spark, [_load("2024-01-10 05:00:00", 1.0, "2024-01-11 00:00:00")]),
                          B.empty_generation(spark), B.empty_price(spark), with_month=True)
    feb = fct_from_bronze(spark, B.load(spark, [_load("2024-02-10 05:00:00", 2.0, "2024-02-11 00:00:00")]),
                          B.empty_generation(spark), B.empty_price(spark), with_month=True)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        publish_fct(spark, jan, path, [date(2024, 1, 1)])
        publish_fct(spark, feb, path, [date(2024, 2, 1)])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert sorted(r["load_mw"] for r in mart.read_fct(spark, path).collect()) == [1.0, 2.0]


def test_refresh_removes_a_month_that_lost_its_last_row(spark):
    root, mart_path, ckpt = (session.fresh_path(spark, f"t-gone-{x}") for x in ("bronze", "mart", "ckpt"))
    bronze.write_bronze(B.load(spark, [_load("2024-01-10 05:00:00", 1.0, "2024-01-11 00:00:00"),
                                       _load("2024-02-10 05:00:00", 2.0, "2024-02-11 00:00:00")]), root, SOURCES["load"])
    refresh(spark, root, mart_path, ckpt)
    bronze.write_bronze(B.load(spark, [_load("2024-01-10 05:00:00", None, "2024-03-01 00:00:00", "w")]), root, SOURCES["load"])
    assert [str(m) for m in refresh(spark, root, mart_path, ckpt)] == ["2024-01-01"]
    assert [r["load_mw"] for r in mart.read_fct(spark, mart_path).collect()] == [2.0]

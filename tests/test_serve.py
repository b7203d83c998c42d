from datetime import UTC, datetime, timedelta

import builders as B
import pytest
from pyspark.sql import functions as F

from gridmart import dims
from gridmart.functions.text import csv_list, decode_cursor, encode_cursor
from gridmart.operators import serve
from gridmart.plans.fact import fct_from_bronze

T0 = datetime(2026, 8, 1, tzinfo=UTC)


def _fct(spark, hours=168, zone="DE_LU"):
    rows = [
        (zone, (T0 + timedelta(hours=i)).strftime("%Y-%m-%d %H:%M:%S"), 60, 1000.0 + i, "2026-09-01 00:00:00", "r")
        for i in range(hours)
    ]
    return fct_from_bronze(spark, B.load(spark, rows), B.empty_generation(spark), B.empty_price(spark))


def test_zone_list_is_ordered_and_carries_coverage(spark):
    rows = serve.zone_list(dims.dim_zone(spark), _fct(spark, 3)).collect()
    assert [r["zone_code"] for r in rows] == sorted(z[0] for z in dims.ZONES)
    by = {r["zone_code"]: r for r in rows}
    assert by["DE_LU"]["fact_hours"] == 3 and by["AT"]["fact_hours"] == 0


@pytest.mark.parametrize("zone", ["not-a-zone", "de_lu", "", "DEU"])
def test_bad_zone_is_rejected(zone):
    with pytest.raises(ValueError):
        serve.PageRequest.make(zone, T0, T0 + timedelta(days=1))


@pytest.mark.parametrize("limit", [0, 1001])
def test_limit_bounds(limit):
    with pytest.raises(ValueError):
        serve.PageRequest.make("DE_LU", T0, T0 + timedelta(days=1), limit)


def test_start_must_precede_end():
    with pytest.raises(ValueError):
        serve.PageRequest.make("DE_LU", T0, T0)


def test_defaults_are_last_seven_days():
    req = serve.PageRequest.make("DE_LU", now=T0)
    assert req.end == T0 and req.start == T0 - timedelta(days=7) and req.limit == 168


def test_cursor_round_trip_and_malformed():
    ts = datetime(2024, 1, 8, 5, tzinfo=UTC)
    assert decode_cursor(encode_cursor(ts)) == ts
    assert decode_cursor(None) is None and decode_cursor("") is None
    with pytest.raises(ValueError):
        decode_cursor("%%%not base64")


def test_executor_side_cursor_matches_driver_encoding(spark):
    from gridmart.functions.text import cursor_expr

    df = spark.createDataFrame([("2024-01-08 05:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    assert df.select(cursor_expr(F.col("t")).alias("c")).first()["c"] == encode_cursor(
        datetime(2024, 1, 8, 5, tzinfo=UTC)
    )


def test_exactly_full_page_points_to_an_empty_page(spark):
    fct = _fct(spark, 168)
    req = serve.PageRequest.make("DE_LU", T0, T0 + timedelta(days=30), limit=168)
    rows, cursor = serve.hourly_page(fct, req)
    assert len(rows) == 168 and cursor is not None
    assert rows[0]["page_count"] == 168
    nxt = serve.PageRequest.make("DE_LU", T0, T0 + timedelta(days=30), limit=168, cursor=cursor)
    rows2, cursor2 = serve.hourly_page(fct, nxt)
    assert rows2 == [] and cursor2 is None


def test_pages_walk_the_range_in_order(spark):
    fct = _fct(spark, 30)
    seen, cursor = [], None
    while True:
        req = serve.PageRequest.make("DE_LU", T0, T0 + timedelta(days=2), limit=7, cursor=cursor)
        rows, cursor = serve.hourly_page(fct, req)
        seen += [r["load_mw"] for r in rows]
        if cursor is None:
            break
    assert seen == [1000.0 + i for i in range(30)]


def test_page_plans_as_take_ordered(spark):
    req = serve.PageRequest.make("DE_LU", T0, T0 + timedelta(days=2), limit=10)
    plan = serve.page_frame(_fct(spark, 5), req)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_zone_list_parsing(spark):
    df = spark.createDataFrame([("DE_LU, AT ,NL",), (" , ,",)], "s string")
    got = [r["z"] for r in df.select(csv_list(F.col("s")).alias("z")).collect()]
    assert got == [["DE_LU", "AT", "NL"], []]


def test_page_refuses_rows_breaking_the_response_contract(spark):
    fct = _fct(spark, 3).withColumn("renewable_pct", F.lit(130.0))
    req = serve.PageRequest.make("DE_LU", T0, T0 + timedelta(days=1), limit=10)
    with pytest.raises(serve.ResponseContractError):
        serve.hourly_page(fct, req)

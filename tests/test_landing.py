import pytest
from pyspark.sql import functions as F

from gridmart.functions.time import parse_instant
from gridmart.operators import outcomes, reshape, series


def test_two_level_header_is_flattened(spark):
    df = spark.createDataFrame(
        [("Hydro Pumped Storage", "Actual Aggregated"), ("Hydro Pumped Storage", "Actual Consumption"),
         ("Solar", "Actual Aggregated")],
        "name string, measure string",
    )
    got = [r["t"] for r in df.select(reshape.flatten_header(F.col("name"), F.col("measure")).alias("t")).collect()]
    assert got == ["Hydro Pumped Storage", "Hydro Pumped Storage Consumption", "Solar"]


def test_melt_keeps_null_cells(spark):
    wide = spark.createDataFrame([("t1", 1.0, None)], "ts string, `Solar` double, `Nuclear` double")
    long = reshape.melt(wide, ["ts"], ["Solar", "Nuclear"], "production_type", "generation_mw").collect()
    assert len(long) == 2 and {r["production_type"]: r["generation_mw"] for r in long} == {"Solar": 1.0, "Nuclear": None}


def test_first_available_series_never_mixes(spark):
    df = spark.createDataFrame(
        [("a", "15min", 1.0), ("a", "60min", 2.0), ("b", "60min", 3.0), ("c", "30min", 4.0)],
        "batch string, series_resolution string, price double",
    )
    got = sorted((r["batch"], r["price"]) for r in series.first_available_series(df, ["batch"]).collect())
    assert got == [("a", 1.0), ("b", 3.0)]
    timed = df.withColumns({"ts_utc": F.lit("2024-01-08").cast("timestamp"), "end": F.lit("2024-01-09").cast("timestamp")})
    missing = series.batches_emptied(timed, ["batch"], "end").collect()
    assert [(r["batch"], r["rows"], r["has_series"]) for r in missing] == [("c", 1, False)]


def test_end_boundary_and_offset_parsing(spark):
    df = spark.createDataFrame(
        [("2024-01-07T23:00:00+00:00",), ("2024-01-08T00:00:00+01:00",), ("2024-01-08T01:00:00+01:00",)],
        "ts string",
    ).select(parse_instant("ts").alias("ts_utc"), F.lit("2024-01-08 00:00:00").cast("timestamp").alias("end"))
    assert series.drop_end_boundary(df, "end").count() == 2
    junk = df.withColumn("ts_utc", F.lit(None).cast("timestamp"))
    assert series.drop_end_boundary(junk, "end").count() == 3  # left for the contract to reject


def test_unparseable_stamp_is_null(spark):
    df = spark.createDataFrame([("yesterday-ish",)], "ts string")
    assert df.select(parse_instant("ts").alias("t")).first()["t"] is None


@pytest.mark.parametrize(
    ("kind", "status", "expected"),
    [
        (None, None, "ok"),
        ("no_data", None, "permanent"),
        ("http", 429, "transient"),
        ("http", 503, "transient"),
        ("http", 401, "permanent"),
        ("connection", None, "transient"),
        ("timeout", None, "transient"),
        ("other", None, "unclassified"),
    ],
)
def test_fetch_outcome(spark, kind, status, expected):
    df = spark.createDataFrame([(kind, status)], "error_kind string, http_status int")
    assert outcomes.classify(df).first()["outcome"] == expected

from datetime import UTC, datetime

import builders as B
import pytest
from pyspark.sql import functions as F

from gridmart import dims, session
from gridmart.operators import checks
from gridmart.plans.fact import fct_from_bronze
from gridmart.plans.publish import publish_fct
from gridmart.sources import mart


def _fct(spark, with_month=False):
    rows = [("DE_LU", "2024-01-10 05:00:00", 60, 10.0, "2024-01-11 00:00:00", "r")]
    gen = [("DE_LU", "2024-01-10 05:00:00", 60, "Solar", 4.0, "2024-01-11 00:00:00", "g")]
    return fct_from_bronze(spark, B.load(spark, rows), B.generation(spark, gen), B.empty_price(spark), with_month)


def test_fourteen_tests_pass_on_a_clean_fact(spark):
    res = checks.data_tests(_fct(spark), dims.dim_zone(spark), dims.dim_production_type(spark)).collect()
    assert len(res) == 14 and all(r["passed"] for r in res)


def test_range_and_uniqueness_failures_are_counted(spark):
    bad = _fct(spark).withColumn("renewable_pct", F.lit(120.0))
    bad = bad.unionByName(bad)
    res = {r["check_name"]: r for r in checks.data_tests(bad, dims.dim_zone(spark), dims.dim_production_type(spark)).collect()}
    assert res["assert_renewable_pct_in_range"]["failing_rows"] == 2
    assert res["unique_combination_fct_grid_hourly_zone_code__ts_hour_utc"]["failing_rows"] == 1
    assert sorted(checks.gate(checks.data_tests(bad, dims.dim_zone(spark), dims.dim_production_type(spark)))) == [
        "assert_renewable_pct_in_range", "unique_combination_fct_grid_hourly_zone_code__ts_hour_utc"]


def test_relationship_check_exempts_null_children(spark):
    fct = _fct(spark).withColumn("zone_code", F.lit(None).cast("string"))
    res = {r["check_name"]: r for r in checks.data_tests(fct, dims.dim_zone(spark), dims.dim_production_type(spark)).collect()}
    assert res["relationships_fct_grid_hourly_zone_code__dim_zone"]["failing_rows"] == 0
    assert res["not_null_fct_grid_hourly_zone_code"]["failing_rows"] == 1


def test_gate_blocks_a_bad_build(spark):
    path = session.fresh_path(spark, "t-mart")
    publish_fct(spark, _fct(spark, True), path)
    before = mart.read_fct(spark, path).collect()
    bad = _fct(spark, True).withColumn("carbon_intensity_g_kwh", F.lit(5000.0))
    with pytest.raises(checks.CheckFailed):
        publish_fct(spark, bad, path)
    assert mart.read_fct(spark, path).collect() == before


@pytest.mark.parametrize(
    ("now", "status"),
    [
        (datetime(2024, 1, 11, 3, tzinfo=UTC), "pass"),
        (datetime(2024, 1, 12, 6, tzinfo=UTC), "warn"),
        (datetime(2024, 1, 13, 1, tzinfo=UTC), "error"),
        (datetime(2024, 3, 1, tzinfo=UTC), "error"),  # nothing in the last 30 days
    ],
)
def test_freshness_status(spark, now, status):
    feed = B.load(spark, [("DE_LU", "2024-01-10 05:00:00", 60, 1.0, "2024-01-11 00:00:00", "r")])
    [r] = checks.freshness({"load": feed}, [now]).collect()
    assert r["status"] == status


def test_accepted_values_count_distinct_bad_values(spark):
    bad = dims.dim_production_type(spark).withColumn("category", F.lit("fusion")).unionByName(
        dims.dim_production_type(spark).withColumn("category", F.lit("antimatter"))
    )
    res = {r["check_name"]: r for r in checks.data_tests(_fct(spark), dims.dim_zone(spark), bad).collect()}
    assert res["accepted_values_dim_production_type_category"]["failing_rows"] == 2
    assert res["unique_dim_production_type_production_type"]["failing_rows"] == 36

from datetime import date

from pyspark.sql import functions as F

from gridmart.operators import grid
from gridmart.specs import SOURCES


def test_grid_is_sources_times_zones_per_day(spark):
    bounds = spark.createDataFrame([("2025-10-25", "2025-10-27")], "a string, b string").select(
        F.to_date("a").alias("first_day"), F.to_date("b").alias("last_day")
    )
    days = grid.with_market_window(grid.backfill_days(bounds))
    hours = {str(r["market_day"]): r["window_hours"] for r in days.collect()}
    assert hours == {"2025-10-25": 24, "2025-10-26": 25, "2025-10-27": 24}
    g = grid.job_grid(days, list(SOURCES), "DE_LU, AT ,NL, FR, DK_1, DK_2")
    assert g.count() == 3 * 18
    assert g.filter(F.col("market_day") == F.lit("2025-10-26").cast("date")).count() == 18
    assert "CartesianProduct" not in g._jdf.queryExecution().executedPlan().toString()


def test_run_days_default_to_yesterday_or_two_back(spark):
    row = spark.range(1).select(
        grid.run_days("2026-08-15").alias("cli"), grid.run_days("2026-08-15", 2).alias("dag")
    ).first()
    assert row["cli"] == date(2026, 8, 14) and row["dag"] == date(2026, 8, 13)

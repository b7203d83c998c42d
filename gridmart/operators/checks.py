"""Data tests over the mart and its dimensions, freshness, and the gate.

A check is a name plus the rows that offend it; it passes with zero rows.
Row-predicate checks on one table are evaluated together in a single scan
(``count_if`` per check), grouped checks by one aggregation each.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.dims import CATEGORIES, FLOW_DIRECTIONS

MAX_CARBON_INTENSITY = 1100.0  # g/kWh, above any emission factor of the type dimension
WARN_AFTER_HOURS, ERROR_AFTER_HOURS = 26, 48
FRESHNESS_LOOKBACK_DAYS = 30


@dataclass(frozen=True)
class RowCheck:
    """A check answered by one aggregate over the table (its failure count)."""

    name: str
    failures: Column


def offending_rows(name: str, predicate: Column) -> RowCheck:
    """Failures = rows matching ``predicate``."""
    return RowCheck(name, F.count_if(predicate))


def unaccepted_values(name: str, col: str, accepted: list[str]) -> RowCheck:
    """Failures = distinct non-null values outside ``accepted`` (one per value)."""
    return RowCheck(name, F.count_distinct(F.when(~F.col(col).isin(*accepted), F.col(col))))


def _row_checks(df: DataFrame, checks: list[RowCheck]) -> DataFrame:
    """Evaluate many checks in one pass over ``df`` -> (check_name, failing_rows)."""
    agg = df.agg(*[c.failures.cast("bigint").alias(c.name) for c in checks])
    return agg.unpivot([], [c.name for c in checks], "check_name", "failing_rows")


def _unique(df: DataFrame, name: str, cols: list[str]) -> DataFrame:
    """Keys occurring more than once, counted once each.

    A single-column check ignores nulls; a column combination does not.
    """
    if len(cols) == 1:
        df = df.filter(F.col(cols[0]).isNotNull())
    dup = df.groupBy(*cols).count().filter(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows"
    )


def _relationship(child: DataFrame, parent: DataFrame, name: str, col: str) -> DataFrame:
    """Child values missing from the parent; null children are exempt."""
    orphans = child.filter(F.col(col).isNotNull()).join(parent.select(col), col, "left_anti")
    return orphans.agg(F.count(F.lit(1)).alias("failing_rows")).select(
        F.lit(name).alias("check_name"), "failing_rows"
    )


def data_tests(fct: DataFrame, dim_zone: DataFrame, dim_production_type: DataFrame) -> DataFrame:
    """The 14 warehouse tests -> (check_name, failing_rows, passed)."""
    f, z, p = "fct_grid_hourly", "dim_zone", "dim_production_type"
    fct_rows = _row_checks(fct, [
        offending_rows(f"not_null_{f}_zone_code", F.col("zone_code").isNull()),
        offending_rows(f"not_null_{f}_ts_hour_utc", F.col("ts_hour_utc").isNull()),
        offending_rows(f"not_null_{f}_load_mw", F.col("load_mw").isNull()),
        offending_rows(
            "assert_no_impossible_carbon_intensity",
            (F.col("carbon_intensity_g_kwh") < 0) | (F.col("carbon_intensity_g_kwh") > MAX_CARBON_INTENSITY),
        ),
        offending_rows(
            "assert_renewable_pct_in_range", (F.col("renewable_pct") < 0) | (F.col("renewable_pct") > 100)
        ),
    ])
    zone_rows = _row_checks(dim_zone, [
        offending_rows(f"not_null_{z}_zone_code", F.col("zone_code").isNull()),
        offending_rows(f"not_null_{z}_timezone", F.col("timezone").isNull()),
    ])
    type_rows = _row_checks(dim_production_type, [
        offending_rows(f"not_null_{p}_production_type", F.col("production_type").isNull()),
        unaccepted_values(f"accepted_values_{p}_category", "category", CATEGORIES),
        unaccepted_values(f"accepted_values_{p}_flow_direction", "flow_direction", FLOW_DIRECTIONS),
    ])
    parts = [
        fct_rows,
        zone_rows,
        type_rows,
        _relationship(fct, dim_zone, f"relationships_{f}_zone_code__{z}", "zone_code"),
        _unique(fct, f"unique_combination_{f}_zone_code__ts_hour_utc", ["zone_code", "ts_hour_utc"]),
        _unique(dim_zone, f"unique_{z}_zone_code", ["zone_code"]),
        _unique(dim_production_type, f"unique_{p}_production_type", ["production_type"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        "check_name",
        F.col("failing_rows").cast("bigint").alias("failing_rows"),
        (F.col("failing_rows") == 0).alias("passed"),
    )


def freshness(feeds: dict[str, DataFrame], now: list[datetime]) -> DataFrame:
    """Age of the newest ``ingested_at`` per feed, looking back 30 days from ``now``.

    pass / warn (older than 26 h) / error (older than 48 h, or no rows at all).
    ``now`` is a short list of instants (parameters, so results are
    reproducible); each becomes one conditional ``max`` column, so every feed
    is scanned once, with a map-side partial aggregate and no join.
    """
    texts = [n.isoformat() if n.tzinfo else n.isoformat() + "+00:00" for n in now]
    out = None
    for name, df in feeds.items():
        cols = []
        for i, t in enumerate(texts):
            since = F.lit(t).cast("timestamp") - F.expr(f"INTERVAL {FRESHNESS_LOOKBACK_DAYS} DAYS")
            cols.append(
                F.struct(
                    F.lit(t).cast("timestamp").alias("checked_at"),
                    F.max(F.when(F.col("ts_utc") >= since, F.col("ingested_at"))).alias("max_loaded_at"),
                ).alias(f"n{i}")
            )
        wide = df.agg(*cols)
        per = wide.unpivot([], [f"n{i}" for i in range(len(texts))], "_k", "_v").select(
            F.lit(name).alias("source"), "_v.checked_at", "_v.max_loaded_at"
        )
        out = per if out is None else out.unionByName(per)
    age = (F.unix_micros("checked_at") - F.unix_micros("max_loaded_at")) / F.lit(3_600_000_000.0)
    return out.select(
        "source",
        "checked_at",
        "max_loaded_at",
        age.alias("age_hours"),
        F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
        .when(age > ERROR_AFTER_HOURS, F.lit("error"))
        .when(age > WARN_AFTER_HOURS, F.lit("warn"))
        .otherwise(F.lit("pass"))
        .alias("status"),
    )


class CheckFailed(RuntimeError):
    pass


def gate(results: DataFrame) -> list[str]:
    """Names of failing checks (at most a few dozen rows reach the driver)."""
    return [r["check_name"] for r in results.filter(~F.col("passed")).select("check_name").collect()]

"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# From 2**53 on a double has no fraction left, and floor() would leave the BIGINT range.
WHOLE_FROM = 9007199254740992.0


def round_half_away_sql(x: str, digits: int) -> str:
    """SQL text of ``round_half_away`` (one expression, one JVM call to build)."""
    s = f"CAST({float(10 ** digits)!r} AS DOUBLE)"
    up = f"CAST(floor(abs({x}) * {s} + 0.5) AS DOUBLE) / {s}"
    return (
        f"CASE WHEN abs({x}) * {s} >= CAST({WHOLE_FROM!r} AS DOUBLE) THEN {x} "
        f"WHEN ({x}) < 0 THEN -({up}) ELSE {up} END"
    )


def round_half_away(x: Column | str, digits: int) -> Column:
    """Round to ``digits`` places, halves away from zero, on the binary value.

    Written as ``floor(|x| * 10^d + 0.5) / 10^d`` so that any engine doing
    IEEE arithmetic gets the same double (Spark's ``round`` rounds the decimal
    text instead and differs on values such as 0.285). Where ``|x| * 10^d``
    has no fraction, and for NaN (which compares as the largest value), x is
    returned as it is. ``x`` may be a column name / SQL expression text, or a
    Column.
    """
    if isinstance(x, str):
        return F.expr(round_half_away_sql(x, digits))
    scale = float(10 ** digits)
    up = F.floor(F.abs(x) * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.abs(x) * F.lit(scale) >= F.lit(WHOLE_FROM), x).when(x < 0, -up).otherwise(up)


def settle_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column to ``digits`` places.

    Float sums depend on the order partial aggregates are combined in; results
    compared across engines or runs are settled to a fixed precision first.
    """
    exprs = [
        f"{round_half_away_sql(f'`{f.name}`', digits)} AS `{f.name}`"
        if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
        for f in df.schema.fields
    ]
    return df.selectExpr(*exprs)

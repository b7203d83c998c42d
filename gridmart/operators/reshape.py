"""Reshaping landed generation frames: header flatten, wide <-> long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.dims import CONSUMPTION_SUFFIX

CONSUMPTION_MEASURE = "Actual Consumption"


def flatten_header(name: Column, measure: Column) -> Column:
    """Two-level header ``(name, measure)`` -> one production-type name.

    ``(X, "Actual Consumption")`` becomes ``"X Consumption"``; every other
    measure keeps ``X``. Pumped storage reports both, so without the suffix
    the two would collapse into duplicate rows.
    """
    return F.when(measure == CONSUMPTION_MEASURE, F.concat(name, F.lit(CONSUMPTION_SUFFIX))).otherwise(
        name
    )


def widen(
    long: DataFrame, ids: Sequence[str], var: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Long -> wide over a fixed column list (conditional max, map-side combined).

    Absent names give nulls. The name list is fixed, not discovered, so no
    extra job runs to find it.
    """
    return long.groupBy(*ids).agg(
        *[F.max(F.when(F.col(var) == n, F.col(value))).alias(n) for n in names]
    )


def melt(
    wide: DataFrame, ids: Sequence[str], columns: Sequence[str], var: str, value: str
) -> DataFrame:
    """Wide -> long, keeping null cells (pandas ``melt`` semantics).

    ``DataFrame.unpivot`` plans an Expand: no shuffle, and unlike SQL
    ``UNPIVOT`` it keeps nulls, which reach bronze as null measures.
    """
    return wide.unpivot(list(ids), list(columns), var, value)

"""Latest-revision resolution over append-only bronze (top-1 per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

REVISION_RANK = "revision_rank"


def revision_order() -> list[Column]:
    """Newest first; equal instants by run id (text, descending)."""
    return [F.col("ingested_at").desc(), F.col("run_id").desc()]


def latest_revision(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    keep_rank: bool = False,
) -> DataFrame:
    """Keep the newest row per key, whatever its measure (null included).

    ``row_number() = 1`` over the key makes Spark plan a WindowGroupLimit: a
    partial top-1 runs on the map side before the shuffle, so a key replayed
    millions of times ships one row per map task, not all of its revisions.
    A later null revision survives here and retracts the value downstream
    (callers drop null measures *after* this step).
    """
    order = list(order) if order is not None else revision_order()
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(REVISION_RANK, F.row_number().over(w)).filter(F.col(REVISION_RANK) == 1)
    return ranked if keep_rank else ranked.drop(REVISION_RANK)


def retracted_keys(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Keys whose newest revision is null although an older one had a value.

    These are the intervals a filter-before-rank would wrongly bring back; the
    column ``superseded_<measure>`` holds the value that would have come back.
    One aggregate per key, in the order of ``revision_order``: the newest revision and
    the newest one with a value. Both combine on the map side; there is no join.
    """
    has_value = F.col(measure).isNotNull() & ~F.isnan(F.col(measure))  # NaN counts as no value
    at = [F.col("ingested_at"), F.col("run_id")]
    found = df.groupBy(*keys).agg(
        F.max(F.struct(*at, F.coalesce(has_value, F.lit(False)).alias("has"))).alias("newest"),
        F.max(F.when(has_value, F.struct(*at, F.col(measure).alias("value")))).alias("valued"),
    )
    return found.filter(~F.col("newest.has") & F.col("valued").isNotNull()).select(
        *keys, F.col("valued.value").alias(f"superseded_{measure}"))

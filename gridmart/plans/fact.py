"""The hourly fact: load drives the grain, mix / draw / price join left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import dims
from gridmart.functions.numeric import round_half_away_sql
from gridmart.functions.time import local_date, local_day_of_week, month_key
from gridmart.operators import conform, mix
from gridmart.specs import FCT_COLUMNS

KEYS = ["zone_code", "ts_hour_utc"]


def build_fct(
    stg_load: DataFrame,
    stg_generation: DataFrame,
    stg_price: DataFrame,
    dim_zone: DataFrame,
    dim_production_type: DataFrame,
    with_month: bool = False,
) -> DataFrame:
    """18-column fact, one row per zone-hour with load.

    Plan shape: each staging input is hash-partitioned on (zone_code,
    ts_hour_utc) by its own hourly aggregation, so the two left joins reuse
    that partitioning (no further exchange). The zone dim (6 rows by
    construction) is broadcast; an unknown zone drops the hour.
    """
    load = stg_load.select(
        *KEYS, "load_mw", F.col("intervals_aggregated").alias("load_intervals_aggregated")
    )
    mixed = mix.mix_and_draw(stg_generation, dim_production_type)
    price = stg_price.select(*KEYS, "price_eur_mwh")
    tz = F.col("timezone")
    total = F.col("total_generation_mw")
    joined = (
        load.join(F.broadcast(dim_zone.select("zone_code", "timezone")), "zone_code", "inner")
        .join(mixed, KEYS, "left")
        .join(price, KEYS, "left")
    )
    cols = {
        "zone_code": F.col("zone_code"),
        "ts_hour_utc": F.col("ts_hour_utc"),
        "date_local": local_date("ts_hour_utc", tz),
        "load_mw": F.col("load_mw"),
        "renewable_mw": F.col("renewable_mw"),
        "fossil_mw": F.col("fossil_mw"),
        "nuclear_mw": F.col("nuclear_mw"),
        "storage_mw": F.col("storage_mw"),
        "other_mw": F.col("other_mw"),
        "total_generation_mw": total,
        "storage_consumption_mw": F.col("storage_consumption_mw"),
        "renewable_pct": F.expr(
            "CASE WHEN total_generation_mw > 0 THEN "
            f"{round_half_away_sql('renewable_mw / total_generation_mw * 100.0', 2)} END"
        ),
        "residual_load_mw": F.col("load_mw") - F.coalesce(F.col("renewable_mw"), F.lit(0.0)),
        "carbon_intensity_g_kwh": F.expr(
            "CASE WHEN total_generation_mw > 0 THEN "
            f"{round_half_away_sql('total_co2_kg / total_generation_mw', 1)} END"
        ),
        "price_eur_mwh": F.col("price_eur_mwh"),
        "hour_utc": F.hour("ts_hour_utc").cast("bigint"),
        "day_of_week_local": local_day_of_week("ts_hour_utc", tz),
        "load_intervals_aggregated": F.col("load_intervals_aggregated").cast("bigint"),
    }
    out = [cols[c].alias(c) for c in FCT_COLUMNS]
    if with_month:
        out.append(month_key("ts_hour_utc").alias("ts_month"))
    return joined.select(*out)


def fct_from_bronze(
    spark: SparkSession,
    raw_load: DataFrame,
    raw_generation: DataFrame,
    raw_price: DataFrame,
    with_month: bool = False,
    production_types: DataFrame | None = None,
) -> DataFrame:
    """Bronze (all revisions) -> staging -> fact, as one logical plan.

    ``production_types`` is the type dimension (default: the inline rows; a
    deployment with its own seed passes ``dims.read_production_type_seed``).
    """
    return build_fct(
        conform.stg_load(raw_load),
        conform.stg_generation(raw_generation),
        conform.stg_price(raw_price),
        dims.dim_zone(spark),
        production_types if production_types is not None else dims.dim_production_type(spark),
        with_month=with_month,
    )

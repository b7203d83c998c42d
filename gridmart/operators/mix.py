"""Generation mix and storage draw per zone-hour, in one pass over generation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.dims import CATEGORIES

MIX_COLUMNS = [f"{c}_mw" for c in CATEGORIES] + ["total_generation_mw", "total_co2_kg"]


def _typed(stg_generation: DataFrame, dim_production_type: DataFrame) -> DataFrame:
    # Inner join: an unknown production type silently drops out. The dimension
    # has 36 rows by construction, so the broadcast is bounded.
    return stg_generation.join(F.broadcast(dim_production_type), "production_type", "inner")


def _mix_aggs(gen_only: Column) -> list[Column]:
    mw = F.col("generation_mw")
    aggs = [
        F.sum(F.when(gen_only, F.when(F.col("category") == c, mw).otherwise(F.lit(0.0)))).alias(f"{c}_mw")
        for c in CATEGORIES
    ]
    aggs.append(F.sum(F.when(gen_only, mw)).alias("total_generation_mw"))
    aggs.append(
        F.sum(F.when(gen_only, mw * F.col("emission_factor_kg_co2_mwh"))).alias("total_co2_kg")
    )
    return aggs


def mix_and_draw(stg_generation: DataFrame, dim_production_type: DataFrame) -> DataFrame:
    """Conditional sums by category plus storage draw, grouped once.

    A zone-hour with only consumption rows gets null mix columns; one without
    storage-consumption rows gets a null draw. The pattern
    ``sum(when(flow = generation, when(category = c, mw).otherwise(0)))`` has
    no outer ``otherwise`` so that both nulls survive, exactly as two separate
    filtered aggregations left-joined to load would give.
    """
    typed = _typed(stg_generation, dim_production_type)
    gen_only = F.col("flow_direction") == "generation"
    draw = (F.col("flow_direction") == "consumption") & (F.col("category") == "storage")
    return typed.groupBy("zone_code", "ts_hour_utc").agg(
        *_mix_aggs(gen_only),
        F.sum(F.when(draw, F.col("generation_mw"))).alias("storage_consumption_mw"),
    )


def generation_mix(stg_generation: DataFrame, dim_production_type: DataFrame) -> DataFrame:
    """Mix over generation flow only (zone-hours with generating rows)."""
    typed = _typed(stg_generation, dim_production_type).filter(
        F.col("flow_direction") == "generation"
    )
    return typed.groupBy("zone_code", "ts_hour_utc").agg(*_mix_aggs(F.lit(True)))


def storage_draw(stg_generation: DataFrame, dim_production_type: DataFrame) -> DataFrame:
    """Pumping / charging: consumption rows of storage types."""
    typed = _typed(stg_generation, dim_production_type).filter(
        (F.col("flow_direction") == "consumption") & (F.col("category") == "storage")
    )
    return typed.groupBy("zone_code", "ts_hour_utc").agg(
        F.sum("generation_mw").alias("storage_consumption_mw")
    )

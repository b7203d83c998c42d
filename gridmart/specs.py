"""Table schemas, contracts and the source registry.

One ``StructType`` per table; readers always pass it, nothing is inferred.
Spark does not enforce NOT NULL on parquet, so "required" lives in the
contract (``Contract.required``), not only in the declaration.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ZONE_PATTERN = r"^[A-Z]{2}(_[A-Z0-9]+)?$"
ALLOWED_RESOLUTIONS = (15, 60)
MIN_TS = "2020-01-01 00:00:00"


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


# Columns and types of the raw tables, the type dimension and the fact.
RAW_LOAD = T.StructType([
    _f("zone_code", T.StringType(), False),
    _f("ts_utc", T.TimestampType(), False),
    _f("resolution_minutes", T.LongType(), False),
    _f("load_mw", T.DoubleType()),
    _f("ingested_at", T.TimestampType(), False),
    _f("run_id", T.StringType(), False),
])

RAW_GENERATION = T.StructType([
    _f("zone_code", T.StringType(), False),
    _f("ts_utc", T.TimestampType(), False),
    _f("resolution_minutes", T.LongType(), False),
    _f("production_type", T.StringType(), False),
    _f("generation_mw", T.DoubleType()),
    _f("ingested_at", T.TimestampType(), False),
    _f("run_id", T.StringType(), False),
])

RAW_PRICE = T.StructType([
    _f("zone_code", T.StringType(), False),
    _f("ts_utc", T.TimestampType(), False),
    _f("resolution_minutes", T.LongType(), False),
    _f("price_eur_mwh", T.DoubleType()),
    _f("ingested_at", T.TimestampType(), False),
    _f("run_id", T.StringType(), False),
])

DIM_PRODUCTION_TYPE = T.StructType([
    _f("production_type", T.StringType(), False),
    _f("category", T.StringType()),
    _f("flow_direction", T.StringType()),
    _f("is_renewable", T.BooleanType()),
    _f("is_dispatchable", T.BooleanType()),
    _f("emission_factor_kg_co2_mwh", T.LongType()),
])

FCT_COLUMNS = [
    "zone_code", "ts_hour_utc", "date_local", "load_mw", "renewable_mw", "fossil_mw",
    "nuclear_mw", "storage_mw", "other_mw", "total_generation_mw", "storage_consumption_mw",
    "renewable_pct", "residual_load_mw", "carbon_intensity_g_kwh", "price_eur_mwh",
    "hour_utc", "day_of_week_local", "load_intervals_aggregated",
]

# Columns served by the page query (the rest stay in the mart).
SERVED_COLUMNS = [
    "zone_code", "ts_hour_utc", "date_local", "load_mw", "renewable_mw", "fossil_mw",
    "nuclear_mw", "total_generation_mw", "renewable_pct", "residual_load_mw",
    "carbon_intensity_g_kwh", "price_eur_mwh",
]


@dataclass(frozen=True)
class Contract:
    """Declared shape of a validated batch.

    ``columns`` maps name -> Spark type (coerced with try_cast); undeclared
    columns are dropped. ``required`` may not be null, ``measure`` must lie in
    the inclusive ``measure_range`` when present, ``key`` must be unique
    within a batch.
    """

    columns: dict[str, T.DataType]
    required: tuple[str, ...]
    key: tuple[str, ...]
    measure: str
    measure_range: tuple[float, float]
    resolutions: tuple[int, ...] = ALLOWED_RESOLUTIONS
    zone_pattern: str = ZONE_PATTERN


# Columns, required fields, ranges and resolutions of the three feeds.
_COMMON = {
    "zone_code": T.StringType(),
    "ts_utc": T.TimestampType(),
    "resolution_minutes": T.LongType(),
    "run_id": T.StringType(),
}

LOAD_CONTRACT = Contract(
    columns={**_COMMON, "load_mw": T.DoubleType()},
    required=("zone_code", "ts_utc", "resolution_minutes", "run_id"),
    key=("zone_code", "ts_utc"),
    measure="load_mw",
    measure_range=(0.0, 150_000.0),
)

GENERATION_CONTRACT = Contract(
    columns={**_COMMON, "production_type": T.StringType(), "generation_mw": T.DoubleType()},
    required=("zone_code", "ts_utc", "production_type", "resolution_minutes", "run_id"),
    key=("zone_code", "ts_utc", "production_type"),
    measure="generation_mw",
    measure_range=(0.0, 150_000.0),
)

PRICE_CONTRACT = Contract(
    columns={**_COMMON, "price_eur_mwh": T.DoubleType()},
    required=("zone_code", "ts_utc", "resolution_minutes", "run_id"),
    key=("zone_code", "ts_utc"),
    measure="price_eur_mwh",
    measure_range=(-500.0, 4_000.0),
)


@dataclass(frozen=True)
class SourceSpec:
    """One feed: its bronze schema, contract, revision key and table name."""

    name: str
    table: str
    schema: T.StructType
    contract: Contract
    cluster_by: tuple[str, ...] = field(default=("zone_code",))

    @property
    def key(self) -> tuple[str, ...]:
        return self.contract.key

    @property
    def measure(self) -> str:
        return self.contract.measure


SOURCES: dict[str, SourceSpec] = {
    "load": SourceSpec("load", "raw_load", RAW_LOAD, LOAD_CONTRACT),
    "generation": SourceSpec(
        "generation", "raw_generation", RAW_GENERATION, GENERATION_CONTRACT,
        cluster_by=("zone_code", "production_type"),
    ),
    "price": SourceSpec("price", "raw_day_ahead_price", RAW_PRICE, PRICE_CONTRACT),
}

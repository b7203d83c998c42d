"""Dimensions: bidding zones and production types.

Both are tiny, fixed relations (6 and 36 rows), so joining them with a
``broadcast`` hint is safe at any data volume: their size is bounded by
construction, not by the data.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession

from gridmart import specs

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results).
# Bidding zones: zone_code, zone_name, country, IANA timezone.
ZONES = [
    ("DE_LU", "Germany/Luxembourg", "DE", "Europe/Berlin"),
    ("AT", "Austria", "AT", "Europe/Vienna"),
    ("NL", "Netherlands", "NL", "Europe/Amsterdam"),
    ("FR", "France", "FR", "Europe/Paris"),
    ("DK_1", "Denmark West", "DK", "Europe/Copenhagen"),
    ("DK_2", "Denmark East", "DK", "Europe/Copenhagen"),
]

# Production types that generate: name, category, is_renewable,
# is_dispatchable, emission factor in kg CO2 per MWh.
GENERATION_TYPES = [
    ("Biomass", "renewable", True, True, 230),
    ("Energy storage", "storage", False, True, 0),
    ("Fossil Brown coal/Lignite", "fossil", False, True, 1050),
    ("Fossil Coal-derived gas", "fossil", False, True, 780),
    ("Fossil Gas", "fossil", False, True, 490),
    ("Fossil Hard coal", "fossil", False, True, 820),
    ("Fossil Oil", "fossil", False, True, 650),
    ("Geothermal", "renewable", True, True, 38),
    ("Hydro Pumped Storage", "storage", False, True, 0),
    ("Hydro Run-of-river and poundage", "renewable", True, False, 24),
    ("Hydro Water Reservoir", "renewable", True, True, 24),
    ("Nuclear", "nuclear", False, True, 12),
    ("Other", "other", False, True, 400),
    ("Other renewable", "renewable", True, False, 50),
    ("Solar", "renewable", True, False, 48),
    ("Waste", "other", False, True, 580),
    ("Wind Offshore", "renewable", True, False, 12),
    ("Wind Onshore", "renewable", True, False, 11),
]
# Every generating type also exists as "<type> Consumption": same category and
# dispatchable flag, flow_direction consumption, not renewable, factor 0.
CONSUMPTION_SUFFIX = " Consumption"
CATEGORIES = ["renewable", "fossil", "nuclear", "storage", "other"]
FLOW_DIRECTIONS = ["generation", "consumption"]
# ---------------------------------------------------------------------------


def production_type_rows() -> list[tuple]:
    rows = [(n, c, "generation", r, d, f) for n, c, r, d, f in GENERATION_TYPES]
    rows += [(n + CONSUMPTION_SUFFIX, c, "consumption", False, d, 0) for n, c, _, d, _ in GENERATION_TYPES]
    return rows


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dim_zone(spark: SparkSession) -> DataFrame:
    """Inline relation of the six zones (an array of structs, exploded).

    Written as one SQL expression: a single call to build, however many zones.
    """
    structs = ", ".join(
        "named_struct('zone_code', {}, 'zone_name', {}, 'country', {}, 'timezone', {})".format(
            *[_sql_text(v) for v in row]
        )
        for row in ZONES
    )
    return spark.range(1).selectExpr(f"inline(array({structs}))")


def dim_production_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(production_type_rows(), specs.DIM_PRODUCTION_TYPE)


def write_production_type_seed(spark: SparkSession, path: str) -> None:
    """Write the 36 rows as a headed CSV, in whatever store ``path`` lies."""
    dim_production_type(spark).coalesce(1).write.option("header", True).mode("overwrite").csv(path)


def read_production_type_seed(spark: SparkSession, path: str) -> DataFrame:
    """Seed CSV scan with header and a declared schema (never inferred)."""
    return spark.read.schema(specs.DIM_PRODUCTION_TYPE).option("header", True).csv(path)

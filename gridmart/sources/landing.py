"""Landed feed files: one scan per source covers every zone, day and run.

A feed client drops files under ``<landing>/<source>/`` in parquet, JSON or
CSV. Each row carries its batch key (zone_code, market_day, run_id); the
stamp ``ts`` is ISO-8601 text (with or without an offset) and is converted
to a UTC instant by ``gridmart.plans.ingest``. Schemas are declared, never
inferred: an all-integer price file must not become a LONG column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KEY = [
    T.StructField("zone_code", T.StringType()),
    T.StructField("market_day", T.DateType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("ts", T.StringType()),
]

LANDING_LOAD = T.StructType([*_KEY, T.StructField("load_mw", T.DoubleType())])
LANDING_PRICE = T.StructType([
    *_KEY,
    T.StructField("price_eur_mwh", T.DoubleType()),
    T.StructField("series_resolution", T.StringType()),
])
LANDING_GENERATION_TWO_LEVEL = T.StructType([
    *_KEY,
    T.StructField("name", T.StringType()),
    T.StructField("measure", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def landing_generation_wide(type_columns: Sequence[str]) -> T.StructType:
    """Wide generation landing: one DOUBLE column per (flattened) type name."""
    return T.StructType([*_KEY, *[T.StructField(c, T.DoubleType()) for c in type_columns]])


def read_landing(
    spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "parquet", base_path: str | None = None
) -> DataFrame:
    """Scan landed files of one source with a declared schema.

    ``path`` is a folder, or a list of files under ``base_path``.

    Text formats (CSV, JSON) read measures as strings: a permissive reader
    would turn a malformed number into null, and a null measure passes the
    contract. Kept as text, the contract's ``try_cast`` reports it as a type
    violation and rejects the batch.
    """
    if fmt in ("csv", "json"):
        schema = T.StructType([
            T.StructField(f.name, T.StringType(), f.nullable) if isinstance(f.dataType, T.DoubleType) else f
            for f in schema.fields
        ])
    reader = spark.read.schema(schema)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    if fmt == "csv":
        reader = reader.option("header", True).option("mode", "PERMISSIVE")
    elif fmt == "json":
        reader = reader.option("mode", "PERMISSIVE")
    return reader.format(fmt).load(path)

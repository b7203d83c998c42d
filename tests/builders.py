"""Small hand-made bronze / landing frames for the tests.

Instants are written as UTC text and cast on the executors, so the tests do
not depend on the local zone of the Python process.
"""

from pyspark.sql import functions as F

from gridmart.specs import RAW_GENERATION, RAW_LOAD, RAW_PRICE

_TS = ("ts_utc", "ingested_at")


def _frame(spark, schema, rows):
    names = schema.fieldNames()
    text = [tuple(str(v) if (n in _TS and v is not None) else v for n, v in zip(names, r)) for r in rows]
    str_schema = ", ".join(
        f"`{f.name}` string" if f.name in _TS else f"`{f.name}` {f.dataType.simpleString()}"
        for f in schema.fields
    )
    df = spark.createDataFrame(text, str_schema)
    return df.select(*[F.col(n).cast("timestamp").alias(n) if n in _TS else F.col(n) for n in names])


def load(spark, rows):
    """rows: (zone, ts_utc, resolution, load_mw, ingested_at, run_id)"""
    return _frame(spark, RAW_LOAD, rows)


def generation(spark, rows):
    """rows: (zone, ts_utc, resolution, production_type, generation_mw, ingested_at, run_id)"""
    return _frame(spark, RAW_GENERATION, rows)


def price(spark, rows):
    """rows: (zone, ts_utc, resolution, price_eur_mwh, ingested_at, run_id)"""
    return _frame(spark, RAW_PRICE, rows)


def empty_generation(spark):
    return generation(spark, []).limit(0)


def empty_price(spark):
    return price(spark, []).limit(0)


def collect_dicts(df, order):
    return [r.asDict() for r in df.orderBy(*order).collect()]

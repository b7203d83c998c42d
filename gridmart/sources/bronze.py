"""Bronze layer: append-only, month-partitioned, revision-keeping parquet.

Layout: ``<root>/<table>/ts_month=YYYY-MM-01/part-*.parquet``; inside each
file rows are sorted by (cluster columns, ts_utc) so parquet row-group
statistics skip by zone (and type) inside a month. Appends never rewrite: a
replay adds a new revision, resolved at read time.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.functions.time import month_key
from gridmart.specs import SourceSpec


class UnboundedScanError(ValueError):
    """A bronze scan without a lower time bound would read every month."""


def table_path(root: str, spec: SourceSpec) -> str:
    return f"{root.rstrip('/')}/{spec.table}"


def stored_schema(spec: SourceSpec) -> T.StructType:
    return T.StructType(list(spec.schema.fields) + [T.StructField("ts_month", T.DateType(), True)])


def instant_text(at: datetime) -> str:
    """ISO text with an offset; an instant without one is UTC."""
    return at.isoformat() if at.tzinfo else at.isoformat() + "+00:00"


def to_bronze_rows(df: DataFrame, spec: SourceSpec, ingested_at: datetime | None = None) -> DataFrame:
    """Project the table's columns with their declared types (never inferred).

    ``ingested_at``: one driver-side instant stamped on every row of the
    write, so a task retry writes the same value. ``None`` keeps the frame's
    own ``ingested_at`` (replaying recorded revisions).
    """
    cols = []
    for f in spec.schema.fields:
        if f.name == "ingested_at" and ingested_at is not None:
            cols.append(F.lit(instant_text(ingested_at)).cast("timestamp").alias("ingested_at"))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    rows = df.select(*cols)
    return rows.withColumn("ts_month", month_key("ts_utc"))


def write_bronze(
    df: DataFrame, root: str, spec: SourceSpec, ingested_at: datetime | None = None
) -> int:
    """Append validated rows; returns the row count (0 writes nothing).

    The count comes from an ``Observation`` on the write itself, so the data
    is computed once.

    Rows are rebalanced by (month, zone): a group goes to one task, adaptive
    execution splits the tasks that are too large (a hot zone-month) and merges
    small ones. So the number of files follows the size of the data, not
    tasks x months, and a file spans few zones.
    """
    rows = to_bronze_rows(df, spec, ingested_at)
    layout = rows.hint("rebalance", "ts_month", "zone_code").sortWithinPartitions(
        "ts_month", *spec.cluster_by, "ts_utc"
    )
    obs = Observation(f"bronze_{spec.table}")
    layout = layout.observe(obs, F.count(F.lit(1)).alias("rows"))
    layout.write.mode("append").partitionBy("ts_month").parquet(table_path(root, spec))
    return int(obs.get.get("rows", 0) or 0)


def _missing(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def path_exists(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Whether a table folder exists (resolving a scan checks it; nothing is read)."""
    try:
        spark.read.schema(schema).parquet(path)
        return True
    except AnalysisException as exc:
        if _missing(exc):
            return False
        raise


def ensure_table(spark: SparkSession, root: str, spec: SourceSpec) -> None:
    """Create the table folder (no rows) if it has never been appended to."""
    path, schema = table_path(root, spec), stored_schema(spec)
    if not path_exists(spark, path, schema):
        spark.createDataFrame([], schema).write.mode("append").partitionBy("ts_month").parquet(path)


def _scan(spark: SparkSession, root: str, spec: SourceSpec) -> DataFrame:
    """The table, or an empty frame of its schema before its first append."""
    schema = stored_schema(spec)
    try:
        return spark.read.schema(schema).parquet(table_path(root, spec))
    except AnalysisException as exc:
        if not _missing(exc):
            raise
    return spark.createDataFrame([], schema)


def _ts_text(value: date | datetime | str) -> str:
    if isinstance(value, datetime):
        return instant_text(value)
    return str(value)


def read_bronze(
    spark: SparkSession,
    root: str,
    spec: SourceSpec,
    start: date | datetime | str | None,
    end: date | datetime | str | None = None,
) -> DataFrame:
    """Scan one bronze table from ``start`` (inclusive) to ``end`` (exclusive).

    ``start`` is mandatory: an unbounded scan is refused. Spark does not
    derive a ``ts_month`` predicate from a ``ts_utc`` one, so both are added:
    the month predicate prunes directories, the instant predicate is pushed
    into the parquet reader.
    """
    if start is None:
        raise UnboundedScanError(f"{spec.table}: a start bound is required")
    lo = F.lit(_ts_text(start)).cast("timestamp")
    df = _scan(spark, root, spec)
    cond = (F.col("ts_month") >= month_key(lo)) & (F.col("ts_utc") >= lo)
    if end is not None:
        hi = F.lit(_ts_text(end)).cast("timestamp")
        cond = cond & (F.col("ts_month") <= month_key(hi)) & (F.col("ts_utc") < hi)
    return df.filter(cond)


def read_bronze_months(
    spark: SparkSession, root: str, spec: SourceSpec, months: list[date]
) -> DataFrame:
    """All revisions of the listed months (partition filter only)."""
    df = _scan(spark, root, spec)
    return df.filter(F.col("ts_month").isin(*[F.lit(m.isoformat()).cast("date") for m in months]))

"""Landed files against their declared schema, before they are scanned.

A scan with a declared schema turns a column that a file lacks into nulls, fails the
whole job on a Parquet column of another type, and cuts a torn text line into nulls.
Here every file gets a verdict first, in one distributed pass:

- Parquet: the footer alone leaves the reader (its length stands in the file's last
  bytes), and its columns are compared with the declaration;
- CSV, which is read by position: the header line must list the declared columns and no
  others in their order, and every line must have as many fields;
- JSON lines: every line must parse, and every key column must occur in some line (a
  measure may be absent, as writers leave nulls out).

Columns that a partition folder names (``market_day=...``) count as there.
A malformed *value* is no matter of the file: the batch contract judges it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TORN = "_torn"
#: Arrow types that a Parquet column of a declared type may have.
_FITS = {
    T.StringType: (pa.types.is_string, pa.types.is_large_string),
    T.DoubleType: (pa.types.is_float64, pa.types.is_float32),
    T.DateType: (pa.types.is_date,),
    T.LongType: (pa.types.is_integer,),
    T.TimestampType: (pa.types.is_timestamp,),
}


def _in_path(file: Column, column: str) -> Column:
    return F.contains(file, F.lit(f"/{column}="))


def _all(conditions: list[Column]) -> Column:
    """The texts that are not null, joined; null if there is none."""
    return F.nullif(F.concat_ws("; ", *conditions), F.lit(""))


def _parquet_verdicts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    content, size = F.col("content"), F.length("content")
    length = F.conv(F.concat(*[F.hex(F.substring(content, size - 4 - k, F.lit(1))) for k in range(4)]), 16, 10).cast("long")
    framed = (size >= 12) & (F.substring(content, size - 3, F.lit(4)) == F.lit(b"PAR1")) & (length <= size - 12)
    footer = F.when(framed, F.substring(content, (size - 7 - length).cast("int"), (length + 8).cast("int")))
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), footer.alias("footer"))
    fields = [(f.name, _FITS[type(f.dataType)]) for f in schema.fields]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reasons, rows = [], []
            for file, tail in zip(*(c.to_pylist() for c in b.columns)):
                try:
                    meta = pq.read_metadata(pa.BufferReader(b"PAR1" + tail)) if tail else None
                except pa.ArrowException:
                    meta = None
                found = {} if meta is None else {f.name: f.type for f in meta.schema.to_arrow_schema()}
                wrong = [] if meta is not None else ["no Parquet file"]
                for name, fits in fields if meta is not None else ():
                    if name in found:
                        if not any(fit(found[name]) for fit in fits):
                            wrong.append(f"wrong type: {name} is {found[name]}")
                    elif f"/{name}=" not in file:
                        wrong.append(f"missing column: {name}")
                reasons.append("; ".join(wrong) or None)
                rows.append(0 if meta is None else meta.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(rows, pa.int64()), pa.array(reasons, pa.string())], names=["file", "rows", "reason"])

    return files.mapInArrow(judge, "file string, rows long, reason string")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _csv_verdicts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    lines = _lines(spark, path).withColumn("at", F.monotonically_increasing_id())
    # The first block of a file is read by one task, in order.
    per_file = lines.groupBy("file").agg(
        F.min_by("value", F.when(F.col("block") == 0, F.col("at"))).alias("header"),
        F.count_if(F.col("value") != "").alias("n"),
        *[F.count_if((F.col("value") != "") & _torn_csv(schema, k)).alias(f"torn{k}") for k in _widths(schema)])
    named = F.transform(F.split("header", ","), lambda c: F.btrim(c, F.lit(' "\r')))
    declared = F.array_compact(F.array(*[F.when(~_in_path(F.col("file"), f.name), F.lit(f.name)) for f in schema.fields]))
    missing, extra = F.array_except(declared, named), F.array_except(named, declared)
    torn = reduce(lambda c, k: F.when(F.size(declared) == k, F.col(f"torn{k}")).otherwise(c), _widths(schema), F.lit(0))
    reason = _all([
        F.when(F.size(missing) > 0, F.concat(F.lit("missing column: "), F.array_join(missing, ", "))),
        F.when(F.size(extra) > 0, F.concat(F.lit("undeclared column: "), F.array_join(extra, ", "))),
        F.when((F.size(missing) == 0) & (F.size(extra) == 0) & (named != declared), F.lit("columns in another order")),
        F.when((F.size(missing) == 0) & (F.size(extra) == 0) & (torn > 0), F.concat(F.lit("torn lines: "), torn.cast("string"))),
    ])
    return per_file.select("file", (F.col("n") - 1).cast("long").alias("rows"), reason.alias("reason"))


def _widths(schema: T.StructType) -> list[int]:
    """Numbers of columns that a file may have: one less if a folder names a column."""
    return [len(schema), len(schema) - 1]


def _torn_csv(schema: T.StructType, width: int) -> Column:
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)] + [T.StructField(_TORN, T.StringType())])
    return F.from_csv("value", text.simpleString()[7:-1].replace(":", " "),
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _TORN})[_TORN].isNotNull()


def _json_verdicts(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_TORN, T.StringType())])
    lines = _lines(spark, path).where(F.btrim("value") != "").withColumn("row", F.from_json(
        "value", text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _TORN}))
    per_file = lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(f"row.{_TORN}").isNotNull()).alias("torn"),
        *[F.count_if(F.array_contains(F.json_object_keys("value"), k)).alias(f"has_{k}") for k in keys])
    lost = F.array_compact(F.array(*[
        F.when((F.col(f"has_{k}") == 0) & ~_in_path(F.col("file"), k), F.lit(k)) for k in keys]))
    reason = _all([
        F.when(F.size(lost) > 0, F.concat(F.lit("missing column: "), F.array_join(lost, ", "))),
        F.when(F.col("torn") > 0, F.concat(F.lit("torn lines: "), F.col("torn").cast("string"))),
    ])
    return per_file.select("file", "rows", reason.alias("reason"))


def file_verdicts(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """``file, rows, reason`` of every landed file; the reason is null if the file fits ``schema``.

    Empty text files have no lines and no verdict: they hold nothing to lose.
    """
    if fmt == "parquet":
        return _parquet_verdicts(spark, path, schema)
    if fmt == "csv":
        return _csv_verdicts(spark, path, schema)
    if fmt == "json":
        return _json_verdicts(spark, path, schema, [f.name for f in schema.fields if not isinstance(f.dataType, T.DoubleType)])
    raise ValueError(f"unknown format {fmt!r}")

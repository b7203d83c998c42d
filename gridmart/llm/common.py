"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import json
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: ASCII white space and its complement, as used by every word contract here.
WS_CHARS = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    Catalyst inlines a projected column into every place of a higher-order
    function that names it, so an array used per element would be rebuilt per
    element. A lambda variable over a one-element array is bound once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """White-space separated words; null counts as the empty text."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN), F.lit(0))


def bucketed(table: dict[str, object], count: int) -> str:
    """JSON of an array of ``count`` (a power of two) maps; a key stands in the map of its XXH64's
    low bits, as Spark computes it. As a literal it is a table that is looked up by a few entries."""
    out: list[dict] = [{} for _ in range(count)]
    for key, value in table.items():
        out[xxhash.xxh64_intdigest(key.encode("utf-8"), 42) & (count - 1)][key] = value
    return json.dumps(out)


def bucket_lookup(table: Column, key: Column, count: int) -> Column:
    at = F.xxhash64(key).bitwiseAND(F.lit(count - 1).cast("long"))
    return F.element_at(F.get(table, at.cast("int")), key)


def one_per_key(rows: DataFrame, make: Callable[[pa.RecordBatch], list[tuple]], key: str, schema: T.StructType) -> DataFrame:
    """One row of each key: ``make`` gives the rows of ``schema`` for a batch's rows.

    The row with the least ``__mark`` (a long of ``rows``) stands for its key, in each
    task first, so that a key with a third of all rows costs one row per task.
    ``rows`` are those of a bounded number of keys.
    """
    out = T.StructType([T.StructField("__key", rows.schema[key].dataType), T.StructField("__mark", T.LongType()), *schema])

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for b in batches:
            at: dict = {}
            for i, (k, mark) in enumerate(zip(b.column(key).to_pylist(), b.column("__mark").to_pylist())):
                known = best.get(k)
                if known is None or mark < known[0]:
                    best[k] = (mark, None)
                    at[k] = i
            if at:
                for k, row in zip(at, make(b.take(list(at.values())))):
                    best[k] = (best[k][0], row)
        if best:
            columns = [list(best), [v[0] for v in best.values()], *zip(*[v[1] for v in best.values()])]
            kinds = to_arrow_schema(out)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], names=out.names)

    first = F.min_by(F.struct(*schema.names), F.col("__mark")).alias("row")
    return rows.mapInArrow(least, out).groupBy("__key").agg(first).select("row.*")


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Bound the bytes of an Arrow batch for the session, so that a worker's memory follows bytes, not rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).lower()
    if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= size:
        spark.conf.set(name, str(size))


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which all executors share.

    It is read from the session (``spark.checkpoint.dir``); one of our own is
    made only for a local master with none set, as in tests.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="llm-checkpoint-")
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


#: Folders of written tables that are still there: path -> what deletes it.
_WRITTEN: dict[str, Callable[[], object]] = {}


def _to_delete(spark: SparkSession, path: str) -> str:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    _WRITTEN[path] = lambda: files.delete(target, True)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, partition by partition: losing an executor costs
    only its running tasks. The files live as long as those of ``staged``."""
    shared_folder(df.sparkSession)
    out = df.checkpoint(eager=True)
    files = out._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if files.isDefined():
        out._staged = _to_delete(df.sparkSession, files.get())
    return out


def staged(df: DataFrame) -> DataFrame:
    """``df``, written in the shared folder and read back: the cut of a plan.

    The table lives until ``release`` or, as a lazy result may still read it,
    until the driver's process ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex[:12]}"
    _to_delete(spark, path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that ``staged`` or ``checkpointed`` wrote, after their last read."""
    for t in tables:
        delete = _WRITTEN.pop(getattr(t, "_staged", ""), None)
        if delete is not None:
            delete()


@atexit.register
def _release_rest() -> None:
    for path in list(_WRITTEN):
        with contextlib.suppress(Exception):  # the JVM may be gone already
            _WRITTEN.pop(path)()

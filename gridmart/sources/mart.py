"""Mart tables: the hourly fact, in immutable versions of months behind a pointer.

Layout::

    <mart>/data/version=<number>-<id>/ts_month=YYYY-MM-01/part-*.parquet
    <mart>/_versions/<number>.json        month -> version, one file per publish

A publish writes new month folders beside the old ones and then one pointer file,
by a rename to a name that was not there. A reader takes the last pointer once, when its plan is
made, and reads the folders it names; so it sees the mart before or after a
publish and never a part of one. ``vacuum`` deletes the folders that the last few
pointers no longer name. One job publishes to a mart at a time; a second one that
takes the same number fails instead of losing the first one's months.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart import session
from gridmart.functions.time import month_key
from gridmart.specs import FCT_COLUMNS

FCT_SCHEMA = T.StructType([
    T.StructField("zone_code", T.StringType()),
    T.StructField("ts_hour_utc", T.TimestampType()),
    T.StructField("date_local", T.DateType()),
    *[T.StructField(c, T.DoubleType()) for c in FCT_COLUMNS[3:15]],
    T.StructField("hour_utc", T.LongType()),
    T.StructField("day_of_week_local", T.LongType()),
    T.StructField("load_intervals_aggregated", T.LongType()),
    T.StructField("ts_month", T.DateType()),
])
_STORED = T.StructType([*FCT_SCHEMA.fields, T.StructField("version", T.StringType())])

#: Pointers whose folders ``vacuum`` keeps: a reader may lag this many publishes less one.
KEEP_VERSIONS = 2


def write_fct(fct_with_month: DataFrame, path: str) -> None:
    """Write the fact to a new folder, partitioned by month, sorted by zone then hour.

    One write task per (month, zone) group: the fact holds at most 744 rows
    for a zone-month, so the key is bounded and needs no range sampling.
    """
    out = fct_with_month.repartition("ts_month", "zone_code").sortWithinPartitions(
        "ts_month", "zone_code", "ts_hour_utc")
    out.write.mode("errorifexists").partitionBy("ts_month").parquet(path)


def _pointers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, rising (``vacuum`` keeps them few)."""
    names = session.list_names(spark, f"{path}/_versions")
    return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def _named(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    return json.loads(session.read_text(spark, f"{path}/_versions/{number:08d}.json"))


def published(spark: SparkSession, path: str) -> dict[str, str]:
    """Month (ISO text) -> version of the last publish; empty before the first."""
    numbers = _pointers(spark, path)
    return _named(spark, path, numbers[-1]) if numbers else {}


def new_version(spark: SparkSession, path: str) -> str:
    """Name of the next version; nothing is written."""
    return f"{max(_pointers(spark, path), default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"


def version_path(path: str, version: str) -> str:
    return f"{path}/data/version={version}"


def commit(spark: SparkSession, path: str, version: str, present: Iterable[date], replaced: Iterable[date] | None) -> None:
    """Point to ``version`` for the months ``present`` in it.

    ``replaced`` months without rows are left out from now on; with None the
    version stands for the whole mart.
    """
    months = {} if replaced is None else published(spark, path)
    for m in replaced or ():
        months.pop(m.isoformat(), None)
    months |= {m.isoformat(): version for m in present}
    number = int(version.split("-")[0])
    session.write_new_text(spark, f"{path}/_versions/{number:08d}.json", json.dumps(months, sort_keys=True))


def vacuum(spark: SparkSession, path: str, keep: int = KEEP_VERSIONS) -> list[str]:
    """Delete what the last ``keep`` pointers do not name; returns the deleted folders.

    Folders of a version that is not published yet (a higher number) stay.
    """
    numbers = _pointers(spark, path)
    if not numbers:
        return []
    named = {(v, m) for n in numbers[-keep:] for m, v in _named(spark, path, n).items()}
    gone = []
    for folder in session.list_names(spark, f"{path}/data"):
        version = folder.removeprefix("version=")
        if int(version.split("-")[0]) > numbers[-1]:
            continue
        inside = [n for n in session.list_names(spark, f"{path}/data/{folder}") if n.startswith("ts_month=")]
        dead = [n for n in inside if (version, n.removeprefix("ts_month=")) not in named]
        targets = [folder] if len(dead) == len(inside) else [f"{folder}/{n}" for n in dead]
        for t in targets:
            session.delete_path(spark, f"{path}/data/{t}")
            gone.append(t)
    for n in numbers[:-keep]:
        session.delete_path(spark, f"{path}/_versions/{n:08d}.json")
    return gone


def read_months(spark: SparkSession, path: str, months: dict[str, str]) -> DataFrame:
    """The fact of the given month -> version folders; without any an empty frame."""
    if not months:
        return spark.createDataFrame([], FCT_SCHEMA)
    folders = [f"{version_path(path, v)}/ts_month={m}" for m, v in sorted(months.items())]
    return (spark.read.schema(_STORED).option("basePath", f"{path}/data").parquet(*folders)
            .select(*FCT_SCHEMA.fieldNames()))


def read_fct(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Fact scan of the mart as published when the plan is made.

    A time range leaves out the folders of other months, and adds month (partition)
    and hour (pushed) predicates.
    """
    months = published(spark, path)
    lo, hi = (None if t is None else _iso(t) for t in (start, end))
    first, last = (None if t is None else _month(t) for t in (start, end))
    months = {m: v for m, v in months.items() if (first is None or m >= first) and (last is None or m <= last)}
    df = read_months(spark, path, months)
    if lo is not None:
        lo = F.lit(lo).cast("timestamp")
        df = df.filter((F.col("ts_month") >= month_key(lo)) & (F.col("ts_hour_utc") >= lo))
    if hi is not None:
        hi = F.lit(hi).cast("timestamp")
        df = df.filter((F.col("ts_month") <= month_key(hi)) & (F.col("ts_hour_utc") < hi))
    return df


def _iso(ts: datetime) -> str:
    return ts.isoformat() if ts.tzinfo else ts.isoformat() + "+00:00"


def _month(ts: datetime) -> str:
    """ISO text of the UTC month an instant lies in."""
    utc = ts.astimezone(UTC) if ts.tzinfo else ts
    return date(utc.year, utc.month, 1).isoformat()

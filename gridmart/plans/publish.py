"""Gated publish: write a new version, run the checks on it, only then point to it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from gridmart import dims, session
from gridmart.operators import checks
from gridmart.sources import mart


def publish_fct(
    spark: SparkSession, fct_with_month: DataFrame, mart_path: str, months: Sequence[date] | None = None
) -> DataFrame:
    """Publish the whole fact, or the fact of the given ``months``.

    The fact is written once, as month folders that no reader knows yet (which also
    cuts its lineage). The 14 data tests run against these files. If all pass,
    one pointer file makes them the mart; a failing check deletes them and raises,
    and the mart stays as it was. Readers see the mart before or after, at any moment.

    Without ``months`` the version stands for the whole mart; an empty one is refused,
    as it passes every check. With ``months`` those months alone are replaced,
    and a month that has no rows left is gone. Returns the check results.
    """
    version = mart.new_version(spark, mart_path)
    path = mart.version_path(mart_path, version)
    try:
        mart.write_fct(fct_with_month, path)
        candidate = spark.read.schema(mart.FCT_SCHEMA).parquet(path)
        results = checks.data_tests(candidate, dims.dim_zone(spark), dims.dim_production_type(spark))
        rows = results.collect()  # one row per check
        failed = [r["check_name"] for r in rows if not r["passed"]]
        if failed:
            raise checks.CheckFailed(f"not published, failing checks: {failed}")
        # Month folders that were written: bounded by the calendar.
        present = {date.fromisoformat(n.removeprefix("ts_month="))
                   for n in session.list_names(spark, path) if n.startswith("ts_month=")}
        if months is None and not present:
            raise checks.CheckFailed("not published: a full rebuild without any row")
        mart.commit(spark, mart_path, version, present, months)
    except BaseException:
        session.delete_path(spark, path)
        raise
    mart.vacuum(spark, mart_path)
    return spark.createDataFrame(rows, results.schema)

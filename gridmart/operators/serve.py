"""Serving: the zone list and a keyset-paged read of the hourly fact."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridmart.functions.text import cursor_expr, decode_cursor
from gridmart.specs import SERVED_COLUMNS, ZONE_PATTERN

DEFAULT_LIMIT, MAX_LIMIT = 168, 1000
DEFAULT_SPAN = timedelta(days=7)


def zone_list(dim_zone: DataFrame, fct: DataFrame | None = None) -> DataFrame:
    """Zones ordered by code; with a fact, also its hour coverage per zone.

    The coverage is a grouped aggregate (six groups after a map-side combine)
    joined to the six-row dimension.
    """
    zones = dim_zone.select("zone_code", "zone_name", "country", "timezone")
    if fct is not None:
        cov = fct.groupBy("zone_code").agg(
            F.count(F.lit(1)).alias("fact_hours"),
            F.min("ts_hour_utc").alias("first_hour_utc"),
            F.max("ts_hour_utc").alias("last_hour_utc"),
        )
        zones = zones.join(cov, "zone_code", "left").withColumn(
            "fact_hours", F.coalesce(F.col("fact_hours"), F.lit(0)).cast("bigint")
        )
    return zones.orderBy("zone_code")


@dataclass(frozen=True)
class PageRequest:
    zone: str
    start: datetime
    end: datetime
    limit: int = DEFAULT_LIMIT
    after: datetime | None = None

    @classmethod
    def make(
        cls,
        zone: str,
        start: datetime | None = None,
        end: datetime | None = None,
        limit: int = DEFAULT_LIMIT,
        cursor: str | None = None,
        now: datetime | None = None,
    ) -> PageRequest:
        """Validate before any planning. Instants must be UTC-aware or naive UTC."""
        if not re.match(ZONE_PATTERN, zone or ""):
            raise ValueError(f"invalid zone code: {zone!r}")
        if not 1 <= int(limit) <= MAX_LIMIT:
            raise ValueError(f"limit must be in [1, {MAX_LIMIT}]")
        end = _utc(end) if end else _utc(now or datetime.now(UTC))
        start = _utc(start) if start else end - DEFAULT_SPAN
        if start >= end:
            raise ValueError("start must be before end")
        return cls(zone, start, end, int(limit), decode_cursor(cursor))


def _utc(ts: datetime) -> datetime:
    return ts.replace(tzinfo=UTC) if ts.tzinfo is None else ts.astimezone(UTC)


def _lit_ts(ts: datetime):
    # ISO text with an explicit offset: independent of the driver's local zone.
    return F.lit(ts.astimezone(UTC).isoformat()).cast("timestamp")


def page_frame(fct: DataFrame, req: PageRequest) -> DataFrame:
    """Filter -> order by hour -> limit: plans as TakeOrderedAndProject.

    Adds ``page_count`` and ``next_cursor`` (set only when the page is full,
    so an exactly-full last page points at an empty one). Both are window
    values over the at most ``limit`` rows of the page, never the table.
    """
    cond = (
        (F.col("zone_code") == F.lit(req.zone))
        & (F.col("ts_hour_utc") >= _lit_ts(req.start))
        & (F.col("ts_hour_utc") < _lit_ts(req.end))
    )
    if req.after is not None:
        cond = cond & (F.col("ts_hour_utc") > _lit_ts(req.after))
    page = fct.filter(cond).select(*SERVED_COLUMNS).orderBy("ts_hour_utc").limit(req.limit)
    whole = Window.partitionBy()
    n = F.count(F.lit(1)).over(whole)
    return page.select(
        "*",
        n.cast("bigint").alias("page_count"),
        F.when(n == F.lit(req.limit), cursor_expr(F.max("ts_hour_utc").over(whole))).alias("next_cursor"),
    )


class ResponseContractError(ValueError):
    """A served row breaks the response contract (share outside [0, 100])."""


def hourly_page(fct: DataFrame, req: PageRequest) -> tuple[list, str | None]:
    """Collect one page (at most 1000 rows) and its next cursor.

    The response contract is checked on the collected rows (bounded by the
    limit): a renewable share outside [0, 100] is refused, not served.
    """
    got = page_frame(fct, req).collect()
    for r in got:
        pct = r["renewable_pct"]
        if pct is not None and not 0 <= pct <= 100:
            raise ResponseContractError(f"renewable_pct {pct} at {r['ts_hour_utc']}")
    nxt = got[0]["next_cursor"] if got else None
    return [r.asDict() for r in got], nxt

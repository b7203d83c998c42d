"""Time expressions. The session zone is UTC (see ``gridmart.session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The market day is a Berlin calendar day for every zone.
BERLIN = "Europe/Berlin"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_floor(ts: Column | str) -> Column:
    """``timestamp_trunc(ts, hour)``: the UTC hour bucket."""
    return F.date_trunc("hour", _c(ts))


def month_key(ts: Column | str) -> Column:
    """Month partition key as a DATE (first day of the UTC month)."""
    return F.to_date(F.date_trunc("month", _c(ts)))


def local_date(ts: Column | str, tz: Column | str) -> Column:
    """Calendar date of a UTC instant in a zone given by a column or literal."""
    zone = F.lit(tz) if isinstance(tz, str) and "/" in tz else _c(tz)
    return F.to_date(F.from_utc_timestamp(_c(ts), zone))


def local_day_of_week(ts: Column | str, tz: Column | str) -> Column:
    """Day of week of the local time, 1 = Sunday ... 7 = Saturday, as BIGINT."""
    zone = F.lit(tz) if isinstance(tz, str) and "/" in tz else _c(tz)
    return F.dayofweek(F.from_utc_timestamp(_c(ts), zone)).cast("bigint")


def market_day(ts: Column | str) -> Column:
    """Berlin market day an instant belongs to."""
    return local_date(ts, BERLIN)


def market_window_start(day: Column | str) -> Column:
    """Local midnight of the market day, as a UTC instant."""
    return F.to_utc_timestamp(F.to_timestamp(_c(day)), F.lit(BERLIN))


def market_window_end(day: Column | str) -> Column:
    """Next local midnight, as a UTC instant (23, 24 or 25 hours later)."""
    return F.to_utc_timestamp(F.to_timestamp(F.date_add(_c(day), 1)), F.lit(BERLIN))


def whole_minutes(micros: Column | str) -> Column:
    """Whole minutes in a duration given in microseconds (integer floor)."""
    return F.floor(_c(micros) / F.lit(60_000_000)).cast("bigint")


def parse_instant(text: Column | str) -> Column:
    """ISO-8601 text to a UTC instant.

    Text with an offset is converted; text without one is taken as UTC (the
    session zone). Unparseable text gives null, which the contract reports.
    """
    return F.try_to_timestamp(_c(text))

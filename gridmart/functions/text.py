"""Text helpers: comma lists, zone pattern, page cursors."""

from __future__ import annotations

import base64
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def csv_list(text: Column) -> Column:
    """``"DE_LU, AT ,NL"`` -> ``["DE_LU", "AT", "NL"]``: split, trim, drop empties."""
    items = F.transform(F.split(text, ","), lambda s: F.trim(s))
    return F.filter(items, lambda s: s != F.lit(""))


def encode_cursor(ts: datetime) -> str:
    """URL-safe base64 of the ISO text of a UTC instant."""
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=UTC)
    return base64.urlsafe_b64encode(ts.astimezone(UTC).isoformat().encode()).decode()


class CursorError(ValueError):
    """A page token that no page of ours gave out."""


def decode_cursor(cursor: str | None) -> datetime | None:
    """The instant in a page token; no token (or an empty one) means the first page."""
    if cursor is None or cursor == "":
        return None
    try:
        text = base64.b64decode(cursor, altchars=b"-_", validate=True).decode("ascii")
        instant = datetime.fromisoformat(text)
    except (ValueError, UnicodeError) as exc:
        raise CursorError(f"not a page token: {cursor!r}") from exc
    return instant.replace(tzinfo=instant.tzinfo or UTC)


def cursor_expr(ts: Column) -> Column:
    """The same cursor computed on executors: ISO text, base64, URL-safe alphabet.

    Spark's ``base64`` wraps lines at 76 characters; an ISO instant is 25.
    """
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    return F.translate(F.base64(F.encode(iso, "UTF-8")), "+/", "-_")

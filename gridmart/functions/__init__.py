"""Column-expression helpers. All are built-in Spark expressions (no UDFs)."""

from gridmart.functions.numeric import round_half_away, settle_doubles
from gridmart.functions.text import csv_list, decode_cursor, encode_cursor, cursor_expr
from gridmart.functions.time import (
    BERLIN,
    hour_floor,
    local_date,
    local_day_of_week,
    market_day,
    market_window_end,
    market_window_start,
    month_key,
    parse_instant,
    whole_minutes,
)

__all__ = [
    "BERLIN", "csv_list", "cursor_expr", "decode_cursor", "encode_cursor", "hour_floor",
    "local_date", "local_day_of_week", "market_day", "market_window_end", "market_window_start",
    "month_key", "parse_instant", "round_half_away", "settle_doubles",
    "whole_minutes",
]

"""gridmart: hourly electricity-market analytics on Spark.

Landed load / generation / day-ahead-price feeds are validated per batch,
appended to a month-partitioned, revision-keeping bronze layer, conformed to
hourly and joined into a zone x hour fact table, checked, and served through a
keyset-paged query. Everything is DataFrame / SQL built-ins.
"""

__all__ = ["session", "specs", "dims"]

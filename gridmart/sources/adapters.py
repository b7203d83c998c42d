"""Bronze-shaped feeds derived from the driver's ``events`` table.

The test data has no electricity feeds, so load, generation and price are
derived from ``events`` by fixed rules (same definition in the DuckDB oracles):
the user picks the zone and the resolution, the event time the interval, the
value the measure. Every event is a row of all three feeds, so all work grows
with the table. An ingest run is one user's rows of one zone and market day:
users grow with the table, and so do the runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart import session
from gridmart.functions.time import market_day

# ---------------------------------------------------------------------------
# Fixed values of the adapter.
# user_id % 6 -> zone code.
ZONE_BY_USER_MOD6 = ["DE_LU", "AT", "NL", "FR", "DK_1", "DK_2"]
# event_type -> production type of the generation feed.
TYPE_BY_EVENT = {
    "error": "Fossil Gas",
    "click": "Solar",
    "view": "Nuclear",
    "signup": "Hydro Pumped Storage",
    "purchase": "Hydro Pumped Storage Consumption",
}
# Measure rules, keyed on event_id.
LOAD_NULL_MOD = 11       # event_id % 11 = 0 carries a null load (a retraction)
MW_PER_VALUE = 600.0
PRICE_SCALE, PRICE_SHIFT = 10.0, 100.0
BAD_RESOLUTION_MOD = 997  # contract variant: event_id % 997 = 0 reports 30 minutes
BAD_NUMBER_MOD = 499      # contract variant: event_id % 499 = 0 reports BAD_NUMBER as its measure
BAD_NUMBER = "n/e"
# ---------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


ZONE_SQL = "CASE user_id % 6 " + " ".join(
    f"WHEN {i} THEN {_q(z)}" for i, z in enumerate(ZONE_BY_USER_MOD6)
) + " END"
TYPE_SQL = "CASE event_type " + " ".join(f"WHEN {_q(e)} THEN {_q(t)}" for e, t in TYPE_BY_EVENT.items()) + " END"
RESOLUTION_SQL = "CAST(CASE WHEN user_id % 2 = 0 THEN 15 ELSE 60 END AS BIGINT)"
# Interval start: epoch seconds floored to the resolution (900 s or 3600 s).
SLOT_SQL = (
    "timestamp_seconds(unix_seconds(ts) div CASE WHEN user_id % 2 = 0 THEN 900 ELSE 3600 END "
    "* CASE WHEN user_id % 2 = 0 THEN 900 ELSE 3600 END)"
)


EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
_EVENTS: dict[tuple[str, str], DataFrame] = {}


def events(spark: SparkSession, sf_dir: str, months: int = 1) -> DataFrame:
    """``events`` with ``ts`` as a UTC instant (parquet stores it zone-less).

    Read with a declared schema (no footer sampling); the scan definition is
    built once per session and input and shared by the three feeds. The table
    spans one month; ``months`` > 1 deals the events over that many months.
    """
    key = (session.app_key(spark), sf_dir)
    if key not in _EVENTS:
        ev = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/events.parquet")
        _EVENTS[key] = ev.selectExpr(
            "event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "event_type", "value"
        )
    if months > 1:
        later = f"ts + make_ym_interval(0, CAST(event_id % {months} AS INT)) AS ts"
        return _EVENTS[key].selectExpr("event_id", later, "user_id", "event_type", "value")
    return _EVENTS[key]


def _base(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "event_id",
        "user_id",
        "ts",
        "value",
        "event_type",
        f"{ZONE_SQL} AS zone_code",
        f"{RESOLUTION_SQL} AS resolution_minutes",
        f"{SLOT_SQL} AS ts_utc",
        "ts AS ingested_at",
        "CAST(event_id AS STRING) AS run_id",
    )


def raw_load(spark: SparkSession, sf_dir: str, months: int = 1) -> DataFrame:
    """Bronze-shaped load rows (all revisions), with the event's ids."""
    b = _base(events(spark, sf_dir, months))
    return b.selectExpr(
        "zone_code", "ts_utc", "resolution_minutes",
        f"CASE WHEN event_id % {LOAD_NULL_MOD} = 0 THEN CAST(NULL AS DOUBLE) "
        f"ELSE value * {MW_PER_VALUE} END AS load_mw",
        "ingested_at", "run_id", "event_id", "user_id",
    )


def raw_generation(spark: SparkSession, sf_dir: str, months: int = 1) -> DataFrame:
    b = _base(events(spark, sf_dir, months))
    return b.selectExpr(
        "zone_code", "ts_utc", "resolution_minutes", f"{TYPE_SQL} AS production_type",
        f"value * {MW_PER_VALUE} AS generation_mw", "ingested_at", "run_id", "event_id", "user_id",
    )


def raw_price(spark: SparkSession, sf_dir: str, months: int = 1) -> DataFrame:
    b = _base(events(spark, sf_dir, months))
    return b.selectExpr(
        "zone_code", "ts_utc", "resolution_minutes",
        f"value * {PRICE_SCALE} - {PRICE_SHIFT} AS price_eur_mwh", "ingested_at", "run_id", "event_id", "user_id",
    )


RAW_FEEDS = {"load": raw_load, "generation": raw_generation, "price": raw_price}


def contract_feed(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Contract variant of a feed: rows grouped into ingest batches.

    A batch is (source, zone_code, market_day, run_id) and a run one user's rows
    of the day. Two events of a user in one interval collide, so some batches
    fail on duplicates; rare events report a 30-minute resolution or a measure
    that is no number. Measures are text, as a feed file delivers them.
    """
    from gridmart.specs import SOURCES

    spec = SOURCES[source]
    raw = RAW_FEEDS[source](spark, sf_dir)
    day = "CAST(from_utc_timestamp(ts_utc, 'Europe/Berlin') AS DATE)"
    rest = [c for c in raw.columns if c not in ("resolution_minutes", "run_id", spec.measure)]
    return raw.selectExpr(
        *rest,
        f"CASE WHEN event_id % {BAD_NUMBER_MOD} = 0 THEN '{BAD_NUMBER}' "
        f"ELSE CAST({spec.measure} AS STRING) END AS {spec.measure}",
        f"CASE WHEN event_id % {BAD_RESOLUTION_MOD} = 0 THEN CAST(30 AS BIGINT) "
        "ELSE resolution_minutes END AS resolution_minutes",
        f"{day} AS market_day",
        f"concat_ws('|', zone_code, CAST({day} AS STRING), CAST(user_id AS STRING)) AS run_id",
        f"'{source}' AS source",
    )


# ---------------------------------------------------------------------------
# Landed-file shapes derived from the same rows (what a feed client would
# have written), used by the ingest-side queries.
# The two measures of a two-level generation header.
AGGREGATED_MEASURE = "Actual Aggregated"
CONSUMPTION_MEASURE = "Actual Consumption"
# Price series: event_id % 3 = 0 is quarter-hourly on odd days of the month, all
# else hourly, so the zone-days of even days fall back to the hourly series.
SERIES_15_MOD = 3
GENERATION_TYPES_LANDED = list(dict.fromkeys(TYPE_BY_EVENT.values()))


def landing_generation_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation as (name, measure, value): the two-level column header."""
    g = raw_generation(spark, sf_dir)
    is_cons = F.col("production_type").endswith(" Consumption")
    return g.select(
        "zone_code", "ts_utc",
        F.when(is_cons, F.expr("substring(production_type, 1, length(production_type) - 12)"))
        .otherwise(F.col("production_type")).alias("name"),
        F.when(is_cons, F.lit(CONSUMPTION_MEASURE)).otherwise(F.lit(AGGREGATED_MEASURE)).alias("measure"),
        F.col("generation_mw").alias("value"),
    )


def offset_text(ts_utc: Column, tz: str) -> Column:
    """ISO-8601 local wall time with its UTC offset, e.g. 2024-01-08T01:00:00+01:00.

    Built with nested ``transform`` over a one-element array so the instant
    and the offset are each computed once per row (a plain expression tree
    would repeat them in every branch of the formatting).
    """
    def fmt(local: Column) -> Column:
        off = F.unix_seconds(local) - F.unix_seconds(ts_utc)
        return F.transform(
            F.array(off),
            lambda o: F.concat(
                F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"),
                F.when(o < 0, F.lit("-")).otherwise(F.lit("+")),
                F.lpad((F.abs(o) / 3600).cast("int").cast("string"), 2, "0"),
                F.lit(":"),
                F.lpad((F.abs(o) % 3600 / 60).cast("int").cast("string"), 2, "0"),
            ),
        )[0]

    return F.transform(F.array(F.from_utc_timestamp(ts_utc, tz)), fmt)[0]


def landing_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price batches as a feed client delivers them.

    Stamps are local Berlin text with offset; each batch (zone, market day)
    also repeats the first stamp of the next day, because the upstream client
    includes the window end. ``series_resolution`` names the published series.
    """
    from gridmart.functions.time import BERLIN, market_window_start

    p = raw_price(spark, sf_dir).withColumn("market_day", market_day("ts_utc"))
    quarter = (F.col("event_id") % SERIES_15_MOD == 0) & (F.dayofmonth("market_day") % 2 == 1)
    at_start = F.col("ts_utc") == market_window_start("market_day")
    # One row per landed file: a day's first stamp also closes the day before.
    days = F.when(at_start, F.array("market_day", F.date_sub("market_day", 1))).otherwise(F.array("market_day"))
    both = p.withColumn("series_resolution", F.when(quarter, "15min").otherwise("60min")).withColumn(
        "market_day", F.explode(days)
    )
    return both.select(
        "zone_code", "market_day", offset_text(F.col("ts_utc"), BERLIN).alias("ts"),
        "price_eur_mwh", "series_resolution", "event_id", "user_id",
    )


RUN_SQL = "concat_ws('|', zone_code, CAST(market_day AS STRING), CAST(user_id AS STRING)) AS run_id"


def landing_price_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``landing_price`` with a run id: one user's rows of a zone-day are a run."""
    return landing_price(spark, sf_dir).selectExpr(
        "zone_code", "market_day", RUN_SQL, "ts", "price_eur_mwh", "series_resolution"
    )


def landing_load_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load as landed files: (batch, ts text, load_mw), one user's rows of a zone-day a run."""
    return raw_load(spark, sf_dir).withColumn("market_day", market_day("ts_utc")).selectExpr(
        "zone_code", "market_day", RUN_SQL, UTC_TEXT_SQL, "load_mw", "event_id", "user_id"
    )


def landing_generation_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation as landed two-level files: (batch, ts text, name, measure, value),
    one user's rows of a zone-day a run. Stamps are UTC ISO text.
    """
    g = raw_generation(spark, sf_dir).withColumn("market_day", market_day("ts_utc"))
    cons = "production_type LIKE '% Consumption'"
    return g.selectExpr(
        "zone_code", "market_day", RUN_SQL, UTC_TEXT_SQL,
        f"CASE WHEN {cons} THEN substring(production_type, 1, length(production_type) - 12) "
        "ELSE production_type END AS name",
        f"CASE WHEN {cons} THEN '{CONSUMPTION_MEASURE}' ELSE '{AGGREGATED_MEASURE}' END AS measure",
        "generation_mw AS value",
    )


UTC_TEXT_SQL = "concat(date_format(ts_utc, \"yyyy-MM-dd'T'HH:mm:ss\"), '+00:00') AS ts"

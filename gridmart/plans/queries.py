"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables (through the bronze-shaped adapter in
``gridmart.sources.adapters``) and runs over all of their rows. Doubles are
settled to 6 places only at the very end, for comparison with the DuckDB
oracle in ``gridmart.plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import dims, session
from gridmart.functions.numeric import settle_doubles
from gridmart.functions.time import market_day, market_window_end
from gridmart.operators import checks, contracts, conform, grid, mix, reshape, resolution
from gridmart.operators import serve, series
from gridmart.operators.revisions import latest_revision, retracted_keys
from gridmart.plans.fact import fct_from_bronze
from gridmart.plans.publish import publish_fct
from gridmart.sources import adapters as A
from gridmart.sources import mart
from gridmart.specs import SOURCES

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
PAGE_ZONE = "DE_LU"
PAGE_START = datetime(2024, 1, 8, tzinfo=UTC)
PAGE_END = datetime(2024, 1, 15, tzinfo=UTC)
PAGE_LIMIT = 50
ZONES_CSV = "DE_LU, AT ,NL, FR, DK_1, DK_2"
FRESHNESS_NOW = [
    datetime(2024, 1, 31, 0, 0, tzinfo=UTC),
    datetime(2024, 2, 1, 6, 0, tzinfo=UTC),
    datetime(2024, 2, 3, 0, 0, tzinfo=UTC),
]


def _prep(spark: SparkSession) -> SparkSession:
    return session.configure(spark)


def _fct(spark: SparkSession, sf_dir: str, with_month: bool = False) -> DataFrame:
    return fct_from_bronze(
        spark,
        A.raw_load(spark, sf_dir),
        A.raw_generation(spark, sf_dir),
        A.raw_price(spark, sf_dir),
        with_month=with_month,
    )


# -- fact, staging, revisions -------------------------------------------------


def q_fct_grid_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return settle_doubles(_fct(spark, sf_dir))


def q_stg_load_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return settle_doubles(conform.stg_load(A.raw_load(spark, sf_dir)))


def q_stg_generation_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return settle_doubles(conform.stg_generation(A.raw_generation(spark, sf_dir)))


def q_stg_price_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return settle_doubles(conform.stg_price(A.raw_price(spark, sf_dir)))


def q_latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest load revision per interval, null measures included."""
    _prep(spark)
    latest = latest_revision(A.raw_load(spark, sf_dir), SOURCES["load"].key)
    return settle_doubles(latest.drop("event_id", "user_id"))


def q_null_retraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals whose newest revision is null although an older one had a value."""
    _prep(spark)
    return settle_doubles(retracted_keys(A.raw_load(spark, sf_dir), SOURCES["load"].key, "load_mw"))


def q_generation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    stg = conform.stg_generation(A.raw_generation(spark, sf_dir))
    return settle_doubles(mix.generation_mix(stg, dims.dim_production_type(spark)))


def q_storage_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    stg = conform.stg_generation(A.raw_generation(spark, sf_dir))
    return settle_doubles(mix.storage_draw(stg, dims.dim_production_type(spark)))


def q_fct_from_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with the production-type dimension read from a CSV seed file."""
    _prep(spark)
    path = session.fresh_path(spark, "seed-production-type")
    dims.write_production_type_seed(spark, path)
    return settle_doubles(fct_from_bronze(
        spark, A.raw_load(spark, sf_dir), A.raw_generation(spark, sf_dir), A.raw_price(spark, sf_dir),
        production_types=dims.read_production_type_seed(spark, path),
    ))


# -- serving ------------------------------------------------------------------

_MARTS: dict[tuple[str, str], str] = {}


def published_fct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact published as a mart (once per session and input)."""
    return mart.read_fct(spark, _mart_path(spark, sf_dir))


def q_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone list (ordered by code) with each zone's hour coverage in the mart."""
    _prep(spark)
    return serve.zone_list(dims.dim_zone(spark), published_fct(spark, sf_dir))


def _page_request(after: datetime | None = None) -> serve.PageRequest:
    from gridmart.functions.text import encode_cursor

    return serve.PageRequest.make(
        PAGE_ZONE, PAGE_START, PAGE_END, PAGE_LIMIT, encode_cursor(after) if after else None
    )


def q_hourly_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First page of DE_LU hours in [2024-01-08, 2024-01-15), 50 rows."""
    _prep(spark)
    req = _page_request()
    fct = mart.read_fct(spark, _mart_path(spark, sf_dir), req.start, req.end)
    return settle_doubles(serve.page_frame(fct, req))


def q_hourly_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page: follows the cursor returned with the first page."""
    _prep(spark)
    from gridmart.functions.text import decode_cursor

    first = _page_request()
    fct = mart.read_fct(spark, _mart_path(spark, sf_dir), first.start, first.end)
    _, cursor = serve.hourly_page(fct, first)
    after = decode_cursor(cursor) if cursor else first.end
    return settle_doubles(serve.page_frame(fct, _page_request(after)))


def _mart_path(spark: SparkSession, sf_dir: str) -> str:
    key = (session.app_key(spark), sf_dir)
    if key not in _MARTS:
        path = session.fresh_path(spark, "mart-fct_grid_hourly")
        publish_fct(spark, _fct(spark, sf_dir, with_month=True), path)
        _MARTS[key] = path
    return _MARTS[key]


# -- landing / ingest-side reshaping -------------------------------------------


def q_unpivot_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-level header -> flat names -> wide landing frame -> long rows (nulls kept)."""
    _prep(spark)
    two = A.landing_generation_two_level(spark, sf_dir)
    flat = two.select(
        "zone_code", "ts_utc",
        reshape.flatten_header(F.col("name"), F.col("measure")).alias("production_type"),
        "value",
    )
    names = A.GENERATION_TYPES_LANDED
    wide = reshape.widen(flat, ["zone_code", "ts_utc"], "production_type", "value", names)
    long = reshape.melt(wide, ["zone_code", "ts_utc"], names, "production_type", "generation_mw")
    return settle_doubles(long)


def q_resolution_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution per (zone, market day) batch of the load feed."""
    _prep(spark)
    rows = A.raw_load(spark, sf_dir).withColumn("market_day", market_day("ts_utc"))
    return resolution.detect_resolution(rows, ["zone_code", "market_day"])


def _landing_price_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridmart.functions.time import parse_instant

    lp = A.landing_price(spark, sf_dir)
    return lp.withColumn("ts_utc", parse_instant("ts")).drop("ts")


def q_first_available_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (zone, market day): rows of the 15-minute series if any, else hourly."""
    _prep(spark)
    lp = _landing_price_utc(spark, sf_dir)
    picked = series.first_available_series(lp, ["zone_code", "market_day"])
    return settle_doubles(picked.drop("event_id", "user_id"))


def q_market_day_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every market day from the first to the last event, with its UTC window."""
    _prep(spark)
    ev = A.events(spark, sf_dir)
    bounds = ev.agg(
        F.min(market_day("ts")).alias("first_day"), F.max(market_day("ts")).alias("last_day")
    )
    return grid.with_market_window(grid.backfill_days(bounds))


def q_end_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed price rows parsed to UTC, minus the next day's first stamp."""
    _prep(spark)
    lp = _landing_price_utc(spark, sf_dir).withColumn("window_end_utc", market_window_end("market_day"))
    kept = series.drop_end_boundary(lp, "window_end_utc")
    return settle_doubles(kept.select("zone_code", "market_day", "ts_utc", "price_eur_mwh", "series_resolution"))


def _landed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, fn in A.RAW_FEEDS.items():
        parts.append(fn(spark, sf_dir).select(F.lit(name).alias("source"), "zone_code", market_day("ts_utc").alias("market_day")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("source", "zone_code", "market_day").agg(F.count(F.lit(1)).alias("landed_rows"))


def _expected_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = A.events(spark, sf_dir)
    bounds = ev.agg(F.min(market_day("ts")).alias("first_day"), F.max(market_day("ts")).alias("last_day"))
    days = grid.with_market_window(grid.backfill_days(bounds))
    return grid.job_grid(days, list(SOURCES), ZONES_CSV)


def q_job_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected (source, zone, day) batches with their window and landed rows."""
    _prep(spark)
    expected = _expected_batches(spark, sf_dir)
    landed = _landed_batches(spark, sf_dir)
    out = expected.join(landed, ["source", "zone_code", "market_day"], "left")
    return out.select(
        "source", "zone_code", "market_day", "window_start_utc", "window_end_utc", "window_hours",
        F.coalesce(F.col("landed_rows"), F.lit(0)).cast("bigint").alias("landed_rows"),
    )


# -- contracts and ledger -------------------------------------------------------


def _flagged(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    feed = A.contract_feed(spark, sf_dir, source)
    return contracts.flag_rows(feed, SOURCES[source].contract)


def _verdicts(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return contracts.verdicts(_flagged(spark, sf_dir, source), SOURCES[source].contract)


def q_contract_violations_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return _verdicts(spark, sf_dir, "load")


def q_contract_violations_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return _verdicts(spark, sf_dir, "generation")


def q_contract_violations_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return _verdicts(spark, sf_dir, "price")


def q_contract_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of accepted batches, all three feeds, as they would enter bronze."""
    _prep(spark)
    out = None
    for source, spec in SOURCES.items():
        flagged = _flagged(spark, sf_dir, source)
        ok = contracts.valid_rows(flagged, contracts.verdicts(flagged, spec.contract), spec.contract)
        part = ok.select(
            "source", "zone_code", "market_day", "run_id", "ts_utc",
            (F.col("production_type") if "production_type" in ok.columns else F.lit(None).cast("string")).alias(
                "production_type"
            ),
            F.col(spec.measure).alias("measure"),
            "resolution_minutes",
        )
        out = part if out is None else out.unionByName(part)
    return settle_doubles(out)


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = None
    for source in SOURCES:
        v = _verdicts(spark, sf_dir, source)
        verdict = v if verdict is None else verdict.unionByName(v)
    # Every landed batch has a verdict, so what has none landed nothing.
    missing = _expected_batches(spark, sf_dir).join(
        verdict.select("source", "zone_code", "market_day"), ["source", "zone_code", "market_day"], "left_anti"
    ).select("source", "zone_code", "market_day")
    return contracts.ledger(verdict, missing)


def q_ingest_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return _ledger(spark, sf_dir)


def q_ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return contracts.summary(_ledger(spark, sf_dir))


# -- checks ----------------------------------------------------------------------


def q_data_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14 warehouse tests over the fact and its dimensions."""
    _prep(spark)
    return checks.data_tests(
        published_fct(spark, sf_dir), dims.dim_zone(spark), dims.dim_production_type(spark)
    )


def q_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of each bronze feed at three reference instants."""
    _prep(spark)
    feeds = {name: fn(spark, sf_dir) for name, fn in A.RAW_FEEDS.items()}
    return settle_doubles(checks.freshness(feeds, FRESHNESS_NOW))


# -- bronze layer and incremental refresh -------------------------------------------

INGESTED_AT = datetime(2024, 2, 1, 6, 0, tzinfo=UTC)
INCREMENT_CUT = "2024-01-16 00:00:00"


def q_bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validate all batches, append the accepted ones, read bronze back by month and zone."""
    _prep(spark)
    from gridmart.plans.ingest import ingest
    from gridmart.sources import bronze
    from gridmart.specs import MIN_TS

    root = session.fresh_path(spark, "bronze")
    ledger_path = session.fresh_path(spark, "ledger")
    out = None
    for source, spec in SOURCES.items():
        ingest(spark, A.contract_feed(spark, sf_dir, source), source, root, ledger_path, INGESTED_AT)
        back = bronze.read_bronze(spark, root, spec, start=MIN_TS)
        part = back.groupBy("ts_month", "zone_code").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("ts_utc").alias("first_ts_utc"),
            F.max("ts_utc").alias("last_ts_utc"),
            F.countDistinct("run_id").alias("runs"),
            F.min("ingested_at").alias("first_ingested_at"),
            F.max("ingested_at").alias("last_ingested_at"),
        ).select(F.lit(spec.table).alias("table"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def q_incremental_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bronze appends, each followed by an availableNow refresh; read the mart."""
    _prep(spark)
    from gridmart.sources import bronze
    from gridmart.streaming.incremental import refresh

    root = session.fresh_path(spark, "bronze-inc")
    mart_path = session.fresh_path(spark, "mart-inc")
    checkpoint = session.fresh_path(spark, "stream-inc")
    cut = F.lit(INCREMENT_CUT).cast("timestamp")
    for first in (True, False):
        for name, fn in A.RAW_FEEDS.items():
            rows = fn(spark, sf_dir)
            rows = rows.filter(F.col("ts_utc") < cut) if first else rows.filter(F.col("ts_utc") >= cut)
            bronze.write_bronze(rows, root, SOURCES[name])
        refresh(spark, root, mart_path, checkpoint)
    fct = mart.read_fct(spark, mart_path).drop("ts_month")
    return settle_doubles(fct)


def q_ingest_price_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full ingest path on landed price files, summarised from bronze.

    Offset-text stamps -> UTC, preferred series per batch, window-end stamp
    dropped, resolution detected per batch, contract verdicts, accepted
    batches appended, bronze read back by month, zone and resolution.
    """
    _prep(spark)
    from gridmart.plans import ingest as I
    from gridmart.sources import bronze
    from gridmart.specs import MIN_TS

    root = session.fresh_path(spark, "bronze-landing")
    ledger_path = session.fresh_path(spark, "ledger-landing")
    with session.Scratch(spark) as scratch:
        landed = A.landing_price_batches(spark, sf_dir)
        prepared = I.prepare(I.normalize_price(landed), "price", scratch)
        I.ingest(spark, prepared, "price", root, ledger_path, INGESTED_AT, missing=I.price_batches_lost(landed))
    back = bronze.read_bronze(spark, root, SOURCES["price"], start=MIN_TS)
    return back.groupBy("ts_month", "zone_code", "resolution_minutes").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("run_id").alias("runs"),
        F.min("ts_utc").alias("first_ts_utc"),
        F.max("ts_utc").alias("last_ts_utc"),
    )


def q_ingest_generation_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full ingest path on landed two-level generation files, summarised from bronze.

    Header flattened to type names, resolution detected per batch over the
    distinct stamps (each repeated per type), contract with the type in the
    key, accepted batches appended, bronze read back by month, zone, type
    and resolution.
    """
    _prep(spark)
    from gridmart.plans import ingest as I
    from gridmart.sources import bronze
    from gridmart.specs import MIN_TS

    root = session.fresh_path(spark, "bronze-landing-gen")
    ledger_path = session.fresh_path(spark, "ledger-landing-gen")
    landed = A.landing_generation_batches(spark, sf_dir)
    with session.Scratch(spark) as scratch:
        prepared = I.prepare(I.normalize_generation_two_level(landed), "generation", scratch)
        I.ingest(spark, prepared, "generation", root, ledger_path, INGESTED_AT)
    back = bronze.read_bronze(spark, root, SOURCES["generation"], start=MIN_TS)
    return settle_doubles(
        back.groupBy("ts_month", "zone_code", "production_type", "resolution_minutes").agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("run_id").alias("runs"),
            F.min("ts_utc").alias("first_ts_utc"),
            F.max("ts_utc").alias("last_ts_utc"),
            F.sum("generation_mw").alias("generation_mwh_sum"),
        )
    )


def q_ingest_landing_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job over landed files in three formats: every batch's outcome.

    Load lands as CSV, generation as JSON, price as Parquet. Some load files
    carry stamps that are no time, no zone or no run, and some price batches
    publish no known series or hold only the window-end stamp in the picked one:
    each must appear in the ledger, none may load.
    """
    _prep(spark)
    from gridmart.plans import ingest as I
    from gridmart.plans import jobs

    base = session.fresh_path(spark, "landed")
    load = A.landing_load_batches(spark, sf_dir)
    # The zone and the run are broken after the run id is made of them.
    load.selectExpr(
        "CASE WHEN user_id % 10 <> 7 THEN zone_code END AS zone_code", "market_day",
        "CASE WHEN user_id % 25 <> 11 THEN run_id END AS run_id",
        "CASE WHEN user_id % 10 <> 3 THEN ts ELSE 'no time' END AS ts", "load_mw",
    ).write.option("header", True).csv(f"{base}/files/load")
    A.landing_generation_batches(spark, sf_dir).write.json(f"{base}/files/generation")
    A.landing_price_batches(spark, sf_dir).withColumn(
        "series_resolution",
        F.when(F.split_part("run_id", F.lit("|"), F.lit(-1)).cast("long") % 10 == 4, "30min")
        .otherwise(F.col("series_resolution")),
    ).write.parquet(f"{base}/files/price")
    jobs.ingest_landing(
        spark, f"{base}/files", f"{base}/bronze", f"{base}/ledger",
        formats={"load": "csv", "generation": "json"}, ingested_at=INGESTED_AT, job_id="query",
    )
    session.delete_path(spark, f"{base}/files")
    return I.read_ledger(spark, f"{base}/ledger", "query").select(*contracts.LEDGER_COLUMNS)


RETRACTED_MONTH = "2024-02-01"


def q_mart_retraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four months of bronze; then every load value of one is withdrawn, and the month must go.

    The mart is built, the retracting revisions are appended, and the touched
    month is refreshed.
    """
    _prep(spark)
    from gridmart.plans import jobs
    from gridmart.sources import bronze
    from gridmart.streaming.incremental import refresh

    base = session.fresh_path(spark, "retraction")
    root, mart_path = f"{base}/bronze", f"{base}/mart"
    feeds = {name: fn(spark, sf_dir, months=4) for name, fn in A.RAW_FEEDS.items()}
    for name, rows in feeds.items():
        bronze.write_bronze(rows, root, SOURCES[name])
    jobs.build_mart(spark, root, mart_path)
    month = F.date_trunc("month", "ts_utc") == F.lit(RETRACTED_MONTH).cast("timestamp")
    withdrawn = feeds["load"].filter(month).select("zone_code", "ts_utc", "resolution_minutes").distinct()
    bronze.write_bronze(
        withdrawn.withColumn("load_mw", F.lit(None).cast("double")).withColumn("run_id", F.lit("withdrawn")),
        root, SOURCES["load"], ingested_at=datetime(2025, 1, 1, tzinfo=UTC),
    )
    refresh(spark, root, mart_path, f"{base}/stream")
    return settle_doubles(mart.read_fct(spark, mart_path).drop("ts_month"))


# Fixed parameter of the queries with late data: these events arrive after a first build.
LATE_MOD = 97


def refresh_late_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list]:
    """Four months built from the rows on time, then refreshed with the late ones: the mart and both reports."""
    from gridmart.sources import bronze
    from gridmart.streaming.incremental import refresh_reports

    base = session.fresh_path(spark, "by-key")
    root, mart_path = f"{base}/bronze", f"{base}/mart"
    reports = []
    for late in (False, True):
        for name, fn in A.RAW_FEEDS.items():
            rows = fn(spark, sf_dir, months=4).filter((F.col("event_id") % LATE_MOD == 0) == F.lit(late))
            bronze.write_bronze(rows, root, SOURCES[name])
        reports.append(refresh_reports(spark, root, mart_path, f"{base}/stream"))
    return mart.read_fct(spark, mart_path).drop("ts_month"), reports


def q_refresh_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart of four months, refreshed after late rows: only their zone-hours are computed anew."""
    _prep(spark)
    return settle_doubles(refresh_late_rows(spark, sf_dir)[0])


def q_publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two publishes; the first version as read by a plan made before the second, and the second."""
    _prep(spark)
    path = session.fresh_path(spark, "mart-versions")

    def fact(on_time_only: bool) -> DataFrame:
        feeds = [fn(spark, sf_dir, months=4) for fn in A.RAW_FEEDS.values()]
        if on_time_only:
            feeds = [f.filter(F.col("event_id") % LATE_MOD != 0) for f in feeds]
        return fct_from_bronze(spark, *feeds, with_month=True)

    def seen(name: str) -> DataFrame:
        return mart.read_fct(spark, path).groupBy("ts_month", "zone_code").agg(
            F.count(F.lit(1)).alias("hours"), F.sum("load_mw").alias("load_mw_sum"),
            F.count("price_eur_mwh").alias("price_hours"),
        ).select(F.lit(name).alias("seen"), "*")

    publish_fct(spark, fact(True), path)
    before = seen("before")  # resolved now, run after the second publish
    publish_fct(spark, fact(False), path)
    return settle_doubles(before.unionByName(seen("after")))


# Fixed parameter: the users whose measures differ when the feeds are landed again.
REVISED_USER_MOD = 7


def ingest_twice(spark: SparkSession, sf_dir: str, revise: bool) -> tuple[str, str, list[int]]:
    """All feeds ingested, then landed and ingested again, ``revise``: with some users' measures changed.

    Returns the bronze root, the ledger and the rows appended by each run.
    """
    from gridmart.plans.ingest import ingest

    base = session.fresh_path(spark, "replay")
    written = []
    for job, at in (("first", INGESTED_AT), ("second", INGESTED_AT + timedelta(days=1))):
        rows = 0
        for source, spec in SOURCES.items():
            feed = A.contract_feed(spark, sf_dir, source)
            if revise and job == "second":
                number = F.col(spec.measure).try_cast("double")
                feed = feed.withColumn(spec.measure, F.when(
                    (F.col("user_id") % REVISED_USER_MOD == 0) & number.isNotNull() & (number > 1),
                    (number - 0.5).cast("string")).otherwise(F.col(spec.measure)))
            rows += ingest(spark, feed, source, f"{base}/bronze", f"{base}/ledger", at, job_id=job)
        written.append(rows)
    return f"{base}/bronze", f"{base}/ledger", written


def q_replay_safe_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same feeds, some measures revised in between: both runs' ledger.

    Unchanged batches are replayed (no rows), revised ones load again.
    """
    _prep(spark)
    from gridmart.plans import ingest as I

    _, ledger, _ = ingest_twice(spark, sf_dir, revise=True)
    out = None
    for job in ("first", "second"):
        part = I.read_ledger(spark, ledger, job).select(F.lit(job).alias("job"), *contracts.LEDGER_COLUMNS)
        out = part if out is None else out.unionByName(part)
    return out


RUN_DATE, RUN_LAG_DAYS, RUN_ZONES = "2024-01-12", 2, "DE_LU, AT, NL, BE"


def q_ingest_scheduled_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scheduled run over the whole landing root: the market day it is due for, its zones, its ledger.

    The landing root is partitioned by market day, so the other days' files are not
    read; a zone of the run that landed nothing is missing.
    """
    _prep(spark)
    from gridmart.plans import ingest as I
    from gridmart.plans import jobs

    base = session.fresh_path(spark, "scheduled")
    for source, make in (("load", A.landing_load_batches), ("price", A.landing_price_batches)):
        rows = make(spark, sf_dir).drop("event_id", "user_id")
        rows.repartition("market_day").write.partitionBy("market_day").parquet(f"{base}/files/{source}")
    jobs.ingest_landing(
        spark, f"{base}/files", f"{base}/bronze", f"{base}/ledger", ingested_at=INGESTED_AT, job_id="query",
        run_date=RUN_DATE, lag_days=RUN_LAG_DAYS, zones=RUN_ZONES, sources=("load", "generation", "price"),
    )
    session.delete_path(spark, f"{base}/files")
    return I.read_ledger(spark, f"{base}/ledger", "query").select(*contracts.LEDGER_COLUMNS)


def q_landed_file_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingest job over files of which some do not fit: each is ledgered with its reason, the others load.

    One file a market day. By the day of the month, price files (Parquet) lack the price
    or hold it as text, load files (JSON) have torn lines, generation files (CSV)
    have no ``measure`` or swap two columns. File rows show the day in the file's path.
    """
    _prep(spark)
    from gridmart.plans import ingest as I
    from gridmart.plans import jobs

    base = session.fresh_path(spark, "drift")
    turn = F.dayofmonth("market_day") % 7

    def land(source: str, fmt: str, rows: DataFrame, **options: str) -> None:
        (rows.repartition("market_day").write.mode("append").partitionBy("market_day").options(**options)
         .format(fmt).save(f"{base}/files/{source}"))

    price = A.landing_price_batches(spark, sf_dir)
    land("price", "parquet", price.where(turn > 1))
    land("price", "parquet", price.where(turn == 0).drop("price_eur_mwh"))
    land("price", "parquet", price.where(turn == 1).withColumn("price_eur_mwh", F.col("price_eur_mwh").cast("string")))
    load = A.landing_load_batches(spark, sf_dir)
    line = F.to_json(F.struct("zone_code", "run_id", "ts", "load_mw"))
    torn = (turn == 2) & (F.col("event_id") % 13 == 0)
    land("load", "text", load.select("market_day", F.when(torn, F.substring(line, 1, 20)).otherwise(line).alias("value")))
    generation = A.landing_generation_batches(spark, sf_dir)
    land("generation", "csv", generation.where(turn > 1), header="true")
    land("generation", "csv", generation.where(turn == 0).drop("measure"), header="true")
    land("generation", "csv", generation.where(turn == 1).select(
        "market_day", "zone_code", "run_id", "ts", "measure", "name", "value"), header="true")
    jobs.ingest_landing(spark, f"{base}/files", f"{base}/bronze", f"{base}/ledger", ingested_at=INGESTED_AT,
                        job_id="query", formats={"load": "json", "generation": "csv"})
    session.delete_path(spark, f"{base}/files")
    ledger = I.read_ledger(spark, f"{base}/ledger", "query")
    day = F.to_date(F.regexp_extract("file", "market_day=([0-9-]+)", 1))
    return ledger.select("source", "zone_code", F.when(F.col("file").isNotNull(), day).otherwise(F.col("market_day")).alias("market_day"),
                         "run_id", "rows", "rows_loaded", "status", "reason", F.col("file").isNotNull().alias("of_file"))


def registry() -> dict[str, Query]:
    return {
        "q_landed_file_drift": q_landed_file_drift,
        "q_replay_safe_append": q_replay_safe_append,
        "q_ingest_scheduled_day": q_ingest_scheduled_day,
        "q_refresh_by_key": q_refresh_by_key,
        "q_publish_versions": q_publish_versions,
        "q_fct_grid_hourly": q_fct_grid_hourly,
        "q_stg_load_hourly": q_stg_load_hourly,
        "q_stg_generation_hourly": q_stg_generation_hourly,
        "q_stg_price_hourly": q_stg_price_hourly,
        "q_latest_revision": q_latest_revision,
        "q_null_retraction": q_null_retraction,
        "q_generation_mix": q_generation_mix,
        "q_storage_draw": q_storage_draw,
        "q_fct_from_seed": q_fct_from_seed,
        "q_zones": q_zones,
        "q_hourly_page": q_hourly_page,
        "q_hourly_page_after": q_hourly_page_after,
        "q_unpivot_generation": q_unpivot_generation,
        "q_resolution_detect": q_resolution_detect,
        "q_first_available_series": q_first_available_series,
        "q_market_day_windows": q_market_day_windows,
        "q_end_boundary": q_end_boundary,
        "q_job_grid": q_job_grid,
        "q_contract_violations_load": q_contract_violations_load,
        "q_contract_violations_generation": q_contract_violations_generation,
        "q_contract_violations_price": q_contract_violations_price,
        "q_contract_valid_rows": q_contract_valid_rows,
        "q_ingest_ledger": q_ingest_ledger,
        "q_ingest_summary": q_ingest_summary,
        "q_data_tests": q_data_tests,
        "q_freshness": q_freshness,
        "q_bronze_roundtrip": q_bronze_roundtrip,
        "q_incremental_mart": q_incremental_mart,
        "q_ingest_price_landing": q_ingest_price_landing,
        "q_ingest_generation_landing": q_ingest_generation_landing,
        "q_ingest_landing_ledger": q_ingest_landing_ledger,
        "q_mart_retraction": q_mart_retraction,
    }

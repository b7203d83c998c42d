"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views. The
bronze-shaped adapter, the dimensions and the staging views are spelled out
as CTEs, in the warehouse's own form (two separate CTEs for mix and draw,
SQL ``row_number``), so the oracle checks our Spark plan rather than
repeating it. Engine differences handled here: DuckDB ``dayofweek`` is
0 = Sunday (+1), integer results are cast to BIGINT, rounding uses the same
IEEE floor form on both sides, and doubles are settled to 6 places.
"""

from __future__ import annotations

from gridmart import dims


def rha(x: str, digits: int) -> str:
    """Halves away from zero by IEEE arithmetic; values without a fraction (and NaN) stay as they are."""
    s = f"CAST({float(10 ** digits)!r} AS DOUBLE)"
    up = f"floor(abs({x}) * {s} + 0.5) / {s}"
    return f"(CASE WHEN abs({x}) * {s} >= 9007199254740992.0 THEN {x} WHEN ({x}) < 0 THEN -({up}) ELSE {up} END)"


def settle(body: str, columns: list[str], doubles: list[str]) -> str:
    """Select ``columns`` from ``body``, rounding ``doubles`` to 6 places."""
    sel = ", ".join(f"{rha(c, 6)} AS {c}" if c in doubles else c for c in columns)
    return f"SELECT {sel} FROM ({body}) AS settled"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# Fixed values, stated anew here so that a wrong one in the adapter cannot pass on both sides.
ZONES_BY_USER = ["DE_LU", "AT", "NL", "FR", "DK_1", "DK_2"]
TYPES_BY_EVENT = [
    ("error", "Fossil Gas"), ("click", "Solar"), ("view", "Nuclear"),
    ("signup", "Hydro Pumped Storage"), ("purchase", "Hydro Pumped Storage Consumption"),
]


def zone_case(col: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(z)}" for i, z in enumerate(ZONES_BY_USER))
    return f"CASE {col} % 6 {whens} END"


def type_case(col: str) -> str:
    whens = " ".join(f"WHEN {_q(e)} THEN {_q(t)}" for e, t in TYPES_BY_EVENT)
    return f"CASE {col} {whens} END"


def dim_zone_values() -> str:
    rows = ", ".join(f"({_q(a)}, {_q(b)}, {_q(c)}, {_q(d)})" for a, b, c, d in dims.ZONES)
    return f"SELECT * FROM (VALUES {rows}) AS z(zone_code, zone_name, country, timezone)"


def dim_type_values() -> str:
    def lit(v):
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        if isinstance(v, int):
            return f"CAST({v} AS BIGINT)"
        return _q(v)

    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in dims.production_type_rows())
    return (
        f"SELECT * FROM (VALUES {rows}) AS d(production_type, category, flow_direction, "
        "is_renewable, is_dispatchable, emission_factor_kg_co2_mwh)"
    )


QUARTER = "date_trunc('minute', ts) - to_minutes(CAST(minute(ts) % 15 AS BIGINT))"

def adapter(months: int = 1, where: str = "true") -> str:
    """The bronze-shaped feeds; ``months`` > 1 deals the events over that many months."""
    events = "events" if months == 1 else (
        f"(SELECT * REPLACE (ts + to_months(CAST(event_id % {months} AS INTEGER)) AS ts) FROM events WHERE {where}) e")
    return _ADAPTER.replace("{events}", events)


_ADAPTER = f"""
base AS (
  SELECT event_id, user_id, CAST(ts AS TIMESTAMP) AS ts, value, event_type,
         {zone_case('user_id')} AS zone_code,
         CAST(CASE WHEN user_id % 2 = 0 THEN 15 ELSE 60 END AS BIGINT) AS resolution_minutes,
         CASE WHEN user_id % 2 = 0 THEN {QUARTER} ELSE date_trunc('hour', ts) END AS ts_utc,
         CAST(ts AS TIMESTAMP) AS ingested_at,
         CAST(event_id AS VARCHAR) AS run_id
  FROM {{events}}
),
raw_load AS (
  SELECT zone_code, ts_utc, resolution_minutes,
         CASE WHEN event_id % 11 = 0 THEN CAST(NULL AS DOUBLE)
              ELSE value * 600.0 END AS load_mw,
         ingested_at, run_id, event_id, user_id
  FROM base
),
raw_generation AS (
  SELECT zone_code, ts_utc, resolution_minutes, {type_case('event_type')} AS production_type,
         value * 600.0 AS generation_mw, ingested_at, run_id, event_id, user_id
  FROM base
),
raw_price AS (
  SELECT zone_code, ts_utc, resolution_minutes,
         value * 10.0 - 100.0 AS price_eur_mwh, ingested_at, run_id, event_id, user_id
  FROM base
),
dim_zone AS ({dim_zone_values()}),
dim_production_type AS ({dim_type_values()})"""
ADAPTER = adapter()


def _stg(name: str, raw: str, measure: str, extra_key: str = "") -> str:
    ek = f", {extra_key}" if extra_key else ""
    return f"""
{name} AS (
  SELECT zone_code, date_trunc('hour', ts_utc) AS ts_hour_utc{ek},
         avg({measure}) AS {measure},
         count(*) AS intervals_aggregated,
         max(resolution_minutes) AS source_resolution_minutes,
         max(ingested_at) AS ingested_at
  FROM (
    SELECT *, row_number() OVER (
        PARTITION BY zone_code, ts_utc{ek} ORDER BY ingested_at DESC, run_id DESC
      ) AS revision_rank
    FROM {raw}
    WHERE ts_utc >= TIMESTAMP '2020-01-01'
  ) latest
  WHERE revision_rank = 1 AND {measure} IS NOT NULL
  GROUP BY zone_code, date_trunc('hour', ts_utc){ek}
)"""


STAGING = ",".join([
    _stg("stg_load", "raw_load", "load_mw"),
    _stg("stg_generation", "raw_generation", "generation_mw", "production_type"),
    _stg("stg_price", "raw_price", "price_eur_mwh"),
])

MIX = """
generation_mix AS (
  SELECT g.zone_code, g.ts_hour_utc,
    sum(CASE WHEN d.category = 'renewable' THEN g.generation_mw ELSE 0 END) AS renewable_mw,
    sum(CASE WHEN d.category = 'fossil'    THEN g.generation_mw ELSE 0 END) AS fossil_mw,
    sum(CASE WHEN d.category = 'nuclear'   THEN g.generation_mw ELSE 0 END) AS nuclear_mw,
    sum(CASE WHEN d.category = 'storage'   THEN g.generation_mw ELSE 0 END) AS storage_mw,
    sum(CASE WHEN d.category = 'other'     THEN g.generation_mw ELSE 0 END) AS other_mw,
    sum(g.generation_mw) AS total_generation_mw,
    sum(g.generation_mw * d.emission_factor_kg_co2_mwh) AS total_co2_kg
  FROM stg_generation AS g
  INNER JOIN dim_production_type AS d USING (production_type)
  WHERE d.flow_direction = 'generation'
  GROUP BY g.zone_code, g.ts_hour_utc
),
storage_draw AS (
  SELECT g.zone_code, g.ts_hour_utc, sum(g.generation_mw) AS storage_consumption_mw
  FROM stg_generation AS g
  INNER JOIN dim_production_type AS d USING (production_type)
  WHERE d.flow_direction = 'consumption' AND d.category = 'storage'
  GROUP BY g.zone_code, g.ts_hour_utc
)"""

LOCAL = "((l.ts_hour_utc AT TIME ZONE 'UTC') AT TIME ZONE z.timezone)"

FCT_BODY = f"""
SELECT l.zone_code, l.ts_hour_utc,
  CAST({LOCAL} AS DATE) AS date_local,
  l.load_mw, m.renewable_mw, m.fossil_mw, m.nuclear_mw, m.storage_mw, m.other_mw,
  m.total_generation_mw, s.storage_consumption_mw,
  CASE WHEN m.total_generation_mw > 0
       THEN {rha('m.renewable_mw / m.total_generation_mw * 100.0', 2)} END AS renewable_pct,
  l.load_mw - coalesce(m.renewable_mw, 0) AS residual_load_mw,
  CASE WHEN m.total_generation_mw > 0
       THEN {rha('m.total_co2_kg / m.total_generation_mw', 1)} END AS carbon_intensity_g_kwh,
  p.price_eur_mwh,
  CAST(hour(l.ts_hour_utc) AS BIGINT) AS hour_utc,
  CAST(dayofweek({LOCAL}) + 1 AS BIGINT) AS day_of_week_local,
  CAST(l.intervals_aggregated AS BIGINT) AS load_intervals_aggregated
FROM stg_load AS l
INNER JOIN dim_zone AS z USING (zone_code)
LEFT JOIN generation_mix AS m USING (zone_code, ts_hour_utc)
LEFT JOIN storage_draw AS s USING (zone_code, ts_hour_utc)
LEFT JOIN stg_price AS p USING (zone_code, ts_hour_utc)"""

FCT_COLUMNS = [
    "zone_code", "ts_hour_utc", "date_local", "load_mw", "renewable_mw", "fossil_mw",
    "nuclear_mw", "storage_mw", "other_mw", "total_generation_mw", "storage_consumption_mw",
    "renewable_pct", "residual_load_mw", "carbon_intensity_g_kwh", "price_eur_mwh",
    "hour_utc", "day_of_week_local", "load_intervals_aggregated",
]
FCT_DOUBLES = [
    "load_mw", "renewable_mw", "fossil_mw", "nuclear_mw", "storage_mw", "other_mw",
    "total_generation_mw", "storage_consumption_mw", "renewable_pct", "residual_load_mw",
    "carbon_intensity_g_kwh", "price_eur_mwh",
]


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts)


FCT_CTE = f"fct AS ({FCT_BODY})"
BERLIN_DAY = "CAST((ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS DATE)"


def win_start(day: str) -> str:
    return f"CAST((CAST({day} AS TIMESTAMP) AT TIME ZONE 'Europe/Berlin') AT TIME ZONE 'UTC' AS TIMESTAMP)"


def win_end(day: str) -> str:
    return win_start(f"(CAST({day} AS DATE) + INTERVAL 1 DAY)")


def fct_sql() -> str:
    return with_ctes(ADAPTER, STAGING, MIX) + "\n" + settle(FCT_BODY, FCT_COLUMNS, FCT_DOUBLES)


def _stg_sql(view: str, measure: str, extra: list[str]) -> str:
    cols = ["zone_code", "ts_hour_utc", *extra, measure, "intervals_aggregated",
            "source_resolution_minutes", "ingested_at"]
    return with_ctes(ADAPTER, STAGING) + "\n" + settle(f"SELECT * FROM {view}", cols, [measure])


LATEST_LOAD = """
SELECT zone_code, ts_utc, resolution_minutes, load_mw, ingested_at, run_id
FROM (SELECT *, row_number() OVER (PARTITION BY zone_code, ts_utc
                                   ORDER BY ingested_at DESC, run_id DESC) AS rn
      FROM raw_load) r
WHERE rn = 1"""

NULL_RETRACTION = """
latest AS (
  SELECT zone_code, ts_utc, load_mw FROM (
    SELECT *, row_number() OVER (PARTITION BY zone_code, ts_utc
                                 ORDER BY ingested_at DESC, run_id DESC) AS rn
    FROM raw_load) r WHERE rn = 1),
valued AS (
  SELECT zone_code, ts_utc, load_mw FROM (
    SELECT *, row_number() OVER (PARTITION BY zone_code, ts_utc
                                 ORDER BY ingested_at DESC, run_id DESC) AS rn
    FROM raw_load WHERE load_mw IS NOT NULL) r WHERE rn = 1)"""

SERVED = ["zone_code", "ts_hour_utc", "date_local", "load_mw", "renewable_mw", "fossil_mw",
          "nuclear_mw", "total_generation_mw", "renewable_pct", "residual_load_mw",
          "carbon_intensity_g_kwh", "price_eur_mwh"]
SERVED_DOUBLES = [c for c in SERVED if c in FCT_DOUBLES]

PAGE_FILTER = ("zone_code = 'DE_LU' AND ts_hour_utc >= TIMESTAMP '2024-01-08 00:00:00' "
               "AND ts_hour_utc < TIMESTAMP '2024-01-15 00:00:00'")
PAGE_LIMIT = 50


def _page_select(source: str) -> str:
    cursor = ("replace(replace(to_base64(encode(strftime(max(ts_hour_utc) OVER (), "
              "'%Y-%m-%dT%H:%M:%S') || '+00:00')), '+', '-'), '/', '_')")
    body = (f"SELECT *, CAST(count(*) OVER () AS BIGINT) AS page_count, "
            f"CASE WHEN count(*) OVER () = {PAGE_LIMIT} THEN {cursor} END AS next_cursor FROM {source}")
    return settle(body, SERVED + ["page_count", "next_cursor"], SERVED_DOUBLES)


def page_sql() -> str:
    page = (f"page AS (SELECT {', '.join(SERVED)} FROM fct WHERE {PAGE_FILTER} "
            f"ORDER BY ts_hour_utc LIMIT {PAGE_LIMIT})")
    return with_ctes(ADAPTER, STAGING, MIX, FCT_CTE, page) + "\n" + _page_select("page")


def page_after_sql() -> str:
    p1 = (f"p1 AS (SELECT {', '.join(SERVED)} FROM fct WHERE {PAGE_FILTER} "
          f"ORDER BY ts_hour_utc LIMIT {PAGE_LIMIT})")
    p2 = (f"page AS (SELECT {', '.join(SERVED)} FROM fct WHERE {PAGE_FILTER} "
          f"AND (SELECT count(*) FROM p1) = {PAGE_LIMIT} "
          f"AND ts_hour_utc > (SELECT max(ts_hour_utc) FROM p1) "
          f"ORDER BY ts_hour_utc LIMIT {PAGE_LIMIT})")
    return with_ctes(ADAPTER, STAGING, MIX, FCT_CTE, p1, p2) + "\n" + _page_select("page")


def zones_sql() -> str:
    return with_ctes(ADAPTER, STAGING, MIX, FCT_CTE) + """
SELECT z.zone_code, z.zone_name, z.country, z.timezone,
       CAST(coalesce(c.fact_hours, 0) AS BIGINT) AS fact_hours, c.first_hour_utc, c.last_hour_utc
FROM dim_zone z
LEFT JOIN (SELECT zone_code, count(*) AS fact_hours, min(ts_hour_utc) AS first_hour_utc,
                  max(ts_hour_utc) AS last_hour_utc
           FROM fct GROUP BY zone_code) c USING (zone_code)
ORDER BY z.zone_code"""


def unpivot_sql() -> str:
    names = [t for _, t in TYPES_BY_EVENT]
    wide_cols = ", ".join(
        f"max(CASE WHEN production_type = {_q(n)} THEN value END) AS c{i}" for i, n in enumerate(names)
    )
    two = """
two AS (
  SELECT zone_code, ts_utc,
         CASE WHEN production_type LIKE '% Consumption'
              THEN substr(production_type, 1, length(production_type) - 12)
              ELSE production_type END AS name,
         CASE WHEN production_type LIKE '% Consumption' THEN 'Actual Consumption'
              ELSE 'Actual Aggregated' END AS measure,
         generation_mw AS value
  FROM raw_generation),
flat AS (
  SELECT zone_code, ts_utc,
         CASE WHEN measure = 'Actual Consumption' THEN name || ' Consumption' ELSE name END
           AS production_type, value
  FROM two)"""
    wide = f"wide AS (SELECT zone_code, ts_utc, {wide_cols} FROM flat GROUP BY zone_code, ts_utc)"
    body = " UNION ALL ".join(
        f"SELECT zone_code, ts_utc, {_q(n)} AS production_type, c{i} AS generation_mw FROM wide"
        for i, n in enumerate(names)
    )
    cols = ["zone_code", "ts_utc", "production_type", "generation_mw"]
    return with_ctes(ADAPTER, two, wide) + "\n" + settle(body, cols, ["generation_mw"])


def resolution_sql() -> str:
    return with_ctes(ADAPTER) + f"""
, stamps AS (
  SELECT DISTINCT zone_code, {BERLIN_DAY} AS market_day, ts_utc FROM raw_load WHERE ts_utc IS NOT NULL),
deltas AS (
  SELECT zone_code, market_day,
         epoch_us(ts_utc) - epoch_us(lag(ts_utc) OVER (PARTITION BY zone_code, market_day
                                                       ORDER BY ts_utc)) AS delta_us
  FROM stamps),
counted AS (
  SELECT zone_code, market_day, delta_us, count(*) AS n FROM deltas
  WHERE delta_us IS NOT NULL GROUP BY zone_code, market_day, delta_us),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY zone_code, market_day ORDER BY n DESC, delta_us ASC) AS rk
  FROM counted),
batches AS (SELECT DISTINCT zone_code, market_day FROM stamps)
SELECT b.zone_code, b.market_day,
       CAST(coalesce(floor(r.delta_us / 60000000), 60) AS BIGINT) AS resolution_minutes
FROM batches b LEFT JOIN ranked r
  ON r.zone_code = b.zone_code AND r.market_day = b.market_day AND r.rk = 1"""


LANDING_PRICE = f"""
lp1 AS (
  SELECT *, CASE WHEN event_id % 3 = 0 AND dayofmonth(market_day) % 2 = 1 THEN '15min' ELSE '60min' END
           AS series_resolution
  FROM (SELECT zone_code, ts_utc, price_eur_mwh, event_id, user_id, {BERLIN_DAY} AS market_day FROM raw_price) r),
lp2 AS (
  SELECT zone_code, ts_utc, price_eur_mwh, user_id, market_day, series_resolution FROM lp1
  UNION ALL
  SELECT zone_code, ts_utc, price_eur_mwh, user_id, CAST(market_day - INTERVAL 1 DAY AS DATE),
         series_resolution
  FROM lp1 WHERE ts_utc = {win_start('market_day')}),
lp3 AS (
  SELECT *, CAST((ts_utc AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS TIMESTAMP) AS local_ts
  FROM lp2),
landing_price AS (
  SELECT zone_code, market_day, price_eur_mwh, series_resolution, user_id,
         strftime(local_ts, '%Y-%m-%dT%H:%M:%S') ||
         printf('%s%02d:%02d',
                CASE WHEN epoch(local_ts) - epoch(ts_utc) < 0 THEN '-' ELSE '+' END,
                CAST(trunc(abs(epoch(local_ts) - epoch(ts_utc)) / 3600) AS INTEGER),
                CAST(trunc(abs(epoch(local_ts) - epoch(ts_utc)) / 60) AS INTEGER) % 60) AS ts
  FROM lp3),
landing_price_utc AS (
  SELECT zone_code, market_day, price_eur_mwh, series_resolution, user_id,
         CAST(CAST(ts AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS ts_utc
  FROM landing_price)"""


def first_series_sql() -> str:
    body = """
SELECT zone_code, market_day, price_eur_mwh, series_resolution, ts_utc FROM (
  SELECT *, min(pref) OVER (PARTITION BY zone_code, market_day) AS best FROM (
    SELECT *, CASE series_resolution WHEN '15min' THEN 1 WHEN '60min' THEN 2 ELSE 0 END AS pref
    FROM landing_price_utc) r
  WHERE pref > 0) b
WHERE pref = best"""
    cols = ["zone_code", "market_day", "price_eur_mwh", "series_resolution", "ts_utc"]
    return with_ctes(ADAPTER, LANDING_PRICE) + "\n" + settle(body, cols, ["price_eur_mwh"])


def end_boundary_sql() -> str:
    body = f"""
SELECT zone_code, market_day, ts_utc, price_eur_mwh, series_resolution FROM landing_price_utc
WHERE ts_utc < {win_end('market_day')}"""
    cols = ["zone_code", "market_day", "ts_utc", "price_eur_mwh", "series_resolution"]
    return with_ctes(ADAPTER, LANDING_PRICE) + "\n" + settle(body, cols, ["price_eur_mwh"])


DAYS = f"""
bounds AS (
  SELECT min(CAST((CAST(ts AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS DATE)) AS d0,
         max(CAST((CAST(ts AS TIMESTAMP) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Berlin' AS DATE)) AS d1
  FROM events),
days AS (
  SELECT CAST(d AS DATE) AS market_day
  FROM (SELECT unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP), INTERVAL 1 DAY)) AS d
        FROM bounds) g),
windows AS (
  SELECT market_day, {win_start('market_day')} AS window_start_utc,
         {win_end('market_day')} AS window_end_utc
  FROM days),
windows_h AS (
  SELECT *, CAST((epoch(window_end_utc) - epoch(window_start_utc)) / 3600 AS BIGINT) AS window_hours
  FROM windows)"""


def windows_sql() -> str:
    return with_ctes(DAYS) + "\nSELECT market_day, window_start_utc, window_end_utc, window_hours FROM windows_h"


EXPECTED = """
zones AS (
  SELECT trim(z) AS zone_code
  FROM (SELECT unnest(string_split('DE_LU, AT ,NL, FR, DK_1, DK_2', ',')) AS z) s
  WHERE trim(z) <> ''),
sources AS (SELECT * FROM (VALUES ('load'), ('generation'), ('price')) AS s(source)),
expected AS (
  SELECT s.source, z.zone_code, w.market_day, w.window_start_utc, w.window_end_utc, w.window_hours
  FROM windows_h w CROSS JOIN sources s CROSS JOIN zones z),
landed AS (
  SELECT source, zone_code, market_day, count(*) AS landed_rows FROM (
    SELECT 'load' AS source, zone_code, {day} AS market_day FROM raw_load
    UNION ALL SELECT 'generation', zone_code, {day} FROM raw_generation
    UNION ALL SELECT 'price', zone_code, {day} FROM raw_price) u
  GROUP BY source, zone_code, market_day)""".replace("{day}", BERLIN_DAY)


def job_grid_sql() -> str:
    return with_ctes(ADAPTER, DAYS, EXPECTED) + """
SELECT e.source, e.zone_code, e.market_day, e.window_start_utc, e.window_end_utc, e.window_hours,
       CAST(coalesce(l.landed_rows, 0) AS BIGINT) AS landed_rows
FROM expected e LEFT JOIN landed l USING (source, zone_code, market_day)"""


_CONTRACT = {
    # source: (raw view, measure, extra key column, low, high)
    "load": ("raw_load", "load_mw", None, 0, 150000),
    "generation": ("raw_generation", "generation_mw", "production_type", 0, 150000),
    "price": ("raw_price", "price_eur_mwh", None, -500, 4000),
}
BATCH_COLS = "source, zone_code, market_day, run_id"
CHECK_NAMES = ["bad_type", "null_required", "bad_zone", "out_of_range", "bad_resolution", "duplicate_keys"]


RUN = "zone_code || '|' || CAST(market_day AS VARCHAR) || '|' || CAST(user_id AS VARCHAR)"
BATCH_EQ = " AND ".join(f"{{a}}.{c} IS NOT DISTINCT FROM {{b}}.{c}" for c in BATCH_COLS.split(", "))


def contract_ctes(source: str) -> str:
    """The adapter's contract variant of a feed, then its flags and verdicts."""
    raw, measure, extra, _, _ = _CONTRACT[source]
    extra_sel = f"{extra}, " if extra else ""
    feed = f"""
cf_{source} AS (
  SELECT '{source}' AS source, zone_code, market_day, ts_utc, {extra_sel}
         CASE WHEN event_id % 499 <> 0 THEN {measure} END AS {measure}, event_id % 499 = 0 AS no_number,
         CASE WHEN event_id % 997 = 0 THEN CAST(30 AS BIGINT) ELSE resolution_minutes END AS resolution_minutes,
         {RUN} AS run_id
  FROM (SELECT *, {BERLIN_DAY} AS market_day FROM {raw}) r)"""
    return feed + "," + verdict_ctes(source, source, f"cf_{source}")


def landed_ctes(tag: str, source: str, rows: str) -> str:
    """Resolution per batch over normalised landed rows, then flags and verdicts (null keys are keys)."""
    keys = "zone_code, market_day, run_id"
    same = " AND ".join(f"n.{c} IS NOT DISTINCT FROM m.{c}" for c in keys.split(", "))
    return f"""
{tag}_deltas AS (
  SELECT {keys}, epoch_us(ts_utc) - epoch_us(lag(ts_utc) OVER (PARTITION BY {keys} ORDER BY ts_utc)) AS delta_us
  FROM (SELECT DISTINCT {keys}, ts_utc FROM {rows} WHERE ts_utc IS NOT NULL) d),
{tag}_mode AS (
  SELECT * FROM (
    SELECT {keys}, delta_us, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, delta_us ASC) AS rk
    FROM {tag}_deltas WHERE delta_us IS NOT NULL GROUP BY {keys}, delta_us) c
  WHERE rk = 1),
{tag}_prepared AS (
  SELECT '{source}' AS source, n.*, FALSE AS no_number,
         CAST(coalesce(floor(m.delta_us / 60000000), 60) AS BIGINT) AS resolution_minutes
  FROM {rows} n LEFT JOIN {tag}_mode m ON {same}),
""" + verdict_ctes(tag, source, f"{tag}_prepared")


def verdict_ctes(tag: str, source: str, rows: str) -> str:
    """Row flags ``fl_<tag>`` and batch verdicts ``verdict_<tag>`` over CTE ``rows``."""
    _, measure, extra, lo, hi = _CONTRACT[source]
    key = f"zone_code, ts_utc, {extra}" if extra else "zone_code, ts_utc"
    req = ["zone_code", "ts_utc", *([extra] if extra else []), "resolution_minutes", "run_id", "market_day"]
    return f"""
fl_{tag} AS (
  SELECT *,
    no_number AS bad_type,
    ({' OR '.join(f'{c} IS NULL' for c in req)}) AS null_required,
    (zone_code IS NOT NULL AND NOT regexp_matches(zone_code, '^[A-Z]{{2}}(_[A-Z0-9]+)?$')) AS bad_zone,
    ({measure} IS NOT NULL AND NOT ({measure} BETWEEN {lo} AND {hi})) AS out_of_range,
    (resolution_minutes IS NOT NULL AND resolution_minutes NOT IN (15, 60)) AS bad_resolution
  FROM {rows}),
vc_{tag} AS (
  SELECT {BATCH_COLS}, count(*) AS rows,
         count_if(bad_type) AS bad_type, count_if(null_required) AS null_required,
         count_if(bad_zone) AS bad_zone, count_if(out_of_range) AS out_of_range,
         count_if(bad_resolution) AS bad_resolution
  FROM fl_{tag} GROUP BY {BATCH_COLS}),
vd_{tag} AS (
  SELECT {BATCH_COLS}, count(*) AS duplicate_keys FROM (
    SELECT {BATCH_COLS}, {key}, count(*) AS c FROM fl_{tag}
    GROUP BY {BATCH_COLS}, {key} HAVING count(*) > 1) d
  GROUP BY {BATCH_COLS}),
v_{tag} AS (
  SELECT c.source, c.zone_code, c.market_day, c.run_id,
         CAST(c.rows AS BIGINT) AS rows, CAST(c.bad_type AS BIGINT) AS bad_type,
         CAST(c.null_required AS BIGINT) AS null_required, CAST(c.bad_zone AS BIGINT) AS bad_zone,
         CAST(c.out_of_range AS BIGINT) AS out_of_range,
         CAST(c.bad_resolution AS BIGINT) AS bad_resolution,
         CAST(coalesce(d.duplicate_keys, 0) AS BIGINT) AS duplicate_keys
  FROM vc_{tag} c LEFT JOIN vd_{tag} d ON {BATCH_EQ.format(a='c', b='d')}),
verdict_{tag} AS (
  SELECT *,
    ({' AND '.join(f'{k} = 0' for k in CHECK_NAMES)}) AS passed,
    NULLIF(concat_ws(',', {', '.join(f"CASE WHEN {k} > 0 THEN '{k}' END" for k in CHECK_NAMES)}), '')
      AS reason
  FROM v_{tag})"""


PRICE_NORMAL = f"""
lp_utc AS (
  SELECT zone_code, market_day, {RUN} AS run_id, price_eur_mwh, {{series}} AS series_resolution,
         CAST(CAST(ts AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS ts_utc
  FROM landing_price),
lp_pick AS (
  SELECT * FROM (
    SELECT *, min(pref) OVER (PARTITION BY zone_code, market_day, run_id) AS best FROM (
      SELECT *, CASE series_resolution WHEN '15min' THEN 1 WHEN '60min' THEN 2 ELSE 0 END AS pref
      FROM lp_utc) r
    WHERE pref > 0) b
  WHERE pref = best),
lp_bounded AS (
  SELECT zone_code, market_day, run_id, ts_utc, price_eur_mwh FROM lp_pick
  WHERE ts_utc < {win_end('market_day')}),
"""


def ingest_price_landing_sql() -> str:
    """Landed price text -> series choice -> end boundary -> resolution per batch ->
    contract -> accepted rows, summarised as bronze."""
    steps = PRICE_NORMAL.format(series="series_resolution") + landed_ctes("lp", "price", "lp_bounded")
    body = f"""
SELECT CAST(date_trunc('month', f.ts_utc) AS DATE) AS ts_month, f.zone_code, f.resolution_minutes,
       count(*) AS rows, count(DISTINCT f.run_id) AS runs,
       min(f.ts_utc) AS first_ts_utc, max(f.ts_utc) AS last_ts_utc
FROM fl_lp f
WHERE NOT EXISTS (SELECT 1 FROM verdict_lp v WHERE NOT v.passed AND {BATCH_EQ.format(a='v', b='f')})
GROUP BY 1, 2, 3"""
    return with_ctes(ADAPTER, LANDING_PRICE, steps) + body


def contract_violations_sql(source: str) -> str:
    return with_ctes(ADAPTER, contract_ctes(source)) + f"\nSELECT * FROM verdict_{source}"


def contract_valid_rows_sql() -> str:
    parts = []
    for source, (_, measure, extra, _, _) in _CONTRACT.items():
        pt = extra if extra else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT f.source, f.zone_code, f.market_day, f.run_id, f.ts_utc, {pt} AS production_type, "
            f"f.{measure} AS measure, f.resolution_minutes FROM fl_{source} f "
            f"WHERE NOT EXISTS (SELECT 1 FROM verdict_{source} v WHERE NOT v.passed "
            f"AND v.zone_code = f.zone_code AND v.market_day = f.market_day AND v.run_id = f.run_id)"
        )
    cols = ["source", "zone_code", "market_day", "run_id", "ts_utc", "production_type", "measure",
            "resolution_minutes"]
    ctes = [contract_ctes(s) for s in _CONTRACT]
    return with_ctes(ADAPTER, *ctes) + "\n" + settle(" UNION ALL ".join(parts), cols, ["measure"])


def _ledger_body() -> str:
    verdicts = " UNION ALL ".join(f"SELECT * FROM verdict_{s}" for s in _CONTRACT)
    return f"""
SELECT source, zone_code, market_day, run_id, rows,
       CAST(CASE WHEN passed THEN rows ELSE 0 END AS BIGINT) AS rows_loaded,
       CASE WHEN passed THEN 'loaded' ELSE 'rejected' END AS status, reason
FROM ({verdicts}) v
UNION ALL
SELECT e.source, e.zone_code, e.market_day, CAST(NULL AS VARCHAR), CAST(0 AS BIGINT),
       CAST(0 AS BIGINT), 'missing', 'no data for the requested window'
FROM expected e
WHERE NOT EXISTS (SELECT 1 FROM landed l WHERE l.source = e.source AND l.zone_code = e.zone_code
                  AND l.market_day = e.market_day)"""


def ledger_sql() -> str:
    ctes = [contract_ctes(s) for s in _CONTRACT]
    return with_ctes(ADAPTER, DAYS, EXPECTED, *ctes) + "\n" + _ledger_body()


def summary_sql() -> str:
    ctes = [contract_ctes(s) for s in _CONTRACT]
    return with_ctes(ADAPTER, DAYS, EXPECTED, *ctes, f"ledger AS ({_ledger_body()})") + """
SELECT source, count(DISTINCT zone_code) AS zones, count(*) AS batches,
       CAST(count_if(status <> 'loaded') AS BIGINT) AS failures, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded
FROM ledger GROUP BY source"""


def data_tests_sql() -> str:
    f, z, p = "fct_grid_hourly", "dim_zone", "dim_production_type"
    tests = [
        (f"not_null_{f}_zone_code", "SELECT count(*) FROM fct WHERE zone_code IS NULL"),
        (f"not_null_{f}_ts_hour_utc", "SELECT count(*) FROM fct WHERE ts_hour_utc IS NULL"),
        (f"not_null_{f}_load_mw", "SELECT count(*) FROM fct WHERE load_mw IS NULL"),
        ("assert_no_impossible_carbon_intensity",
         "SELECT count(*) FROM fct WHERE carbon_intensity_g_kwh < 0 OR carbon_intensity_g_kwh > 1100"),
        ("assert_renewable_pct_in_range",
         "SELECT count(*) FROM fct WHERE renewable_pct < 0 OR renewable_pct > 100"),
        (f"not_null_{z}_zone_code", "SELECT count(*) FROM dim_zone WHERE zone_code IS NULL"),
        (f"not_null_{z}_timezone", "SELECT count(*) FROM dim_zone WHERE timezone IS NULL"),
        (f"not_null_{p}_production_type",
         "SELECT count(*) FROM dim_production_type WHERE production_type IS NULL"),
        (f"accepted_values_{p}_category",
         "SELECT count(DISTINCT category) FROM dim_production_type WHERE category NOT IN "
         "('renewable', 'fossil', 'nuclear', 'storage', 'other')"),
        (f"accepted_values_{p}_flow_direction",
         "SELECT count(DISTINCT flow_direction) FROM dim_production_type "
         "WHERE flow_direction NOT IN ('generation', 'consumption')"),
        (f"relationships_{f}_zone_code__{z}",
         "SELECT count(*) FROM fct c WHERE c.zone_code IS NOT NULL AND c.zone_code NOT IN "
         "(SELECT zone_code FROM dim_zone)"),
        (f"unique_combination_{f}_zone_code__ts_hour_utc",
         "SELECT count(*) FROM (SELECT zone_code, ts_hour_utc FROM fct GROUP BY ALL HAVING count(*) > 1) d"),
        (f"unique_{z}_zone_code",
         "SELECT count(*) FROM (SELECT zone_code FROM dim_zone WHERE zone_code IS NOT NULL "
         "GROUP BY ALL HAVING count(*) > 1) d"),
        (f"unique_{p}_production_type",
         "SELECT count(*) FROM (SELECT production_type FROM dim_production_type "
         "WHERE production_type IS NOT NULL GROUP BY ALL HAVING count(*) > 1) d"),
    ]
    body = " UNION ALL ".join(
        f"SELECT {_q(n)} AS check_name, CAST(({q}) AS BIGINT) AS failing_rows" for n, q in tests
    )
    return with_ctes(ADAPTER, STAGING, MIX, FCT_CTE) + (
        f"\nSELECT check_name, failing_rows, failing_rows = 0 AS passed FROM ({body}) t"
    )


def freshness_sql() -> str:
    nows = ["2024-01-31 00:00:00", "2024-02-01 06:00:00", "2024-02-03 00:00:00"]
    parts = []
    for source, (raw, _, _, _, _) in _CONTRACT.items():
        for n in nows:
            parts.append(
                f"SELECT '{source}' AS source, TIMESTAMP '{n}' AS checked_at, "
                f"(SELECT max(ingested_at) FROM {raw} WHERE ts_utc >= TIMESTAMP '{n}' - INTERVAL 30 DAY) "
                f"AS max_loaded_at"
            )
    age = "(epoch_us(checked_at) - epoch_us(max_loaded_at)) / 3600000000.0"
    body = f"""
SELECT source, checked_at, max_loaded_at, {age} AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN {age} > 48 THEN 'error' WHEN {age} > 26 THEN 'warn' ELSE 'pass' END AS status
FROM ({' UNION ALL '.join(parts)}) f"""
    cols = ["source", "checked_at", "max_loaded_at", "age_hours", "status"]
    return with_ctes(ADAPTER) + "\n" + settle(body, cols, ["age_hours"])


def bronze_roundtrip_sql() -> str:
    tables = {"load": "raw_load", "generation": "raw_generation", "price": "raw_day_ahead_price"}
    parts = []
    for source in _CONTRACT:
        parts.append(
            f"SELECT '{tables[source]}' AS \"table\", "
            f"CAST(date_trunc('month', f.ts_utc) AS DATE) AS ts_month, f.zone_code, f.ts_utc, f.run_id "
            f"FROM fl_{source} f WHERE NOT EXISTS (SELECT 1 FROM verdict_{source} v WHERE NOT v.passed "
            f"AND v.zone_code = f.zone_code AND v.market_day = f.market_day AND v.run_id = f.run_id)"
        )
    ctes = [contract_ctes(s) for s in _CONTRACT]
    return with_ctes(ADAPTER, *ctes) + f"""
SELECT "table", ts_month, zone_code, count(*) AS rows, min(ts_utc) AS first_ts_utc,
       max(ts_utc) AS last_ts_utc, count(DISTINCT run_id) AS runs,
       TIMESTAMP '2024-02-01 06:00:00' AS first_ingested_at, TIMESTAMP '2024-02-01 06:00:00' AS last_ingested_at
FROM ({' UNION ALL '.join(parts)}) b
GROUP BY "table", ts_month, zone_code"""


GENERATION_NORMAL = f"""
lg_text AS (
  SELECT zone_code, market_day, {RUN} AS run_id, strftime(ts_utc, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS ts,
         CASE WHEN production_type LIKE '% Consumption'
              THEN substr(production_type, 1, length(production_type) - 12)
              ELSE production_type END AS name,
         CASE WHEN production_type LIKE '% Consumption' THEN 'Actual Consumption'
              ELSE 'Actual Aggregated' END AS measure,
         generation_mw AS value
  FROM (SELECT *, {BERLIN_DAY} AS market_day FROM raw_generation) g),
lg_norm AS (
  SELECT zone_code, market_day, run_id,
         CAST(CAST(ts AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS ts_utc,
         CASE WHEN measure = 'Actual Consumption' THEN name || ' Consumption' ELSE name END
           AS production_type,
         value AS generation_mw
  FROM lg_text),
"""


def ingest_generation_landing_sql() -> str:
    """Landed two-level generation -> flatten -> resolution per batch -> contract -> bronze."""
    steps = GENERATION_NORMAL + landed_ctes("lg", "generation", "lg_norm")
    body = """
SELECT CAST(date_trunc('month', f.ts_utc) AS DATE) AS ts_month, f.zone_code, f.production_type,
       f.resolution_minutes, count(*) AS rows, count(DISTINCT f.run_id) AS runs,
       min(f.ts_utc) AS first_ts_utc, max(f.ts_utc) AS last_ts_utc,
       sum(f.generation_mw) AS generation_mwh_sum
FROM fl_lg f
WHERE NOT EXISTS (SELECT 1 FROM verdict_lg v WHERE NOT v.passed AND v.zone_code = f.zone_code
                  AND v.market_day = f.market_day AND v.run_id = f.run_id)
GROUP BY 1, 2, 3, 4"""
    cols = ["ts_month", "zone_code", "production_type", "resolution_minutes", "rows", "runs",
            "first_ts_utc", "last_ts_utc", "generation_mwh_sum"]
    return with_ctes(ADAPTER, steps) + "\n" + settle(
        body, cols, ["generation_mwh_sum"])


def landing_ledger_sql() -> str:
    """Every batch of the landed files with its outcome, the broken ones included."""
    load = f"""
ll_norm AS (
  SELECT CASE WHEN user_id % 10 <> 7 THEN zone_code END AS zone_code, market_day,
         CASE WHEN user_id % 25 <> 11 THEN {RUN} END AS run_id,
         CASE WHEN user_id % 10 <> 3 THEN ts_utc END AS ts_utc, load_mw
  FROM (SELECT *, {BERLIN_DAY} AS market_day FROM raw_load) r),
""" + landed_ctes("ll", "load", "ll_norm")
    price = PRICE_NORMAL.format(
        series="CASE WHEN user_id % 10 = 4 THEN '30min' ELSE series_resolution END"
    ) + landed_ctes("lp", "price", "lp_bounded")
    generation = GENERATION_NORMAL + landed_ctes("lg", "generation", "lg_norm")
    verdicts = " UNION ALL ".join(f"SELECT * FROM verdict_{t}" for t in ("ll", "lp", "lg"))
    return with_ctes(ADAPTER, LANDING_PRICE, load, price, generation) + f"""
SELECT source, zone_code, market_day, run_id, rows,
       CAST(CASE WHEN passed THEN rows ELSE 0 END AS BIGINT) AS rows_loaded,
       CASE WHEN passed THEN 'loaded' ELSE 'rejected' END AS status, reason
FROM ({verdicts}) v
UNION ALL
SELECT 'price', zone_code, market_day, run_id, count(*), CAST(0 AS BIGINT), 'missing', 'no price series'
FROM lp_utc GROUP BY zone_code, market_day, run_id
HAVING count_if(series_resolution IN ('15min', '60min')) = 0
UNION ALL
SELECT 'price', zone_code, market_day, run_id, count(*), CAST(0 AS BIGINT), 'empty', 'no price before the window end'
FROM lp_utc u
WHERE NOT EXISTS (SELECT 1 FROM lp_bounded b WHERE b.zone_code IS NOT DISTINCT FROM u.zone_code
                  AND b.market_day IS NOT DISTINCT FROM u.market_day AND b.run_id IS NOT DISTINCT FROM u.run_id)
GROUP BY zone_code, market_day, run_id
HAVING count_if(series_resolution IN ('15min', '60min')) > 0"""


def mart_retraction_sql() -> str:
    """The fact of all months but the one whose load was retracted."""
    body = FCT_BODY + "\nWHERE date_trunc('month', l.ts_hour_utc) <> TIMESTAMP '2024-02-01'"
    return with_ctes(adapter(4), STAGING, MIX) + "\n" + settle(body, FCT_COLUMNS, FCT_DOUBLES)


def refresh_by_key_sql() -> str:
    return with_ctes(adapter(4), STAGING, MIX) + "\n" + settle(FCT_BODY, FCT_COLUMNS, FCT_DOUBLES)


def publish_versions_sql() -> str:
    """What a reader planned before the second publish sees, and one planned after it."""
    cols = ["seen", "ts_month", "zone_code", "hours", "load_mw_sum", "price_hours"]

    def seen(name: str, where: str) -> str:
        return (f"SELECT '{name}' AS seen, CAST(date_trunc('month', ts_hour_utc) AS DATE) AS ts_month, zone_code, "
                "count(*) AS hours, sum(load_mw) AS load_mw_sum, count(price_eur_mwh) AS price_hours "
                f"FROM ({with_ctes(adapter(4, where), STAGING, MIX)} {FCT_BODY}) f GROUP BY ALL")

    return settle(f"{seen('before', 'event_id % 97 <> 0')} UNION ALL {seen('after', 'true')}", cols, ["load_mw_sum"])


def replay_sql() -> str:
    """The verdicts twice; a batch with a measure that was revised loads again, the others are replayed."""
    first = " UNION ALL ".join(f"SELECT * FROM verdict_{t}" for t in _CONTRACT)
    revised = " UNION ALL ".join(
        f"SELECT {BATCH_COLS}, bool_or(CAST(split_part(run_id, '|', 3) AS BIGINT) % 7 = 0 AND {m} > 1) AS revised "
        f"FROM cf_{t} GROUP BY {BATCH_COLS}" for t, (_, m, _, _, _) in _CONTRACT.items())
    return with_ctes(ADAPTER, *[contract_ctes(s) for s in _CONTRACT]) + f"""
SELECT 'first' AS job, {BATCH_COLS}, rows, CAST(CASE WHEN passed THEN rows ELSE 0 END AS BIGINT) AS rows_loaded,
       CASE WHEN passed THEN 'loaded' ELSE 'rejected' END AS status, reason
FROM ({first}) v
UNION ALL
SELECT 'second', {BATCH_COLS}, rows,
       CAST(CASE WHEN passed AND coalesce(revised, FALSE) THEN rows ELSE 0 END AS BIGINT),
       CASE WHEN NOT passed THEN 'rejected' WHEN coalesce(revised, FALSE) THEN 'loaded' ELSE 'replayed' END, reason
FROM ({first}) v JOIN ({revised}) r USING ({BATCH_COLS})"""


def scheduled_day_sql() -> str:
    """The ledger of one market day and the zones of the run; generation landed no file at all."""
    due = "market_day = DATE '2024-01-12' - 2 AND zone_code IN ('DE_LU', 'AT', 'NL', 'BE')"
    load = f"""
ll_norm AS (
  SELECT zone_code, market_day, {RUN} AS run_id, ts_utc, load_mw
  FROM (SELECT *, {BERLIN_DAY} AS market_day FROM raw_load) r WHERE {due}),
""" + landed_ctes("ll", "load", "ll_norm")
    price = PRICE_NORMAL.format(series="series_resolution").replace(
        "FROM landing_price)", f"FROM landing_price WHERE {due})") + landed_ctes("lp", "price", "lp_bounded")
    keys = "zone_code, market_day, run_id"
    return with_ctes(ADAPTER, LANDING_PRICE, load, price) + f"""
, wanted AS (
  SELECT source, zone_code, DATE '2024-01-12' - 2 AS market_day
  FROM (SELECT unnest(['load', 'generation', 'price']) AS source), (SELECT unnest(['DE_LU', 'AT', 'NL', 'BE']) AS zone_code)
), landed AS (
  SELECT DISTINCT 'load' AS source, zone_code FROM ll_norm UNION SELECT DISTINCT 'price', zone_code FROM lp_utc
)
SELECT {BATCH_COLS}, rows, CAST(CASE WHEN passed THEN rows ELSE 0 END AS BIGINT) AS rows_loaded,
       CASE WHEN passed THEN 'loaded' ELSE 'rejected' END AS status, reason
FROM (SELECT * FROM verdict_ll UNION ALL SELECT * FROM verdict_lp) v
UNION ALL
SELECT 'price', {keys}, count(*), CAST(0 AS BIGINT), 'empty', 'no price before the window end'
FROM lp_utc u WHERE NOT EXISTS (SELECT 1 FROM lp_bounded b WHERE b.zone_code = u.zone_code AND b.run_id = u.run_id)
GROUP BY {keys}
UNION ALL
SELECT source, zone_code, market_day, NULL, CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'missing', 'no data for the requested window'
FROM wanted WHERE (source, zone_code) NOT IN (SELECT (source, zone_code) FROM landed)"""


def landed_file_drift_sql() -> str:
    """Files told by their day; the batches of the sound files as in the ledger of landed files."""
    turn = "day(market_day) % 7"
    load = f"""
days_ll AS (SELECT *, {BERLIN_DAY} AS market_day FROM raw_load),
torn_ll AS (SELECT market_day, count(*) AS rows, count_if({turn} = 2 AND event_id % 13 = 0) AS torn FROM days_ll GROUP BY market_day),
ll_norm AS (
  SELECT zone_code, market_day, {RUN} AS run_id, ts_utc, load_mw FROM days_ll
  WHERE market_day IN (SELECT market_day FROM torn_ll WHERE torn = 0)),
""" + landed_ctes("ll", "load", "ll_norm")
    price = PRICE_NORMAL.format(series="series_resolution").replace(
        "FROM landing_price)", f"FROM landing_price WHERE {turn} > 1)") + landed_ctes("lp", "price", "lp_bounded")
    generation = GENERATION_NORMAL.replace("FROM lg_text)", f"FROM lg_text WHERE {turn} > 1)") + landed_ctes("lg", "generation", "lg_norm")
    verdicts = " UNION ALL ".join(f"SELECT * FROM verdict_{t}" for t in ("ll", "lp", "lg"))
    gone = "NULL AS zone_code, market_day, NULL AS run_id, rows, CAST(0 AS BIGINT), 'rejected'"
    return with_ctes(ADAPTER, LANDING_PRICE, load, price, generation) + f"""
SELECT {BATCH_COLS}, rows, CAST(CASE WHEN passed THEN rows ELSE 0 END AS BIGINT) AS rows_loaded,
       CASE WHEN passed THEN 'loaded' ELSE 'rejected' END AS status, reason, FALSE AS of_file
FROM ({verdicts}) v
UNION ALL
SELECT 'price', zone_code, market_day, run_id, count(*), CAST(0 AS BIGINT), 'empty', 'no price before the window end', FALSE
FROM lp_utc u WHERE NOT EXISTS (SELECT 1 FROM lp_bounded b WHERE b.zone_code = u.zone_code
                                AND b.market_day = u.market_day AND b.run_id = u.run_id)
GROUP BY zone_code, market_day, run_id
UNION ALL
SELECT 'load', {gone}, 'torn lines: ' || torn, TRUE FROM torn_ll WHERE torn > 0
UNION ALL
SELECT 'price', {gone}, CASE WHEN {turn} = 0 THEN 'missing column: price_eur_mwh' ELSE 'wrong type: price_eur_mwh is string' END, TRUE
FROM (SELECT market_day, count(*) AS rows FROM landing_price WHERE {turn} < 2 GROUP BY market_day) p
UNION ALL
SELECT 'generation', {gone}, CASE WHEN {turn} = 0 THEN 'missing column: measure' ELSE 'columns in another order' END, TRUE
FROM (SELECT market_day, count(*) AS rows FROM lg_text WHERE {turn} < 2 GROUP BY market_day) g"""


def oracle_sql() -> dict[str, str]:
    return {
        "q_landed_file_drift": landed_file_drift_sql(),
        "q_replay_safe_append": replay_sql(),
        "q_ingest_scheduled_day": scheduled_day_sql(),
        "q_refresh_by_key": refresh_by_key_sql(),
        "q_publish_versions": publish_versions_sql(),
        "q_fct_grid_hourly": fct_sql(),
        "q_stg_load_hourly": _stg_sql("stg_load", "load_mw", []),
        "q_stg_generation_hourly": _stg_sql("stg_generation", "generation_mw", ["production_type"]),
        "q_stg_price_hourly": _stg_sql("stg_price", "price_eur_mwh", []),
        "q_latest_revision": with_ctes(ADAPTER) + "\n" + settle(
            LATEST_LOAD,
            ["zone_code", "ts_utc", "resolution_minutes", "load_mw", "ingested_at", "run_id"],
            ["load_mw"],
        ),
        "q_null_retraction": with_ctes(ADAPTER, NULL_RETRACTION) + "\n" + settle(
            "SELECT l.zone_code, l.ts_utc, v.load_mw AS superseded_load_mw FROM latest l "
            "JOIN valued v USING (zone_code, ts_utc) WHERE l.load_mw IS NULL",
            ["zone_code", "ts_utc", "superseded_load_mw"], ["superseded_load_mw"],
        ),
        "q_generation_mix": with_ctes(ADAPTER, STAGING, MIX) + "\n" + settle(
            "SELECT * FROM generation_mix",
            ["zone_code", "ts_hour_utc", "renewable_mw", "fossil_mw", "nuclear_mw", "storage_mw",
             "other_mw", "total_generation_mw", "total_co2_kg"],
            ["renewable_mw", "fossil_mw", "nuclear_mw", "storage_mw", "other_mw",
             "total_generation_mw", "total_co2_kg"],
        ),
        "q_storage_draw": with_ctes(ADAPTER, STAGING, MIX) + "\n" + settle(
            "SELECT * FROM storage_draw",
            ["zone_code", "ts_hour_utc", "storage_consumption_mw"], ["storage_consumption_mw"],
        ),
        "q_fct_from_seed": fct_sql(),
        "q_zones": zones_sql(),
        "q_hourly_page": page_sql(),
        "q_hourly_page_after": page_after_sql(),
        "q_unpivot_generation": unpivot_sql(),
        "q_resolution_detect": resolution_sql(),
        "q_first_available_series": first_series_sql(),
        "q_market_day_windows": windows_sql(),
        "q_end_boundary": end_boundary_sql(),
        "q_job_grid": job_grid_sql(),
        "q_contract_violations_load": contract_violations_sql("load"),
        "q_contract_violations_generation": contract_violations_sql("generation"),
        "q_contract_violations_price": contract_violations_sql("price"),
        "q_contract_valid_rows": contract_valid_rows_sql(),
        "q_ingest_ledger": ledger_sql(),
        "q_ingest_summary": summary_sql(),
        "q_data_tests": data_tests_sql(),
        "q_freshness": freshness_sql(),
        "q_bronze_roundtrip": bronze_roundtrip_sql(),
        "q_incremental_mart": fct_sql(),
        "q_ingest_price_landing": ingest_price_landing_sql(),
        "q_ingest_generation_landing": ingest_generation_landing_sql(),
        "q_ingest_landing_ledger": landing_ledger_sql(),
        "q_mart_retraction": mart_retraction_sql(),
    }

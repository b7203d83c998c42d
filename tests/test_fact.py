"""Hand-made cases for the conform + fact semantics."""

import builders as B
import pytest

from gridmart import dims
from gridmart.operators import conform
from gridmart.operators.revisions import latest_revision, retracted_keys
from gridmart.plans.fact import build_fct, fct_from_bronze

H = "2026-08-01 10:00:00"


def _fct(spark, load_rows, gen_rows=(), price_rows=()):
    gen = B.generation(spark, list(gen_rows)) if gen_rows else B.empty_generation(spark)
    price = B.price(spark, list(price_rows)) if price_rows else B.empty_price(spark)
    return fct_from_bronze(spark, B.load(spark, list(load_rows)), gen, price)


def test_later_null_revision_retracts_the_value(spark):
    rows = [
        ("DE_LU", H, 60, 100.0, "2026-08-02 06:00:00", "r1"),
        ("DE_LU", H, 60, None, "2026-08-03 06:00:00", "r2"),
    ]
    stg = conform.stg_load(B.load(spark, rows))
    assert stg.count() == 0  # filtering nulls before ranking would bring 100.0 back
    [r] = retracted_keys(B.load(spark, rows), ["zone_code", "ts_utc"], "load_mw").collect()
    assert r["superseded_load_mw"] == 100.0


def test_latest_revision_keeps_newest_row(spark):
    rows = [
        ("AT", H, 60, 1.0, "2026-08-02 06:00:00", "r1"),
        ("AT", H, 60, 2.0, "2026-08-04 06:00:00", "r3"),
        ("AT", H, 60, 3.0, "2026-08-03 06:00:00", "r2"),
    ]
    [r] = latest_revision(B.load(spark, rows), ["zone_code", "ts_utc"]).collect()
    assert r["load_mw"] == 2.0 and r["run_id"] == "r3"


def test_switch_60_to_15_replaces_the_hourly_row(spark):
    rows = [("NL", H, 60, 400.0, "2026-08-02 06:00:00", "old")] + [
        ("NL", f"2026-08-01 10:{m:02d}:00", 15, v, "2026-08-03 06:00:00", "new")
        for m, v in [(0, 100.0), (15, 200.0), (30, 300.0), (45, 400.0)]
    ]
    [r] = conform.stg_load(B.load(spark, rows)).collect()
    assert r["load_mw"] == 250.0 and r["intervals_aggregated"] == 4 and r["source_resolution_minutes"] == 15


def test_switch_15_to_60_keeps_stale_quarter_hours_in_the_mean(spark):
    rows = [
        ("NL", f"2026-08-01 10:{m:02d}:00", 15, 100.0, "2026-08-02 06:00:00", "old") for m in (0, 15, 30, 45)
    ] + [("NL", H, 60, 500.0, "2026-08-03 06:00:00", "new")]
    [r] = conform.stg_load(B.load(spark, rows)).collect()
    # The on-the-hour row is replaced by the hourly one; 10:15-10:45 still count.
    assert r["intervals_aggregated"] == 4 and r["load_mw"] == pytest.approx((500 + 300) / 4)
    assert r["source_resolution_minutes"] == 60


def test_load_only_hour_has_null_mix_and_residual_equals_load(spark):
    [r] = _fct(spark, [("FR", H, 60, 50_000.0, "2026-08-02 06:00:00", "r")]).collect()
    assert r["renewable_mw"] is None and r["total_generation_mw"] is None and r["price_eur_mwh"] is None
    assert r["storage_consumption_mw"] is None and r["renewable_pct"] is None
    assert r["residual_load_mw"] == 50_000.0


def test_load_plus_price(spark):
    [r] = _fct(
        spark,
        [("FR", H, 60, 50_000.0, "2026-08-02 06:00:00", "r")],
        price_rows=[("FR", H, 60, -12.5, "2026-08-02 06:00:00", "p")],
    ).collect()
    assert r["price_eur_mwh"] == -12.5 and r["renewable_mw"] is None


def test_consumption_only_gives_null_mix_but_a_draw(spark):
    [r] = _fct(
        spark,
        [("AT", H, 60, 7_000.0, "2026-08-02 06:00:00", "r")],
        gen_rows=[("AT", H, 60, "Hydro Pumped Storage Consumption", 900.0, "2026-08-02 06:00:00", "g")],
    ).collect()
    assert r["total_generation_mw"] is None and r["renewable_mw"] is None
    assert r["storage_consumption_mw"] == 900.0


def test_mix_shares_intensity_and_absent_category_is_zero(spark):
    gen = [
        ("DE_LU", H, 60, "Solar", 300.0, "2026-08-02 06:00:00", "g"),
        ("DE_LU", H, 60, "Fossil Gas", 100.0, "2026-08-02 06:00:00", "g"),
        ("DE_LU", H, 60, "Fusion", 999.0, "2026-08-02 06:00:00", "g"),  # unknown: ignored
    ]
    [r] = _fct(spark, [("DE_LU", H, 60, 1_000.0, "2026-08-02 06:00:00", "r")], gen_rows=gen).collect()
    assert r["total_generation_mw"] == 400.0 and r["renewable_mw"] == 300.0 and r["fossil_mw"] == 100.0
    assert r["nuclear_mw"] == 0.0 and r["storage_consumption_mw"] is None
    assert r["renewable_pct"] == 75.0
    assert r["carbon_intensity_g_kwh"] == round((300 * 48 + 100 * 490) / 400, 1)
    assert r["residual_load_mw"] == 700.0


def test_unknown_zone_drops_the_hour(spark):
    assert _fct(spark, [("SE_3", H, 60, 1.0, "2026-08-02 06:00:00", "r")]).count() == 0


def test_local_calendar_columns(spark):
    [r] = _fct(spark, [("DE_LU", "2024-01-06 23:00:00", 60, 1.0, "2024-01-07 06:00:00", "r")]).collect()
    assert str(r["date_local"]) == "2024-01-07" and r["day_of_week_local"] == 1 and r["hour_utc"] == 23


def test_mix_in_one_pass_equals_two_separate_aggregations(spark):
    from gridmart.operators import mix

    gen = [
        ("DK_1", H, 60, "Wind Onshore", 10.0, "2026-08-02 06:00:00", "g"),
        ("DK_1", H, 60, "Hydro Pumped Storage Consumption", 4.0, "2026-08-02 06:00:00", "g"),
        ("DK_2", H, 60, "Solar Consumption", 2.0, "2026-08-02 06:00:00", "g"),
    ]
    stg = conform.stg_generation(B.generation(spark, gen))
    d = dims.dim_production_type(spark)
    both = {r["zone_code"]: r for r in mix.mix_and_draw(stg, d).collect()}
    sep_mix = {r["zone_code"]: r for r in mix.generation_mix(stg, d).collect()}
    sep_draw = {r["zone_code"]: r for r in mix.storage_draw(stg, d).collect()}
    assert both["DK_1"]["renewable_mw"] == sep_mix["DK_1"]["renewable_mw"] == 10.0
    assert both["DK_1"]["storage_consumption_mw"] == sep_draw["DK_1"]["storage_consumption_mw"] == 4.0
    assert "DK_2" not in sep_mix and both["DK_2"]["total_generation_mw"] is None
    assert "DK_2" not in sep_draw and both["DK_2"]["storage_consumption_mw"] is None


def test_replay_is_idempotent(spark):
    rows = [("AT", H, 60, 5.0, "2026-08-02 06:00:00", "r1")]
    replay = rows + [("AT", H, 60, 5.0, "2026-08-05 06:00:00", "r2")]
    a = B.collect_dicts(_fct(spark, rows).drop("load_intervals_aggregated"), ["zone_code", "ts_hour_utc"])
    b = B.collect_dicts(_fct(spark, replay).drop("load_intervals_aggregated"), ["zone_code", "ts_hour_utc"])
    assert a == b


def test_build_fct_has_the_eighteen_columns(spark):
    from gridmart.specs import FCT_COLUMNS

    df = build_fct(
        conform.stg_load(B.load(spark, [])),
        conform.stg_generation(B.empty_generation(spark)),
        conform.stg_price(B.empty_price(spark)),
        dims.dim_zone(spark),
        dims.dim_production_type(spark),
    )
    assert df.columns == FCT_COLUMNS


def test_nan_latest_revision_retracts_like_null(spark):
    rows = [
        ("DE_LU", H, 60, 100.0, "2026-08-02 06:00:00", "r1"),
        ("DE_LU", H, 60, float("nan"), "2026-08-03 06:00:00", "r2"),
        ("AT", H, 60, float("nan"), "2026-08-02 06:00:00", "r1"),
        ("AT", H, 60, 5.0, "2026-08-03 06:00:00", "r2"),
    ]
    got = {r["zone_code"]: r["load_mw"] for r in conform.stg_load(B.load(spark, rows)).collect()}
    assert got == {"AT": 5.0}

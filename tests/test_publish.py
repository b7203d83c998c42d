"""Publishing by versions: readers see whole versions, at any moment."""

from datetime import UTC, date, datetime

import builders as B
import pytest

from gridmart import session
from gridmart.operators import checks
from gridmart.plans.fact import fct_from_bronze
from gridmart.plans.publish import publish_fct
from gridmart.sources import mart

MONTHS = ("2024-01", "2024-02", "2024-03")


def fact(spark, mw, months=MONTHS):
    rows = [("DE_LU", f"{m}-10 05:00:00", 60, mw, f"{m}-11 00:00:00", "r") for m in months]
    return fct_from_bronze(spark, B.load(spark, rows), B.empty_generation(spark), B.empty_price(spark), with_month=True)


def seen(spark, path):
    return sorted((str(r["ts_month"]), r["load_mw"]) for r in mart.read_fct(spark, path).collect())


def test_a_reader_between_any_two_file_operations_sees_one_version(spark, monkeypatch):
    path = session.fresh_path(spark, "t-versions")
    publish_fct(spark, fact(spark, 1.0), path)
    states = []

    def watched(module, name):
        real = getattr(module, name)

        def run(*args, **kwargs):
            states.append(seen(spark, path))
            out = real(*args, **kwargs)
            states.append(seen(spark, path))
            return out

        monkeypatch.setattr(module, name, run)

    watched(session, "write_new_text")
    watched(session, "delete_path")
    watched(mart, "write_fct")
    whole = [[(f"{m}-01", mw) for m in MONTHS] for mw in (1.0, 2.0)]
    publish_fct(spark, fact(spark, 2.0), path)
    assert [s for s in states if s not in whole] == [] and states[0] == whole[0] and states[-1] == whole[1]
    states.clear()
    publish_fct(spark, fact(spark, 3.0, ["2024-02"]), path, [date(2024, 2, 1), date(2024, 3, 1)])  # March goes
    last = [("2024-01-01", 2.0), ("2024-02-01", 3.0)]
    assert {str(s) for s in states} == {str(whole[1]), str(last)} and len(states) > 4


def test_a_plan_made_before_a_publish_reads_its_own_version(spark):
    path = session.fresh_path(spark, "t-versions")
    publish_fct(spark, fact(spark, 1.0), path)
    old = mart.read_fct(spark, path)
    publish_fct(spark, fact(spark, 2.0), path)
    assert {r["load_mw"] for r in old.collect()} == {1.0}
    assert {r["load_mw"] for r in mart.read_fct(spark, path).collect()} == {2.0}


def test_the_fact_is_written_once_and_old_versions_go(spark, monkeypatch):
    path = session.fresh_path(spark, "t-versions")
    written = []
    real = mart.write_fct
    monkeypatch.setattr(mart, "write_fct", lambda df, p: (written.append(p), real(df, p)))
    for k in range(5):
        publish_fct(spark, fact(spark, float(k)), path)
    assert len(written) == 5
    kept = session.list_names(spark, f"{path}/data")
    assert len(kept) == mart.KEEP_VERSIONS and len(session.list_names(spark, f"{path}/_versions")) >= mart.KEEP_VERSIONS
    assert seen(spark, path) == [(f"{m}-01", 4.0) for m in MONTHS]
    # A month that a kept pointer names stays although its version is older.
    publish_fct(spark, fact(spark, 9.0, ["2024-02"]), path, [date(2024, 2, 1)])
    publish_fct(spark, fact(spark, 8.0, ["2024-02"]), path, [date(2024, 2, 1)])
    publish_fct(spark, fact(spark, 7.0, ["2024-02"]), path, [date(2024, 2, 1)])
    assert seen(spark, path) == [("2024-01-01", 4.0), ("2024-02-01", 7.0), ("2024-03-01", 4.0)]


def test_a_refused_version_leaves_no_files(spark):
    path = session.fresh_path(spark, "t-versions")
    publish_fct(spark, fact(spark, 1.0), path)
    bad = fact(spark, 1.0).withColumn("renewable_pct", checks.F.lit(101.0))
    with pytest.raises(checks.CheckFailed):
        publish_fct(spark, bad, path)
    with pytest.raises(checks.CheckFailed):
        publish_fct(spark, fact(spark, 1.0).limit(0), path)
    assert len(session.list_names(spark, f"{path}/data")) == 1 and len(seen(spark, path)) == 3


def test_two_publishers_cannot_take_the_same_number(spark):
    path = session.fresh_path(spark, "t-versions")
    a, b = mart.new_version(spark, path), mart.new_version(spark, path)
    mart.commit(spark, path, a, [date(2024, 1, 1)], None)
    with pytest.raises(FileExistsError):
        mart.commit(spark, path, b, [date(2024, 2, 1)], None)
    assert mart.published(spark, path) == {"2024-01-01": a}


def test_a_time_range_lists_only_its_months(spark):
    path = session.fresh_path(spark, "t-versions")
    publish_fct(spark, fact(spark, 1.0), path)
    feb = mart.read_fct(spark, path, datetime(2024, 2, 1, tzinfo=UTC), datetime(2024, 2, 20, tzinfo=UTC))
    assert [str(r["ts_month"]) for r in feb.collect()] == ["2024-02-01"]
    assert all("ts_month=2024-02-01" in f for f in feb.inputFiles())
    assert mart.read_fct(spark, session.fresh_path(spark, "no-mart")).collect() == []


def test_refresh_computes_only_the_hours_of_late_rows(spark):
    from gridmart.plans import queries as Q

    sf = "/root/testdata/sf0.001"
    got, (first, late) = Q.refresh_late_rows(spark, sf)
    assert [r.carried for r in first] == [0] and len(first[0].months) >= 4
    (report,) = late
    ev = Q.A.raw_load(spark, sf, months=4).filter(f"event_id % {Q.LATE_MOD} = 0")
    hours = ev.selectExpr("zone_code", "date_trunc('hour', ts_utc) AS h").distinct().count()
    assert report.keys == hours and 0 < report.computed <= hours
    assert report.computed + report.carried == got.count() and report.carried > 10 * report.computed

"""Batch contracts: one table of row faults, then what a verdict does to its batch."""

import pytest
from pyspark.sql import functions as F

from gridmart.operators import contracts as C
from gridmart.specs import SOURCES

BATCH = "source, zone_code, market_day, run_id"


def feed(spark, source, rows):
    """rows: (run, dict of overrides); measures are text, as files deliver them."""
    spec = SOURCES[source]
    base = {"source": source, "zone_code": "NL", "market_day": "2023-05-04", "ts_utc": "2023-05-04 06:00:00",
            "resolution_minutes": "60", "production_type": "Solar", "measure": "12.5", "undeclared": "x"}
    made = [{**base, "run_id": run, **over} for run, over in rows]
    names = [*base, "run_id"]
    df = spark.createDataFrame([tuple(m[n] for n in names) for m in made], ", ".join(f"{n} string" for n in names))
    df = df.withColumn("market_day", F.to_date("market_day")).withColumnRenamed("measure", spec.measure)
    return df if "production_type" in spec.contract.columns else df.drop("production_type")


def outcome(spark, source, rows):
    flagged = C.flag_rows(feed(spark, source, rows), SOURCES[source].contract)
    return {r["run_id"]: r for r in C.verdicts(flagged, SOURCES[source].contract).collect()}


# run -> (overrides of its only row, reason or None)
FAULTS = {
    "load": {
        "plain": ({}, None), "zero": ({"measure": "0"}, None), "top": ({"measure": "150000"}, None),
        "above": ({"measure": "150000.5"}, "out_of_range"), "below": ({"measure": "-0.1"}, "out_of_range"),
        "empty": ({"measure": None}, None), "nan": ({"measure": "NaN"}, None),
        "word": ({"measure": "much"}, "bad_type"), "quarter": ({"resolution_minutes": "15"}, None),
        "half": ({"resolution_minutes": "30"}, "bad_resolution"), "no time": ({"ts_utc": None}, "null_required"),
        "no clock": ({"ts_utc": "soon"}, "bad_type,null_required"), "lower": ({"zone_code": "nl"}, "bad_zone"),
        "no zone": ({"zone_code": None}, "null_required"), "no day": ({"market_day": None}, "null_required"),
        "two": ({"zone_code": "??", "measure": "1e9"}, "bad_zone,out_of_range"),
    },
    "price": {
        "negative": ({"measure": "-499.9"}, None), "floor": ({"measure": "-500"}, None),
        "under": ({"measure": "-501"}, "out_of_range"), "over": ({"measure": "4000.01"}, "out_of_range"),
    },
    "generation": {"no type": ({"production_type": None}, "null_required"), "any type": ({"production_type": "Tidal"}, None)},
}


@pytest.mark.parametrize("source", sorted(FAULTS))
def test_each_fault_rejects_its_own_batch_alone(spark, source):
    got = outcome(spark, source, [(run, over) for run, (over, _) in FAULTS[source].items()])
    reasons = {run: got[run]["reason"] for run in FAULTS[source]}
    # A stamp that cannot be read is both no timestamp and, once cast, missing.
    want = {run: reason for run, (_, reason) in FAULTS[source].items()}
    want = {k: ("bad_type" if v == "bad_type,null_required" else v) for k, v in want.items()}
    assert reasons == want and all(got[r]["passed"] == (want[r] is None) for r in want)


def test_one_type_twice_in_an_interval_collides_and_two_types_do_not(spark):
    got = outcome(spark, "generation", [
        ("twice", {}), ("twice", {"measure": "1"}), ("twice", {"ts_utc": "2023-05-04 07:00:00"}),
        ("both", {}), ("both", {"production_type": "Nuclear"})])
    assert (got["twice"]["duplicate_keys"], got["twice"]["reason"], got["twice"]["rows"]) == (1, "duplicate_keys", 3)
    assert got["both"]["passed"]


def test_only_declared_columns_remain_and_a_lacking_one_is_refused(spark):
    df = feed(spark, "load", [("r", {})])
    assert "undeclared" not in C.flag_rows(df, SOURCES["load"].contract).columns
    with pytest.raises(C.ContractError, match="resolution_minutes"):
        C.flag_rows(df.drop("resolution_minutes"), SOURCES["load"].contract)


ROWS = [("good", {}), ("bad", {}), ("bad", {"ts_utc": "2023-05-04 07:00:00", "measure": "-1"}),
        (None, {}), ("zoneless", {"zone_code": None})]


def test_rows_of_rejected_batches_are_held_back_null_keys_included(spark):
    contract = SOURCES["load"].contract
    flagged = C.flag_rows(feed(spark, "load", ROWS), contract)
    verdict = C.verdicts(flagged, contract)
    assert [r["run_id"] for r in C.valid_rows(flagged, verdict, contract).collect()] == ["good"]
    # Row mode keeps the sound row of the bad batch; a row without a key is never sound.
    by_row = C.valid_rows(flagged, verdict, contract, mode="row").collect()
    assert sorted(r["run_id"] for r in by_row) == ["bad", "good"]
    with pytest.raises(ValueError):
        C.valid_rows(flagged, verdict, contract, mode="other")


def test_ledger_and_summary_account_for_every_row(spark):
    contract = SOURCES["load"].contract
    verdict = C.verdicts(C.flag_rows(feed(spark, "load", ROWS), contract), contract)
    lost = spark.createDataFrame([("load", "AT", 3, "gone")], "source string, zone_code string, rows long, reason string")
    ledger = C.ledger(verdict, lost)
    assert ledger.agg(F.sum("rows"), F.sum("rows_loaded")).first() == (len(ROWS) + 3, 1)
    rows = {(r["run_id"], r["status"]): r["reason"] for r in ledger.collect()}
    assert rows[("good", "loaded")] is None and rows[("bad", "rejected")] == "out_of_range"
    assert rows[(None, "missing")] == "gone" and rows[("zoneless", "rejected")] == "null_required"
    s = C.summary(ledger).first()
    assert (s["zones"], s["batches"], s["failures"], s["rows_loaded"]) == (2, 5, 4, 1)

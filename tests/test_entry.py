"""The driver contract: entry, registry and oracles line up and agree."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from gridmart.plans import queries as Q  # noqa: E402
from check_oracles import TABLES, frame_hash  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_returns_the_fact(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["zone_code", "ts_hour_utc", "date_local"] and df.count() > 0


GRID = Q.registry()


def test_every_query_has_an_oracle():
    assert set(GRID) <= set(E.queries())
    assert set(GRID) == set(E.oracle_sql()) & set(GRID)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(GRID))
def test_query_matches_oracle(spark, duck, name):
    got = frame_hash(GRID[name](spark, SF).toPandas())
    want = frame_hash(duck.sql(E.oracle_sql()[name]).df())
    assert got == want

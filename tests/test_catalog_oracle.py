"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from runway.plans import catalog, oracle  # noqa: E402
from runway.sources.tables import TABLES  # noqa: E402
from tools.check_oracle import rows  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = catalog.QUERIES[name](spark, SF)
    got = rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = duck.execute(oracle.oracle_sql()[name])
    cols = [c[0] for c in res.description]
    want = rows(cols, res.fetchall())
    assert sorted(sdf.columns) == sorted(cols)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 51
    assert df.count() >= 0


def test_all_three_station_rules_select_stations(spark):
    from runway.operators import features
    sf = "/root/testdata/sf0.01"            # the smallest tables that have stations without a call sign
    legs = catalog._prepared(spark, sf, prior=False)
    rules = {r["code"]: r["rule"] for r in features.other_end_rules(legs, catalog._stations(spark, sf), catalog.PARAMS).collect()}
    matched = {r["code"] for r in catalog.QUERIES["station_match"](spark, sf).collect()}
    assert {rules[c] for c in matched} == {"hub", "city", "call"}

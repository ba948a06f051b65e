"""Plan-shape guards for every registered query of the library (sf0.001 tables).

The plan of every job that a query runs, its written intermediate tables included,
is looked at: none may pair every row with every row (nested-loop or Cartesian
joins) or deal rows round-robin, and every scan of a test table must be pruned.
"""

import os
import re

import pytest

from runway.plans import catalog
from runway.sources import sinks

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
# queries whose result is whole rows of the raw tables
WHOLE_ROWS = {"scan_flights", "scan_weather_pred", "select_weather"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans of all intermediate tables that are written meanwhile."""
    found, keep = [], sinks.write_replace

    def noted(df, *args, **kwargs):
        found.append(_plan(df))
        return keep(df, *args, **kwargs)

    monkeypatch.setattr(sinks, "write_replace", noted)
    return found


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plans_of_all_stages(spark, plans, name):
    df = catalog.QUERIES[name](spark, SF)
    for plan in [*plans, _plan(df)]:
        assert "BroadcastNestedLoopJoin" not in plan
        assert "CartesianProduct" not in plan
        assert "RoundRobinPartitioning" not in plan
        for line in plan.splitlines():
            scan = re.search(r"FileScan parquet \[(.*?)\].*/lineitem.parquet", line)
            if scan and name not in WHOLE_ROWS:
                assert len(scan[1].split(",")) < 13, line   # lineitem has more columns than any job reads
                assert "l_linestatus" not in scan[1] and "l_comment" not in scan[1]


def test_feature_job_scans_each_input_once(spark, plans):
    df = catalog.QUERIES["union_features"](spark, SF)
    scans = re.findall(r"/(\w+)\.parquet", "\n".join(line for p in [*plans, _plan(df)] for line in p.splitlines()
                                                     if "FileScan" in line and "testdata" in line))
    assert scans.count("lineitem") == 1
    assert scans.count("events") <= 2           # the reports and the station list, which the stand-in derives from them


def test_filters_and_pruning_reach_the_scan(spark):
    text = _plan(catalog.QUERIES["delays_by_carrier"](spark, SF))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans
    for line in scans:
        # the carrier count reads keys and dates only: no tax, price or flag columns
        for col in ("l_tax", "l_extendedprice", "l_returnflag", "l_linestatus"):
            assert col not in line
    assert "PushedFilters" in _plan(catalog.QUERIES["filter_like_infix"](spark, SF))

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import FLIGHT_SCHEMA, leg
from runway.operators import flights
from runway.operators.features import FINAL_COLUMNS
from runway.sources import standins

SF = "/root/testdata/sf0.001"


def test_drops_cancelled_diverted_and_null_flags(spark):
    df = spark.createDataFrame([
        leg("L1", "JFK", "BOS", "2018-01-02", 600, 700),
        leg("L2", "JFK", "BOS", "2018-01-02", 700, 800, cancelled=1.0),
        leg("L3", "JFK", "BOS", "2018-01-02", 800, 900, diverted=1.0),
        leg("L4", "JFK", "BOS", "2018-01-02", 900, 1000, diverted=None),
    ], FLIGHT_SCHEMA)
    out = flights.normalise_flights(df, tie_breakers=("LEG_ID",), keep=("LEG_ID",))
    assert [r[0] for r in out.select("LEG_ID").collect()] == ["L1"]
    assert out.columns[:35] == flights.FLIGHT_COLUMNS


def test_contract_types_and_values(spark):
    df = spark.createDataFrame([leg("L1", "JFK", "STL", "2018-01-02", 5, 2400, carrier_op=None,
                                    dep_blk="0001-0559", arr_blk="")], FLIGHT_SCHEMA)
    r = flights.normalise_flights(df).first()
    assert r["YEAR"] == "2018" and r["DAY_OF_WEEK"] == "2" and r["DISTANCE_GROUP"] == "2"
    assert r["FL_PATH"] == "JFK-STL"
    assert r["OP_CARRIER_FL_NUM"] is None           # NULL carrier part -> NULL key
    assert r["CRS_DEP_TIMESTAMP"] == dt.datetime(2018, 1, 2, 0, 5)
    assert r["CRS_ARR_TIMESTAMP"] is None and r["CRS_ARR_TIME_HOUR"] == 24
    assert r["DEP_TIME_HOUR"] == 0 and r["ARR_TIME_HOUR"] is None
    assert r["DEP_DEL15"] == "0.0" and r["ARR_DEL15"] == "0.0"


def test_previous_leg_flag_per_tail(spark):
    df = spark.createDataFrame([
        leg("L1", "JFK", "BOS", "2018-01-02", 600, 700, tail="N1", arr_del15=0.0),
        leg("L2", "BOS", "JFK", "2018-01-02", 900, 1000, tail="N1", arr_del15=1.0),
        leg("L3", "JFK", "BOS", "2018-01-03", 600, 700, tail="N1", arr_del15=0.0),
        leg("L4", "JFK", "BOS", "2018-01-02", 600, 700, tail=None, arr_del15=1.0),
        leg("L5", "BOS", "JFK", "2018-01-02", 1200, 1300, tail=None, arr_del15=0.0),
    ], FLIGHT_SCHEMA)
    out = flights.normalise_flights(df, tie_breakers=("LEG_ID",), keep=("LEG_ID",))
    got = dict((r[0], r[1]) for r in out.select("LEG_ID", "PR_ARR_DEL15").collect())
    assert got == {"L1": None, "L2": "0.0", "L3": "1.0", "L4": None, "L5": "1.0"}


def _random_legs(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = rnd.choice(["HOT"] * 6 + [None] * 3 + [f"T{k}" for k in range(20)])
        t = None if rnd.random() < 0.02 else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 40))
        v = rnd.choice(["0.0", "1.0", None])
        rows.append((key, t, f"{i:06d}", v))
    return spark.createDataFrame(rows, "k string, t timestamp_ntz, tie string, v string")


def _same_as_plain(df, ranges, order=("t", "tie")):
    plain = df.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy(*order)))
    cut = flights.lag_by(df, "v", "k", list(order), "p", ranges=ranges)
    assert cut.columns == plain.columns
    assert sorted(map(tuple, cut.select("tie", "p").collect()), key=str) == sorted(map(tuple, plain.select("tie", "p").collect()), key=str)


def test_lag_by_equals_plain_window(spark):
    _same_as_plain(_random_legs(spark), 60)
    _same_as_plain(_random_legs(spark, n=400, seed=3), 1)
    _same_as_plain(_random_legs(spark, n=0), 4)


def _one_key(spark, kind, n=20_000):
    t = {"one timestamp": F.when(F.col("id") % 20 < 19, F.lit("2024-01-01 10:00:00")).otherwise(F.lit("2024-01-02 10:00:00")),
         "no timestamp": F.lit(None)}.get(kind, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")))
    return spark.range(n).select(
        F.lit(None).cast("string").alias("k"), t.cast("string" if kind == "text" else "timestamp_ntz").alias("t"),
        F.lpad(((F.col("id") * 7919) % n).cast("string"), 6, "0").alias("tie"), (F.col("id") % 3).cast("string").alias("v"))


@pytest.mark.parametrize("kind", ["one timestamp", "no timestamp", "text"])
def test_lag_by_ranges_of_a_hot_key_are_bounded(spark, kind, monkeypatch):
    df, seen = _one_key(spark, kind), []
    keep = flights.materialise
    monkeypatch.setattr(flights, "materialise", lambda s, x, name: seen.append(keep(s, x, name)) or seen[-1])
    _same_as_plain(df, 40)
    largest = seen[1].groupBy("k", "_range").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 20_000 / 40


@pytest.mark.parametrize("order", [("t",), ("t", "tie")])
def test_ties_without_tie_breakers_are_cut_evenly_and_fixed(spark, order, monkeypatch):
    n = 20_000
    df = spark.range(n).select(
        F.when(F.col("id") % 20 == 0, F.lit("N1")).alias("k"), F.lit(None).cast("timestamp_ntz").alias("t"),
        F.when(F.col("id") % 2 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("tie"),
        F.when(F.col("id") % 2 == 0, F.lit("1.0")).otherwise((F.col("id") % 7).cast("string")).alias("v"))
    seen, keep = [], flights.materialise
    monkeypatch.setattr(flights, "materialise", lambda s, x, name: seen.append(keep(s, x, name)) or seen[-1])
    results = [sorted(map(tuple, flights.lag_by(df.repartition(p), "v", "k", list(order), "p", ranges=r).collect()), key=str) for p, r in ((3, 40), (11, 16))]
    assert results[0] == results[1] and len(results[0]) == n
    assert sum(row[-1] is None for row in results[0]) == 2              # the first leg of each tail
    for table, ranges in ((seen[1], 40), (seen[3], 16)):
        assert table.groupBy("k", "_range").count().agg(F.max("count")).first()[0] <= 2 * n / ranges


def _plan_lines(df):
    return df._jdf.queryExecution().executedPlan().toString().split("\n")


def test_lag_by_moves_only_the_columns_of_the_order(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = _random_legs(spark, n=500, seed=9).withColumn("ballast", F.concat("tie", F.lit(" and more")))
        lines = _plan_lines(flights.lag_by(df, "v", "k", ["t", "tie"], "p", ranges=6))
        depth = lambda line: len(line) - len(line.lstrip(" :+-"))
        at = next(i for i, x in enumerate(lines) if "FileScan" in x and "ballast" in x)
        above, least = [], depth(lines[at])
        for line in reversed(lines[:at]):
            if depth(line) < least:
                above, least = [*above, line], depth(line)
        assert above and not [x for x in above if "Exchange" in x or "Sort" in x]
        _same_as_plain(df, 6)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lag_by_over_batches_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(flights, "PIECE_BITS", 5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = _random_legs(spark, n=700, seed=4)
        _same_as_plain(df, 5)
        copies = df.limit(40).unionByName(df.limit(40))           # rows alike in all columns
        got = [r["p"] for r in flights.lag_by(copies, "v", "k", ["t", "tie"], "p", ranges=3).collect()]
        plain = copies.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("t", "tie")))
        assert sorted(got, key=str) == sorted((r["p"] for r in plain.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_legs_meet_orders_that_know_their_customers(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    lines = _plan_lines(standins.flights_raw(spark, SF))
    at = {t: next(i for i, x in enumerate(lines) if "FileScan" in x and t in x) for t in ("l_orderkey", "o_orderkey", "c_custkey")}
    join = next(i for i, x in enumerate(lines) if "Join [o_custkey" in x)
    assert at["l_orderkey"] < join < at["o_orderkey"] < at["c_custkey"]      # the join is beside the lines, not above them


def test_final_columns_list():
    assert len(FINAL_COLUMNS) == 51 and len(set(FINAL_COLUMNS)) == 51
    assert len(flights.FLIGHT_COLUMNS) == 35

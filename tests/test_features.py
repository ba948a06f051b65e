import datetime as dt

from fixtures import FLIGHT_SCHEMA, REPORT_SCHEMA, leg, report
from runway.operators import features
from runway.params import JobParams

P = JobParams(airport="JFK", train_start="2018-01-01", train_end="2018-01-10")


def _inputs(spark):
    flights = spark.createDataFrame([
        leg("L1", "JFK", "BOS", "2018-01-02", 510, 640, tail="N1"),
        leg("L2", "BOS", "JFK", "2018-01-02", 900, 1010, tail="N1", arr_del15=1.0),
        leg("L3", "JFK", "STL", "2018-01-02", 1200, 1400, tail="N2"),
        leg("L4", "JFK", "BOS", "2018-01-01", 510, 640, tail="N3"),   # start day: dropped
        leg("L5", "JFK", "BOS", "2018-01-10", 510, 640, tail="N3"),   # end day: dropped
        leg("L6", "BOS", "PWM", "2018-01-02", 510, 640, tail="N4"),   # does not touch JFK
        leg("L7", "JFK", "BOS", "2018-01-03", 510, 640, tail="N5", cancelled=1.0),
        leg("L8", "JFK", "PWM", "2018-01-02", 1500, 1655, tail="N6"),
    ], FLIGHT_SCHEMA)
    weather = spark.createDataFrame([
        report("J", "2018-01-02 05:10:00", "JFK INTERNATIONAL AIRPORT, NY US", "KJFK", tmp="+0056,1"),
        report("J", "2018-01-02 05:40:00", "JFK INTERNATIONAL AIRPORT, NY US", "KJFK", tmp="+0066,1"),
        report("B", "2018-01-02 06:20:00", "BOSTON LOGAN AIRPORT, MA US", "KBOS", tmp="+0010,1"),
        report("S", "2018-01-02 14:05:00", "ST. LOUIS LAMBERT AIRPORT, MO US", None, tmp="+0100,1"),
        report("B", "2018-01-02 09:20:00", "BOSTON LOGAN AIRPORT, MA US", "KBOS", tmp="+0020,1"),
        report("P", "2018-01-02 16:59:00", "PORTLAND JETPORT AIRPORT, ME US", "KPWM ", tmp="+0000,1"),
        report("Q", "2018-01-02 16:01:00", "WESTBROOK AIRPORT, ME US", "KPWMX", tmp="+0020,1"),
    ], REPORT_SCHEMA)
    stations = spark.createDataFrame([("J", "KJFK"), ("B", "KBOS"), ("S", None), ("P", "KPWM ")],
                                     "STATION string, CALL_SIGN string")
    return flights, weather, stations


def test_feature_tables(spark):
    flights, weather, stations = _inputs(spark)
    dep, arr = features.feature_tables(flights, weather, stations, P, tie_breakers=("LEG_ID",))
    assert dep.columns == features.FINAL_COLUMNS and arr.columns == features.FINAL_COLUMNS
    d = {r["OP_CARRIER_FL_NUM"] + r["DEST"]: r for r in dep.collect()}
    assert len(d) == 3                                   # L1, L3, L8 (left joins keep every leg)
    l1 = d["AA_100BOS"]
    assert l1["dep_time"] == dt.datetime(2018, 1, 2, 5)
    assert round(l1["dep_avg_temp_f"], 6) == round((42.08 + 43.88) / 2, 6)   # local, pooled
    assert round(l1["arr_avg_temp_f"], 6) == 33.8          # BOS: hub, by station name, 06:00
    l3 = d["AA_100STL"]
    assert l3["dep_avg_temp_f"] is None                     # no JFK report at 12:00
    assert round(l3["arr_avg_temp_f"], 6) == 50.0           # STL: no call sign, by city, 14:00
    l8 = d["AA_100PWM"]
    assert round(l8["arr_avg_temp_f"], 6) == 33.8           # PWM: call sign, both stations pooled
    a = arr.collect()
    assert len(a) == 1 and a[0]["ORIGIN"] == "BOS" and a[0]["PR_ARR_DEL15"] == "0.0"
    assert round(a[0]["dep_avg_temp_f"], 6) == 35.6          # BOS weather at 09:00
    u = features.union_features(dep, arr)
    assert u.count() == 4 and set(r["side"] for r in u.collect()) == {"dep", "arr"}


def test_write_feature_tables_round_trip(spark):
    from runway.session import shared_path
    flights, weather, stations = _inputs(spark)
    dep, arr = features.feature_tables(flights, weather, stations, P, tie_breakers=("LEG_ID",))
    paths = features.write_feature_tables(dep, arr, shared_path(spark, "features"), "JFK")
    back = spark.read.parquet(paths["dep"])
    assert back.count() == dep.count() == 3
    assert set(back.columns) == set(features.FINAL_COLUMNS)
    assert spark.read.parquet(paths["arr"]).where("MONTH = '1'").count() == 1

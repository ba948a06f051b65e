import os

from fixtures import FLIGHT_SCHEMA, REPORT_SCHEMA, leg, report, rows
from runway import jobs
from runway.params import FINAL_COLUMNS, JobParams
from runway.session import shared_path
from runway.sources.sinks import read_current


def test_feature_and_route_jobs_from_parquet(spark):
    base = shared_path(spark, "job-test")
    spark.createDataFrame([leg("L1", "JFK", "BOS", "2018-01-02", 510, 640),
                           leg("L2", "BOS", "JFK", "2018-01-02", 900, 1010),
                           leg("L3", "BOS", "PWM", "2018-01-02", 900, 1010, delay=30.0)],
                          FLIGHT_SCHEMA).write.parquet(f"{base}/flights")
    spark.createDataFrame([report("J", "2018-01-02 05:10:00", "JFK INTERNATIONAL AIRPORT, NY US", "KJFK")],
                          REPORT_SCHEMA).write.parquet(f"{base}/weather")
    spark.createDataFrame([("J", "KJFK")], "STATION string, CALL_SIGN string").write.parquet(f"{base}/stations")
    params = JobParams(airport="JFK", train_start="2018-01-01", train_end="2018-01-10")
    paths = jobs.run_features(spark, f"{base}/flights", f"{base}/weather", f"{base}/stations",
                              params, f"{base}/out", tie_breakers=("LEG_ID",))
    dep = read_current(spark, paths["dep"])
    assert dep.count() == 1 and set(dep.columns) == set(FINAL_COLUMNS)
    assert dep.first()["dep_avg_temp_f"] is not None
    r = jobs.run_routes(spark, f"{base}/flights", "JFK", f"{base}/routes", mid="BOS", end="JFK")
    ranks = read_current(spark, r["pagerank"]).collect()
    assert {x["id"] for x in ranks} == {"JFK", "BOS"}         # PWM is no origin: not a vertex
    assert [tuple(x) for x in read_current(spark, r["delays"]).collect()] == [("AA", 1)]
    assert rows(read_current(spark, r["means"])) == [("JFK", "MA", "BOS", 10.0)]
    assert read_current(spark, r["motif"]).columns == ["a", "n_paths"]

    e = jobs.run_explore(spark, f"{base}/out", "JFK", f"{base}/explore")
    got = {k: rows(read_current(spark, p)) for k, p in e.items() if k != "delay_sketches"}
    assert got["delays_by_carrier"] == [("AA", 1)] and got["delays_into_by_carrier"] == [("AA", 1)]
    assert got["delays_by_weekday_dst"] == [("2", "BOS", 1)] and got["delays_by_weekday_src"] == [("2", "BOS", 1)]
    assert got["mean_delay_by_path"] == [("JFK-BOS", 10.0)]
    assert got["carrier_stats"] == [("AA", 10.0, 10.0, 1, 10.0)]
    assert got["carrier_share"] == [("AA", 1, 100.0, 100.0)] and got["carrier_mean_clipped"] == [("AA", 10.0, 10.0)]
    assert got["delay_distribution"] == [("AA", 0.0, 1)] and got["delay_quantiles"] == [("AA", 1, 10.0, 10.0, 10.0)]
    n = sum(f.dataType.simpleString() == "double" for f in dep.schema.fields)
    assert len(got["correlation_dep"]) == len(got["correlation_arr"]) == n * n
    before = [p for p in os.listdir(os.path.dirname(base.removeprefix("file:"))) if p.startswith("runway-")]
    jobs.run_explore(spark, f"{base}/out", "JFK", f"{base}/explore")          # replaces, leaves no intermediate table
    assert sorted(before) == sorted(p for p in os.listdir(os.path.dirname(base.removeprefix("file:"))) if p.startswith("runway-"))

"""Batch job entry points (``spark-submit -m runway`` or ``python -m runway``).

``features``: the delay-feature job for one airport - reads the flight,
weather and station tables, builds the departure and arrival feature tables,
and replaces them under ``--out`` (one pair of Parquet datasets per airport).

``explore``: the numbers behind the reference's exploration of those feature
tables - delayed legs per carrier and weekday, mean delays per route, carrier
statistics, delay distributions and quantiles, correlations - one table each.

``routes``: route analytics over the whole flight table - PageRank top 50, mean delays
per destination, two-hop paths and delayed departures per carrier of the airport.

Every result is replaced as a version (``sinks.replace_table``), so a job that fails
leaves the results of the last one; the paths of the current versions are printed.
A table argument is a Parquet path, a result of another job, or ``table:<name>`` for a catalog table.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from runway.operators import features, pagerank, routes, stats
from runway.params import (DEFAULT_AIRPORT, DEFAULT_TRAIN_END, DEFAULT_TRAIN_START, MOTIF_END, MOTIF_MID,
                           SELECTABLE_AIRPORTS, JobParams)
from runway.session import build_session, intermediates
from runway.sources.sinks import current_version, read_current, replace_table


def load(spark: SparkSession, source: str) -> DataFrame:
    if source.startswith("table:"):
        return spark.table(source[len("table:"):])
    return read_current(spark, source)


def run_features(spark: SparkSession, flights: str, weather: str, stations: str,
                 params: JobParams, out: str, tie_breakers: tuple[str, ...] = ()) -> dict[str, str]:
    with intermediates(spark):
        dep, arr = features.feature_tables(load(spark, flights), load(spark, weather),
                                           load(spark, stations), params, tie_breakers=tie_breakers)
        return features.write_feature_tables(dep, arr, out, params.airport)


def run_routes(spark: SparkSession, flights: str, airport: str, out: str,
               mid: str = MOTIF_MID, end: str = MOTIF_END) -> dict[str, str]:
    legs = load(spark, flights)
    edges = routes.route_edges(legs, delay="DEP_DELAY", attrs={"operator": "OP_CARRIER", "tripId": "ORIGIN_AIRPORT_SEQ_ID"})
    vertices = routes.route_vertices(legs)
    results = {
        "pagerank": ("pagerank_top50", lambda: pagerank.top_ranked(pagerank.pagerank(vertices, edges))),
        "delays": (f"delays_by_carrier_{airport}", lambda: routes.delay_counts(edges, airport, ["operator"])),
        "means": (f"mean_delay_by_destination_{airport}", lambda: routes.delay_means(edges, airport, ["src", "state_dst", "dst"])),
        "motif": (f"two_hop_{mid}_{end}", lambda: routes.two_hop_counts(edges, vertices, mid, end)),
    }
    return _write_results(spark, results, out)


def run_explore(spark: SparkSession, features_dir: str, airport: str, out: str) -> dict[str, str]:
    """The exploration tables of one airport, from the feature tables that ``features`` has written."""
    paths = features.feature_paths(features_dir, airport)
    dep, arr = read_current(spark, paths["dep"]), read_current(spark, paths["arr"])

    def edges(side, delay, attrs, dest_side=True):
        return routes.route_edges(side, delay=delay, attrs=attrs, dest_side=dest_side)

    carrier, weekday, path = {"operator": "OP_UNIQUE_CARRIER"}, {"day_of_week": "DAY_OF_WEEK"}, {"path": "FL_PATH"}
    results = {
        "delays_by_carrier": lambda: routes.delay_counts(edges(dep, "DEP_DELAY_NEW", carrier), airport, ["operator"]),
        "delays_into_by_carrier": lambda: routes.delay_counts(edges(arr, "ARR_DELAY_NEW", carrier, False), airport, ["operator"], outbound=False),
        "delays_by_weekday_dst": lambda: routes.delay_counts(edges(dep, "DEP_DELAY_NEW", weekday), airport, ["day_of_week", "dst"]),
        "delays_by_weekday_src": lambda: routes.delay_counts(edges(arr, "ARR_DELAY_NEW", weekday, False), airport, ["day_of_week", "src"], outbound=False),
        "mean_delay_by_path": lambda: routes.delay_means(edges(dep, "DEP_DELAY_NEW", path), airport, ["path"]),
        "carrier_stats": lambda: stats.carrier_stats(dep),
        "carrier_share": lambda: stats.carrier_share(dep),
        "carrier_mean_clipped": lambda: stats.carrier_mean_clipped(dep),
        "delay_distribution": lambda: stats.delay_histogram(dep),
        "delay_sketches": lambda: stats.delay_sketches(dep),
        "delay_quantiles": lambda: stats.sketch_quantiles(stats.delay_sketches(dep)),
        "correlation_dep": lambda: stats.pearson_pairs(dep),
        "correlation_arr": lambda: stats.pearson_pairs(arr),
    }
    return _write_results(spark, {k: (f"{k}_{airport}", make) for k, make in results.items()}, out)


def _write_results(spark: SparkSession, results: dict, out: str) -> dict[str, str]:
    """Make and replace one result table after the other; their intermediates go as soon as each is written."""
    paths = {}
    for key, (name, make) in results.items():
        paths[key] = f"{out.rstrip('/')}/{name}"
        with intermediates(spark):
            replace_table(spark, make(), paths[key])
    return paths


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="runway")
    sub = parser.add_subparsers(dest="job", required=True)
    f = sub.add_parser("features", help="departure and arrival feature tables of one airport")
    f.add_argument("--flights", required=True)
    f.add_argument("--weather", required=True)
    f.add_argument("--stations", required=True)
    f.add_argument("--train-start", default=DEFAULT_TRAIN_START)
    f.add_argument("--train-end", default=DEFAULT_TRAIN_END)
    f.add_argument("--inference", default=None, help="default: train end + 1 day")
    f.add_argument("--tie-breakers", default="", help="comma list of leg columns ordering equal times")
    e = sub.add_parser("explore", help="delay counts, means, distributions and correlations of written feature tables")
    e.add_argument("--features", required=True, help="the --out folder of a features job")
    r = sub.add_parser("routes", help="PageRank, mean delays, two-hop paths and delayed departures per carrier")
    r.add_argument("--flights", required=True)
    r.add_argument("--motif-mid", default=MOTIF_MID)
    r.add_argument("--motif-end", default=MOTIF_END)
    for job in (f, e, r):
        job.add_argument("--airport", default=DEFAULT_AIRPORT, choices=SELECTABLE_AIRPORTS)
        job.add_argument("--out", required=True)
    args = parser.parse_args(argv)

    spark = build_session(app=f"runway-{args.job}")
    if args.job == "features":
        params = JobParams(airport=args.airport, train_start=args.train_start,
                           train_end=args.train_end, inference=args.inference)
        ties = tuple(c for c in args.tie_breakers.split(",") if c)
        paths = run_features(spark, args.flights, args.weather, args.stations, params, args.out, ties)
    elif args.job == "explore":
        paths = run_explore(spark, args.features, args.airport, args.out)
    else:
        paths = run_routes(spark, args.flights, args.airport, args.out, args.motif_mid, args.motif_end)
    for name, path in paths.items():
        print(f"{name}: {current_version(spark, path) or path}")

"""Delay-feature tables: legs of one airport with weather at both ends.

The reference collects flights to the driver and merges weather airport by
airport in a loop.  Here it is one distributed plan per side:

    legs  = flights -> either-end filter -> span -> normalise (lag) -> hour keys
    local = station-hour partials of stations with call sign K<airport> -> pooled per hour
    remote= station-hour partials -> stations matched to other-end airports -> pooled per (airport, hour)
    dep   = departures  LEFT JOIN local ON dep_time  LEFT JOIN remote ON (DEST, arr_time)
    arr   = arrivals    LEFT JOIN local ON arr_time  LEFT JOIN remote ON (ORIGIN, dep_time)

Both weather joins are left to adaptive execution, which broadcasts a side only
when its measured size is small and otherwise runs a shuffle join (with skew
splitting on the leg side).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.functions.schema import prefix_columns
from runway.operators.flights import normalise_flights, with_hour_keys
from runway.operators.predicates import contains, either_end, open_span
from runway.operators.stations import airport_rules, both_ends, hub_table, match_stations
from runway.operators.weather import observations, pool_hourly, station_hour_partials
from runway.params import FINAL_COLUMNS, JobParams
from runway.sources.sinks import materialise, replace_table


def prepare_legs(flights: DataFrame, params: JobParams, tie_breakers: tuple[str, ...] = (),
                 keep: tuple[str, ...] = (), prior: bool = True, cut_lineage: bool = True) -> DataFrame:
    """Legs touching the airport, normalised (with the previous-leg flag) and hour keyed.

    The lag sees legs with ``train_start < FL_DATE < train_end``; the table then
    keeps ``train_start < FL_DATE < inference``.  The result (one airport's traffic) is written as Parquet
    under the shared checkpoint folder: every
    later use reads it back (with pruning and pushdown) instead of re-running
    scan, joins and window, and a lost executor never replays them.
    """
    base = open_span(either_end(flights, params.airport), "FL_DATE",
                     params.train_start, params.train_end)
    legs = normalise_flights(base, tie_breakers=tie_breakers, keep=keep, prior=prior)
    legs = with_hour_keys(open_span(legs, "FL_DATE", params.train_start, params.inference_date))
    if cut_lineage:
        legs = materialise(legs.sparkSession, legs, "legs")
    return legs


@dataclass
class WeatherSides:
    local: DataFrame    # (time, hourly columns) at the chosen airport
    remote: DataFrame   # (code, time, hourly columns) at every other-end airport


def other_end_codes(legs: DataFrame, airport: str) -> DataFrame:
    """(code, city) of the airports at the other end of the airport's departures and arrivals.

    One pass over the legs: the city is the smallest that any end of a leg gives
    for the code, as in ``city_lookup``.
    """
    far_dest, far_origin = F.col("ORIGIN").contains(airport), F.col("DEST").contains(airport)
    ends = both_ends(legs, ("ORIGIN", "ORIGIN_CITY", far_origin), ("DEST", "DEST_CITY", far_dest), ("code", "city", "far"))
    return (ends.where(F.col("code").isNotNull()).groupBy("code")
                .agg(F.min("city").alias("city"), F.bool_or(F.coalesce("far", F.lit(False))).alias("far"))
                .where("far").drop("far"))


def other_end_rules(legs: DataFrame, stations: DataFrame, params: JobParams) -> DataFrame:
    """The station rule of every other-end airport, written once (one row per airport)."""
    rules = airport_rules(other_end_codes(legs, params.airport), stations, hub_table(legs.sparkSession, params.hubs))
    return materialise(legs.sparkSession, rules, "rules")


def local_hourly(partials: DataFrame, params: JobParams) -> DataFrame:
    """Hourly weather at the chosen airport: stations whose call sign contains K<airport>."""
    return pool_hourly(contains(partials, "CALL_SIGN", params.call_sign), keys=())


def remote_hourly(legs: DataFrame, partials: DataFrame, stations: DataFrame,
                  params: JobParams) -> DataFrame:
    """Hourly weather per other-end airport, stations picked by hub / city / call-sign rule."""
    rules = other_end_rules(legs, stations, params)
    station_keys = partials.select("NAME", "CALL_SIGN").distinct()
    matches = match_stations(station_keys, rules)
    matched = partials.join(matches, (partials["NAME"].eqNullSafe(matches["NAME"]))
                            & (partials["CALL_SIGN"].eqNullSafe(matches["CALL_SIGN"])))
    sums = [c for c in partials.columns if c.startswith(("s_", "n_"))]
    return pool_hourly(matched.select("code", "time", *sums), keys=("code",))


def weather_partials(weather: DataFrame, params: JobParams, missing_codes: bool = False) -> DataFrame:
    """Filtered reports of the span reduced to (station, hour) sums and counts."""
    obs = observations(weather, params.train_start, params.inference_date)
    return station_hour_partials(obs, missing_codes=missing_codes)


def weather_sides(legs: DataFrame, weather: DataFrame, stations: DataFrame,
                  params: JobParams, missing_codes: bool = False) -> WeatherSides:
    """Local and remote hourly weather from one pass over the weather reports.

    The (station, hour) partials - at most stations x hours of the span rows - are
    written once under the shared checkpoint folder; the local series, the
    station list and the remote series all read them instead of the reports.
    The remote series (airports x hours) is written once too, for both tables.
    """
    partials = materialise(legs.sparkSession, weather_partials(weather, params, missing_codes),
                           "station-hours")
    remote = materialise(legs.sparkSession, remote_hourly(legs, partials, stations, params), "remote-hours")
    return WeatherSides(local=local_hourly(partials, params), remote=remote)


def departure_features(legs: DataFrame, sides: WeatherSides, params: JobParams) -> DataFrame:
    """Departures of the airport with local weather at dep_time and remote at arr_time."""
    dep = contains(legs, "ORIGIN", params.airport)
    remote = prefix_columns(sides.remote.withColumnRenamed("code", "DEST"), "arr_", keep=("DEST",))
    out = (dep.join(prefix_columns(sides.local, "dep_"), "dep_time", "left")
              .join(remote, ["DEST", "arr_time"], "left"))
    return out.select(FINAL_COLUMNS)


def arrival_features(legs: DataFrame, sides: WeatherSides, params: JobParams) -> DataFrame:
    """Arrivals at the airport with local weather at arr_time and remote at dep_time."""
    arr = contains(legs, "DEST", params.airport)
    remote = prefix_columns(sides.remote.withColumnRenamed("code", "ORIGIN"), "dep_", keep=("ORIGIN",))
    out = (arr.join(prefix_columns(sides.local, "arr_"), "arr_time", "left")
              .join(remote, ["ORIGIN", "dep_time"], "left"))
    return out.select(FINAL_COLUMNS)


def feature_tables(flights: DataFrame, weather: DataFrame, stations: DataFrame,
                   params: JobParams, tie_breakers: tuple[str, ...] = (),
                   missing_codes: bool = False) -> tuple[DataFrame, DataFrame]:
    """(departures, arrivals) feature tables of ``params.airport``, 51 columns each."""
    legs = prepare_legs(flights, params, tie_breakers=tie_breakers)
    sides = weather_sides(legs, weather, stations, params, missing_codes=missing_codes)
    return departure_features(legs, sides, params), arrival_features(legs, sides, params)


def union_features(dep: DataFrame, arr: DataFrame) -> DataFrame:
    """Departures and arrivals in one table, by column name, with a ``side`` column."""
    return (dep.withColumn("side", F.lit("dep"))
               .unionByName(arr.withColumn("side", F.lit("arr"))))


def write_feature_tables(dep: DataFrame, arr: DataFrame, out_dir: str, airport: str,
                         partition_by: tuple[str, ...] = ("YEAR", "MONTH")) -> dict[str, str]:
    """Replace the airport's departure and arrival feature tables under ``out_dir``.

    Partitioned by year and month so later reads of a date range prune files.
    Returns the two paths; ``sinks.read_current`` reads them.
    """
    spark, paths = dep.sparkSession, feature_paths(out_dir, airport)
    replace_table(spark, dep, paths["dep"], partition_by)
    replace_table(spark, arr, paths["arr"], partition_by)
    return paths


def feature_paths(out_dir: str, airport: str) -> dict[str, str]:
    """Where an airport's feature tables stand under ``out_dir``."""
    return {side: f"{out_dir.rstrip('/')}/airlines_{side}_{airport}.parquet" for side in ("dep", "arr")}

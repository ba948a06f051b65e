"""Registered queries: one per operator of the survey's inventory.

Each query takes (spark, sf_dir), reads the whole test tables through the
stand-in views in ``runway.sources.standins`` and runs the library's operator
on them.  Parameters that select an airport or a span are the job's own
parameters (the reference's widgets), not row caps.

Results are what the library returns.  Only columns that are sums or means of
doubles, whose last bits depend on the order of summation, are rounded (see
``query``), so that two engines can be compared; nothing else is touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.functions import schema, text, timecols
from runway.operators import features, flights, pagerank, predicates, routes, stations, stats, weather
from runway.params import JobParams
from runway.sources import read_table, register_views, standins
from runway.sources.sinks import replace_and_reload
from runway.session import shared_path

# Stand-in parameters: the airport and span the driver queries use.
AIRPORT = "NATION_3"
OTHER_AIRPORT = "NATION_7"
# stand-in hubs, so that the hub, city and call-sign rules of station matching all apply
HUBS = {"NATION_5": "PORT 5 AIRPORT", "NATION_21": "PORT 21 AIRPORT"}
PARAMS = JobParams(airport=AIRPORT, train_start="2024-01-01", train_end="2024-01-30", hubs=HUBS)
TIE = ("LEG_ID",)
SPAN_LO, SPAN_HI = "2024-01-10", "2024-01-20"
HOURLY = ("avg_temp_f", "tot_precip_mm", "avg_wnd_mps", "avg_vis_m", "avg_slp_hpa", "avg_dewpt_f")
WEATHER_MEANS = tuple(f"{side}_{c}" for side in ("dep", "arr") for c in HOURLY)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def settled(df: DataFrame, columns: tuple[str, ...], digits: int = 6) -> DataFrame:
    """Round the named sums and means: to 9 places first, so that noise in the last bits
    does not decide a tie, then to ``digits``.  NaN, infinities and large values stay."""
    return df.withColumns({c: F.round(F.round(c, 9), digits) for c in columns})


def query(fn: Callable[[SparkSession, str], DataFrame] | None = None, *, sums: tuple[str, ...] = ()):
    """Register a query; ``sums`` names its columns that depend on the order of summation."""
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return settled(df, sums) if sums else df
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        return run
    return register if fn is None else register(fn)


def _legs(spark, d):
    return standins.flights_raw(spark, d)


def _reports(spark, d):
    return standins.weather_reports_raw(spark, d)


def _stations(spark, d):
    return standins.stations_raw(spark, d)


def _prepared(spark, d, prior=True, cut_lineage=True):
    """Prepared legs of the airport; written out only when a query reads them more than once."""
    return features.prepare_legs(_legs(spark, d), PARAMS, tie_breakers=TIE, keep=TIE, prior=prior,
                                 cut_lineage=cut_lineage)


def _departures(spark, d, prior=False):
    return predicates.contains(_prepared(spark, d, prior, cut_lineage=False), "ORIGIN", AIRPORT)


def _observations(spark, d):
    return weather.observations(_reports(spark, d), PARAMS.train_start, PARAMS.inference_date)


# --- sources, parameters, sinks ------------------------------------------------------

@query
def scan_flights(spark, d):
    """The flight table as the job reads it."""
    return _legs(spark, d)


@query
def scan_weather_pred(spark, d):
    """Weather scan with the routine-report and US predicates (S3)."""
    return weather.scan_routine_us(_reports(spark, d))


@query
def view_sql(spark, d):
    """The flight table as a temporary view, queried in SQL."""
    register_views(spark, {"airlines": _legs(spark, d)})
    return spark.sql(
        "SELECT OP_UNIQUE_CARRIER, count(*) AS n_legs, "
        "CAST(sum(CAST(DISTANCE AS DECIMAL(18, 4))) AS DOUBLE) AS total_distance "
        "FROM airlines WHERE CANCELLED = 0 GROUP BY OP_UNIQUE_CARRIER")


@query
def param_window(spark, d):
    """Legs strictly inside (start, end + 1 day)."""
    p = JobParams(airport=AIRPORT, train_start=SPAN_LO, train_end=SPAN_HI)
    legs = predicates.open_span(_legs(spark, d), "FL_DATE", p.train_start, p.inference_date)
    return legs.select("LEG_ID", "FL_DATE",
                       timecols.plus_one_day(F.lit(p.train_end)).alias("inference_date"))


@query
def sink_overwrite_roundtrip(spark, d):
    """Replace a Parquet dataset (twice) and aggregate what reads back."""
    path = shared_path(spark, "legs")
    legs = predicates.either_end(_legs(spark, d), AIRPORT).select("FL_DATE", "ORIGIN", "DEST", "DISTANCE")
    replace_and_reload(spark, legs, path, partition_by=("FL_DATE",))
    back = replace_and_reload(spark, legs, path, partition_by=("FL_DATE",))
    exact = F.sum(F.col("DISTANCE").cast("decimal(18,4)")).cast("double")   # order-independent sum
    return back.groupBy("ORIGIN", "DEST").agg(F.count(F.lit(1)).alias("n_legs"),
                                              exact.alias("total_distance"))


@query
def conform_schema(spark, d):
    """Cast a table to a schema declared from dtype names."""
    declared = T.StructType([
        T.StructField("l_orderkey", schema.spark_type_for("int64")),
        T.StructField("l_linenumber", schema.spark_type_for("int32")),
        T.StructField("l_quantity", schema.spark_type_for("float64")),
        T.StructField("l_returnflag", schema.spark_type_for("object")),
    ])
    return schema.conform(read_table(spark, d, "lineitem"), declared)


# --- predicates ---------------------------------------------------------------------

@query
def filter_either_end(spark, d):
    """Legs touching the airport at either end."""
    return predicates.either_end(_legs(spark, d), AIRPORT).select("LEG_ID", "ORIGIN", "DEST")


@query
def filter_ts_open_span(spark, d):
    """Reports strictly inside a span of timestamps."""
    return predicates.open_span(_reports(spark, d), "DATE", SPAN_LO, SPAN_HI).select("STATION", "DATE")


@query
def filter_not_flagged(spark, d):
    """Legs neither cancelled nor diverted; NULL flags dropped."""
    return predicates.not_flagged(_legs(spark, d)).select("LEG_ID", "CANCELLED", "DIVERTED")


@query
def filter_like_suffix(spark, d):
    """Reports whose station name ends in ' US' (P5)."""
    return predicates.like(_reports(spark, d), "NAME", "% US").select("STATION", "DATE", "NAME")


@query
def filter_like_infix(spark, d):
    """Reports of type containing FM-15 at stations named '... AIRPORT...' (P6)."""
    r = predicates.like(predicates.like(_reports(spark, d), "REPORT_TYPE", "%FM-15%"), "NAME", "% AIRPORT%")
    return r.select("STATION", "DATE", "REPORT_TYPE", "NAME")


@query
def filter_derived(spark, d):
    """Filter on the derived last-two-characters country."""
    r = predicates.country_is(_reports(spark, d), "US")
    return r.select("STATION", "DATE", text.last_two("NAME").alias("COUNTRY"))


@query
def filter_contains(spark, d):
    """Literal substring tests: legs from the airport, reports with its call sign."""
    legs = predicates.contains(_legs(spark, d), "ORIGIN", AIRPORT).select(
        F.lit("leg").alias("kind"), F.col("LEG_ID").alias("id"),
        F.lit(None).cast("timestamp_ntz").alias("ts"))
    reps = predicates.contains(_reports(spark, d), "CALL_SIGN", PARAMS.call_sign).select(
        F.lit("report").alias("kind"), F.col("STATION").alias("id"), F.col("DATE").alias("ts"))
    return legs.unionByName(reps)


@query
def member_semi(spark, d):
    """Legs whose destination is in a set given as a table."""
    nation = read_table(spark, d, "nation")
    region = read_table(spark, d, "region").where(F.col("r_name") == "ASIA")
    members = nation.join(region, nation.n_regionkey == region.r_regionkey, "left_semi")
    return predicates.member_of(_legs(spark, d), "DEST", members, "n_name").select("LEG_ID", "DEST")


# --- flights, schedule expressions -------------------------------------------------

@query
def normalise_flights(spark, d):
    """The 35-column flight contract, with the previous-leg flag (J-1, J-4, W1)."""
    return flights.normalise_flights(_legs(spark, d), tie_breakers=TIE)


@query
def prior_arrival_late(spark, d):
    """Previous leg's arrival-delay flag of the same tail number."""
    legs = flights.normalise_flights(_legs(spark, d), tie_breakers=TIE, keep=TIE)
    return legs.select("LEG_ID", "TAIL_NUM", "CRS_DEP_TIMESTAMP", "ARR_DEL15", "PR_ARR_DEL15")


@query
def cast_categoricals(spark, d):
    """Categorical numbers as text (F2)."""
    legs = _legs(spark, d)
    cols = ["YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "DISTANCE_GROUP",
            "DEP_DEL15", "ARR_DEL15", "OP_CARRIER_FL_NUM"]
    return legs.select("LEG_ID", *[F.col(c).cast("string").alias(c) for c in cols])


@query
def block_hour(spark, d):
    """Hour of a time-block label."""
    return _legs(spark, d).select("LEG_ID", "DEP_TIME_BLK", "ARR_TIME_BLK",
                                  timecols.block_hour("DEP_TIME_BLK").alias("DEP_TIME_HOUR"),
                                  timecols.block_hour("ARR_TIME_BLK").alias("ARR_TIME_HOUR"))


@query
def hhmm_round_hour(spark, d):
    """HHMM to hour by rounding."""
    return _legs(spark, d).select("LEG_ID", "CRS_DEP_TIME", "CRS_ARR_TIME",
                                  timecols.hhmm_round_hour("CRS_DEP_TIME").alias("CRS_DEP_TIME_HOUR"),
                                  timecols.hhmm_round_hour("CRS_ARR_TIME").alias("CRS_ARR_TIME_HOUR"))


@query
def minutes_to_hours(spark, d):
    """Scheduled minutes to rounded hours."""
    return _legs(spark, d).select("LEG_ID", timecols.minutes_to_hours("CRS_ELAPSED_TIME")
                                  .alias("CRS_ELAPSED_HOURS"))


@query
def concat_keys(spark, d):
    """Composite keys carrier_number and ORIGIN-DEST."""
    return _legs(spark, d).select(
        "LEG_ID", text.concat_key("OP_CARRIER", "OP_CARRIER_FL_NUM", sep="_").alias("FLIGHT_KEY"),
        text.concat_key("ORIGIN", "DEST", sep="-").alias("FL_PATH"))


@query
def hhmm_timestamp(spark, d):
    """Local timestamps from date + HHMM; 24:00 gives NULL."""
    legs = _legs(spark, d)
    return legs.select("LEG_ID",
                       timecols.hhmm_timestamp("FL_DATE", "CRS_DEP_TIME").alias("CRS_DEP_TIMESTAMP"),
                       timecols.hhmm_timestamp("FL_DATE", "CRS_ARR_TIME").alias("CRS_ARR_TIMESTAMP"))


@query
def trunc_hour(spark, d):
    """Report time truncated to the hour."""
    return _reports(spark, d).select("STATION", "DATE", timecols.trunc_hour("DATE").alias("time"))


@query
def split_city(spark, d):
    """City before the first comma, state text after it."""
    return _legs(spark, d).select("LEG_ID", text.comma_part("ORIGIN_CITY_NAME", 0).alias("ORIGIN_CITY"),
                                  text.comma_part("DEST_CITY_NAME", 0).alias("DEST_CITY"),
                                  text.comma_part("DEST_CITY_NAME", 1).alias("DEST_STATE_TEXT"))


@query
def delay_label(spark, d):
    """Delay minutes as an 'HhMMm' label."""
    return stats.delay_labels(_legs(spark, d), delay="DEP_DELAY", keys=("LEG_ID",))


# --- weather ------------------------------------------------------------------------

@query
def select_weather(spark, d):
    """US airport routine reports, 22 contract columns (J-2, P5-P7)."""
    return weather.weather_raw(_reports(spark, d))


@query
def decode_packed(spark, d):
    """Packed fields decoded into numbers."""
    return weather.decode(_reports(spark, d)).select(
        "STATION", "DATE", "temp_f", "wnd_mps", "vis_m", "dew_pt_f", "slp_hpa", "precip_mm")


@query(sums=HOURLY)
def hourly_obs(spark, d):
    """Hourly means and precipitation sum of routine reports."""
    return weather.hourly(_observations(spark, d))


@query(sums=tuple(f"dep_{c}" for c in HOURLY))
def prefix_columns(spark, d):
    """Hourly series with every column prefixed (J-6)."""
    return schema.prefix_columns(weather.hourly(_observations(spark, d)), "dep_")


# --- stations -----------------------------------------------------------------------

@query
def city_key(spark, d):
    """Cleaned city keys of every airport (F16)."""
    legs = flights.with_hour_keys(flights.normalise_flights(_legs(spark, d), prior=False))
    cities = stations.city_lookup(legs)
    return cities.select("code", "city", text.city_key("city").alias("city_key"))


@query
def call_sign(spark, d):
    """Call sign of every origin airport."""
    codes = _legs(spark, d).select(F.col("ORIGIN").alias("code")).distinct()
    return codes.select("code", text.call_sign("code").alias("call_sign"))


@query
def dim_lookup(spark, d):
    """Airport -> city dictionary as a table."""
    return stations.city_lookup(_prepared(spark, d, prior=False, cut_lineage=False))


@query
def missing_call_sign(spark, d):
    """Airports whose call sign no station carries."""
    codes = stations.both_ends(_legs(spark, d), ("ORIGIN",), ("DEST",), ("code",)).distinct()
    return stations.missing_call_signs(codes, _stations(spark, d))


@query
def station_match(spark, d):
    """Stations assigned to every other-end airport by hub / city / call-sign rule."""
    legs = _prepared(spark, d, prior=False)
    keys = _observations(spark, d).select("NAME", "CALL_SIGN").distinct()
    return stations.match_stations(keys, features.other_end_rules(legs, _stations(spark, d), PARAMS))


# --- features -----------------------------------------------------------------------

def _sides(spark, d, legs):
    return features.weather_sides(legs, _reports(spark, d), _stations(spark, d), PARAMS)


@query(sums=tuple(f"dep_{c}" for c in HOURLY))
def local_weather(spark, d):
    """Departures left-joined to the airport's hourly weather at dep_time."""
    legs = _prepared(spark, d, prior=False, cut_lineage=False)
    local = features.local_hourly(features.weather_partials(_reports(spark, d), PARAMS), PARAMS)
    dep = predicates.contains(legs, "ORIGIN", AIRPORT)
    side = schema.prefix_columns(local, "dep_")
    return dep.join(side, "dep_time", "left").select(
        "LEG_ID", "dep_time", *[c for c in side.columns if c != "dep_time"])


@query(sums=tuple(f"arr_{c}" for c in HOURLY))
def remote_weather(spark, d):
    """Departures left-joined to hourly weather at their destination."""
    legs = _prepared(spark, d, prior=False)
    sides = _sides(spark, d, legs)
    dep = predicates.contains(legs, "ORIGIN", AIRPORT)
    remote = schema.prefix_columns(sides.remote.withColumnRenamed("code", "DEST"), "arr_", keep=("DEST",))
    return dep.join(remote, ["DEST", "arr_time"], "left").select(
        "LEG_ID", "DEST", "arr_time", *[c for c in remote.columns if c not in ("DEST", "arr_time")])


def _departure_table(spark, d):
    return features.feature_tables(_legs(spark, d), _reports(spark, d), _stations(spark, d), PARAMS, tie_breakers=TIE)[0]


@query(sums=WEATHER_MEANS)
def final_features(spark, d):
    """Departure feature table of the airport: 51 columns (J-3, flagship)."""
    return _departure_table(spark, d)


@query(sums=WEATHER_MEANS)
def arrival_features(spark, d):
    """Arrival feature table of the airport: 51 columns (J-3)."""
    return features.feature_tables(_legs(spark, d), _reports(spark, d), _stations(spark, d), PARAMS, tie_breakers=TIE)[1]


@query(sums=WEATHER_MEANS)
def union_features(spark, d):
    """Departures and arrivals with weather, in one table."""
    dep, arr = features.feature_tables(_legs(spark, d), _reports(spark, d), _stations(spark, d),
                                       PARAMS, tie_breakers=TIE)
    return features.union_features(dep, arr)


# --- route graph --------------------------------------------------------------------

def _edges(spark, d, delay="DEP_DELAY", attrs=None, dest_side=True):
    return routes.route_edges(_legs(spark, d), delay=delay, attrs=attrs, dest_side=dest_side)


def _prepared_edges(spark, d, delay, attrs, dest_side=True):
    """Edges of the prepared legs: inside the span, neither cancelled nor diverted."""
    legs = _prepared(spark, d, prior=False, cut_lineage=False)
    return routes.route_edges(legs, delay=delay, attrs=attrs, dest_side=dest_side)


@query
def route_vertices(spark, d):
    """Airport vertices: distinct origins (G1)."""
    return routes.route_vertices(_legs(spark, d))


@query
def route_edges(spark, d):
    """Flight edges with trip id, delay and destination city/state (G1, J-5)."""
    return _edges(spark, d, attrs={"tripId": "ORIGIN_AIRPORT_SEQ_ID"})


@query
def edges_out_delayed(spark, d):
    """Delayed edges leaving the airport (P10)."""
    return predicates.delayed_from(_edges(spark, d, attrs={"operator": "OP_CARRIER"}), AIRPORT)


@query
def edges_in_delayed(spark, d):
    """Delayed edges entering the airport (P10)."""
    e = _edges(spark, d, delay="ARR_DELAY_NEW", attrs={"operator": "OP_UNIQUE_CARRIER"}, dest_side=False)
    return predicates.delayed_into(e, AIRPORT)


@query
def delays_by_carrier(spark, d):
    """Delayed departures of the airport per carrier."""
    return routes.delay_counts(_edges(spark, d, attrs={"operator": "OP_CARRIER"}), AIRPORT, ["operator"])


@query
def delays_into_by_carrier(spark, d):
    """Delayed arrivals of the prepared arrival legs per carrier (A4 on the arrival edges)."""
    e = _prepared_edges(spark, d, "ARR_DELAY_NEW", {"operator": "OP_UNIQUE_CARRIER"}, dest_side=False)
    return routes.delay_counts(e, AIRPORT, ["operator"], outbound=False)


@query
def delays_by_weekday_dst(spark, d):
    """Delayed departures of the prepared legs per weekday and destination (A5)."""
    e = _prepared_edges(spark, d, "DEP_DELAY_NEW", {"day_of_week": "DAY_OF_WEEK"})
    return routes.delay_counts(e, AIRPORT, ["day_of_week", "dst"])


@query
def delays_by_weekday_src(spark, d):
    """Delayed arrivals of the prepared legs per weekday and origin (A5)."""
    e = _prepared_edges(spark, d, "ARR_DELAY_NEW", {"day_of_week": "DAY_OF_WEEK"}, dest_side=False)
    return routes.delay_counts(e, AIRPORT, ["day_of_week", "src"], outbound=False)


@query(sums=("avg_delay",))
def mean_delay_by_dst(spark, d):
    """Mean delay of delayed departures per (origin, destination state, destination)."""
    return routes.delay_means(_edges(spark, d, attrs={"tripId": "ORIGIN_AIRPORT_SEQ_ID"}), AIRPORT,
                              ["src", "state_dst", "dst"])


@query(sums=("avg_delay",))
def mean_delay_by_path(spark, d):
    """Mean delay of delayed departures of the prepared legs per route."""
    e = _prepared_edges(spark, d, "DEP_DELAY_NEW", {"path": "FL_PATH"})
    return routes.delay_means(e, AIRPORT, ["path"])


@query
def two_hop_motif(spark, d):
    """Two-hop paths a -> AIRPORT -> OTHER_AIRPORT with a large delay and a trip gap, per a."""
    legs = _legs(spark, d)
    e = routes.route_edges(legs, delay="DEP_DELAY", attrs={"tripId": "ORIGIN_AIRPORT_SEQ_ID"})
    return routes.two_hop_counts(e, routes.route_vertices(legs), AIRPORT, OTHER_AIRPORT)


@query(sums=("pagerank",))
def pagerank_top50(spark, d):
    """PageRank of airports (reset 0.15, 5 rounds), top 50."""
    legs = _legs(spark, d)
    ranks = pagerank.pagerank(routes.route_vertices(legs), _edges(spark, d))
    return pagerank.top_ranked(ranks)


# --- aggregates and statistics -------------------------------------------------------

@query
def collect_distinct(spark, d):
    """Distinct destinations in order, one row each with its place (A2, T4).

    The list stays a table: it is never gathered into one row.
    """
    return stats.numbered_distinct(_legs(spark, d), "DEST")


@query
def distinct_pairs(spark, d):
    """Distinct (destination, city) pairs (A3)."""
    legs = _legs(spark, d)
    return legs.select("DEST", text.comma_part("DEST_CITY_NAME", 0).alias("DEST_CITY")).distinct()


@query(sums=("mean_delay",))
def carrier_stats(spark, d):
    """min / max / count / mean departure delay per carrier, by count."""
    return stats.carrier_stats(_departures(spark, d))


@query
def carrier_share(spark, d):
    """Share of departures per carrier in percent."""
    return stats.carrier_share(_departures(spark, d))


@query(sums=("mean_clipped",))
def carrier_mean_clipped(spark, d):
    """Mean departure delay per carrier clipped at zero."""
    return stats.carrier_mean_clipped(_departures(spark, d))


@query
def delay_distribution(spark, d):
    """Histogram of departure delay per carrier (A12, J-8)."""
    dep = _departures(spark, d).select("OP_UNIQUE_CARRIER", "DEP_DELAY_NEW")
    return stats.delay_histogram(dep)


@query(sums=("q25", "q50", "q75"))
def delay_quantiles(spark, d):
    """Exact quartiles of departure delay per carrier."""
    return stats.delay_quantiles(_departures(spark, d))


@query
def delay_sketch_bound(spark, d):
    """Whether the sketched quartiles of each carrier's delays keep to the sketch's rank error."""
    dep = _departures(spark, d)
    errors = stats.sketch_rank_errors(dep, stats.sketch_quantiles(stats.delay_sketches(dep)))
    return errors.select("carrier", "prob", "n", (F.col("rank_error") <= stats.SKETCH_ERROR).alias("within"))


@query(sums=WEATHER_MEANS)
def select_by_type(spark, d):
    """The double-typed columns of the departure feature table (J-7)."""
    return schema.select_by_type(_departure_table(spark, d), T.DoubleType)


@query(sums=("corr",))
def corr_matrix(spark, d):
    """Pairwise Pearson correlation of the departure feature table's double columns."""
    return stats.pearson_pairs(_departure_table(spark, d))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)

"""Stand-in inputs: the driver's test tables reshaped into the job's raw schemas.

The test data holds no flights or weather, so these views only give rows in the
schemas the job reads (raw flight legs, raw weather reports, station list).
They do none of the job's work: every filter, decode, window, join and
aggregate runs in ``runway.operators`` on whatever rows these produce.

Mapping (one leg per lineitem; one weather report per event):

* leg: ORIGIN = supplier nation, DEST = customer nation, carrier = order
  priority, tail = supplier (NULL for every tenth supplier), FL_DATE = order
  date folded onto the 30 days the events cover, schedule times from part,
  quantity and supplier keys, delays from ship date minus order date.
* report: station = user, place = user_id mod 25 (nation), DATE = event time,
  report type from the event type, packed fields built from the event value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.sources.tables import read_table

FOLD_START = "2024-01-01"     # first day of the folded flight calendar
FOLD_DAYS = 30                # the events cover 30 days
ORDER_EPOCH = "1995-01-01"    # first order date in the test tables


def _lpad_num(col: Column, width: int) -> Column:
    return F.lpad(col.cast("string"), width, "0")


def _block(hh: Column) -> Column:
    label = F.concat(_lpad_num(hh, 2), F.lit("00-"), _lpad_num(hh, 2), F.lit("59"))
    return F.when(hh < 6, F.lit("0001-0559")).otherwise(label)


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flight legs in the schema of the job's flight table (see FIXTURES.md §1)."""
    li = read_table(spark, sf_dir, "lineitem")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name")
    org = place.select(F.col("n_nationkey").alias("o_nk"), F.col("n_name").alias("o_name"),
                       F.col("r_name").alias("o_region"))
    dst = place.select(F.col("n_nationkey").alias("d_nk"), F.col("n_name").alias("d_name"),
                       F.col("r_name").alias("d_region"))

    # customers meet the orders, not the lines: few and narrow rows to shuffle when neither is small
    orders = orders.join(customer, orders.o_custkey == customer.c_custkey)
    legs = (li.join(orders, li.l_orderkey == F.col("o_orderkey"))
              .join(supplier, li.l_suppkey == supplier.s_suppkey)
              .join(org, F.col("s_nationkey") == F.col("o_nk"))
              .join(dst, F.col("c_nationkey") == F.col("d_nk")))

    fd = F.date_add(F.lit(FOLD_START).cast("date"),
                    F.pmod(F.datediff(F.col("o_orderdate").cast("date"),
                                      F.lit(ORDER_EPOCH).cast("date")), F.lit(FOLD_DAYS)))
    carrier = F.substring("o_orderpriority", 3, 2)
    dep_hh = (F.col("l_partkey") % 24).cast("int")
    crs_dep = (dep_hh * 100 + F.col("l_quantity").cast("int") % 60).cast("int")
    crs_arr = F.when((F.col("l_partkey") + F.col("l_suppkey")) % 50 == 0, F.lit(2400)).otherwise(
        ((F.col("l_partkey") + F.col("l_linenumber") * 3) % 24) * 100
        + (F.col("l_suppkey") * 7) % 60).cast("int")
    arr_hh = F.least(F.floor(crs_arr / 100), F.lit(23)).cast("int")
    dep_delay = F.datediff(F.col("l_shipdate").cast("date"),
                           F.col("o_orderdate").cast("date")).cast("double")
    arr_delay = dep_delay + F.col("l_quantity") - F.lit(25.0)

    def city(nk: str, region: str) -> Column:
        return F.concat(F.lit("Port "), F.col(nk).cast("string"),
                        F.when(F.col(nk) % 4 == 0, F.lit(" City")).otherwise(F.lit("")),
                        F.lit(", "), F.substring(F.col(region), 1, 2))

    return legs.select(
        F.year(fd).alias("YEAR"),
        F.quarter(fd).alias("QUARTER"),
        F.month(fd).alias("MONTH"),
        F.dayofmonth(fd).alias("DAY_OF_MONTH"),
        (F.weekday(fd) + 1).alias("DAY_OF_WEEK"),
        fd.alias("FL_DATE"),
        carrier.alias("OP_UNIQUE_CARRIER"),
        carrier.alias("OP_CARRIER"),
        F.when(F.col("l_suppkey") % 10 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("N"), F.col("l_suppkey").cast("string"))).alias("TAIL_NUM"),
        F.col("l_partkey").cast("int").alias("OP_CARRIER_FL_NUM"),
        F.col("o_name").alias("ORIGIN"),
        city("o_nk", "o_region").alias("ORIGIN_CITY_NAME"),
        F.substring("o_region", 1, 2).alias("ORIGIN_STATE_ABR"),
        F.col("d_name").alias("DEST"),
        city("d_nk", "d_region").alias("DEST_CITY_NAME"),
        F.substring("d_region", 1, 2).alias("DEST_STATE_ABR"),
        (F.col("o_nk") + 10000).alias("ORIGIN_AIRPORT_ID"),
        (F.col("d_nk") + 10000).alias("DEST_AIRPORT_ID"),
        F.col("l_orderkey").alias("ORIGIN_AIRPORT_SEQ_ID"),
        crs_dep.alias("CRS_DEP_TIME"),
        _block(dep_hh).alias("DEP_TIME_BLK"),
        dep_delay.alias("DEP_DELAY"),
        F.greatest(dep_delay, F.lit(0.0)).alias("DEP_DELAY_NEW"),
        F.when(dep_delay >= 15, F.lit(1.0)).otherwise(F.lit(0.0)).alias("DEP_DEL15"),
        crs_arr.alias("CRS_ARR_TIME"),
        F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(_block(arr_hh)).alias("ARR_TIME_BLK"),
        arr_delay.alias("ARR_DELAY"),
        F.greatest(arr_delay, F.lit(0.0)).alias("ARR_DELAY_NEW"),
        F.when(F.col("l_linenumber") == 6, F.lit(None).cast("double"))
         .when(arr_delay >= 15, F.lit(1.0)).otherwise(F.lit(0.0)).alias("ARR_DEL15"),
        F.when(F.col("l_discount") == 0.0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("CANCELLED"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_returnflag") == "R"), F.lit(1.0))
         .when((F.col("l_linenumber") == 5) & (F.col("l_tax") == 0.08), F.lit(None).cast("double"))
         .otherwise(F.lit(0.0)).alias("DIVERTED"),
        (F.col("l_quantity") * 6.0 + 30.0).alias("CRS_ELAPSED_TIME"),
        (F.col("l_extendedprice") / 50.0).alias("DISTANCE"),
        (F.floor(F.col("l_extendedprice") / 12500.0).cast("int") + 1).alias("DISTANCE_GROUP"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").alias("LEG_ID"),
    )


def _signed_tenths(value: Column, suffix: str) -> Column:
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit("+"))
    return F.concat(sign, _lpad_num(F.abs(value), 4), F.lit(suffix))


def weather_reports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw weather reports in the schema of the job's weather table (FIXTURES.md §2)."""
    ev = read_table(spark, sf_dir, "events")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("k"), F.col("r_name"))
    k = (F.col("user_id") % 25).cast("int")
    rep = ev.join(place, k == F.col("k"))

    state = F.substring("r_name", 1, 2)
    port = F.concat(F.lit("PORT "), F.col("k").cast("string"))
    name = (F.when(F.col("user_id") % 13 == 0, F.concat(port, F.lit(" FIELD, "), state, F.lit(" US")))
             .when(F.col("user_id") % 11 == 0, F.concat(port, F.lit(" AIRPORT, "), state, F.lit(" CA")))
             .otherwise(F.concat(port, F.lit(" AIRPORT, "), state, F.lit(" US"))))
    sign = F.concat(F.lit("KNATION_"), F.col("k").cast("string"))
    call = (F.when(F.col("k") >= 20, F.lit(None).cast("string"))
             .when(F.col("user_id") % 7 == 0, F.concat(sign, F.lit(" ")))
             .otherwise(sign))
    rtype = (F.when(F.col("event_type") == "signup", F.lit("FM-12"))
              .when(F.col("event_type") == "error", F.lit("FM-16"))
              .otherwise(F.lit("FM-15")))
    temp = (F.floor(F.col("value") * 10).cast("int") - 1000)
    tmp = F.when(F.col("event_id") % 17 == 0, F.lit("+9999,9")).otherwise(_signed_tenths(temp, ",1"))
    dew = _signed_tenths(temp - 60, ",1")
    wnd = F.concat(_lpad_num((F.col("event_id") * 7) % 360, 3), F.lit(",1,N,"),
                   _lpad_num(F.floor(F.col("value")).cast("int") % 150, 4), F.lit(",1"))
    vis = F.concat(_lpad_num((F.col("event_id") * 37) % 16000, 6), F.lit(",1,N,1"))
    slp = F.concat(_lpad_num(F.lit(10000) + (F.col("event_id") * 13) % 400, 5), F.lit(",1"))
    aa1 = (F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string"))
            .when(F.col("event_id") % 29 == 0, F.lit("01"))
            .otherwise(F.concat(_lpad_num(F.col("event_id") % 4, 2), F.lit(","),
                                _lpad_num(F.floor(F.col("value")).cast("int") % 100, 4),
                                F.lit(",9,5"))))
    none = F.lit(None).cast("string")
    return rep.select(
        F.concat(F.lit("7"), _lpad_num(F.col("user_id"), 5)).alias("STATION"),
        F.col("ts").alias("DATE"),
        (F.col("k") + 30.0).alias("LATITUDE"),
        (F.col("user_id") / 10.0 - 100.0).alias("LONGITUDE"),
        name.alias("NAME"),
        rtype.alias("REPORT_TYPE"),
        call.alias("CALL_SIGN"),
        tmp.alias("TMP"),
        wnd.alias("WND"),
        F.lit("22000,1,9,N").alias("CIG"),
        vis.alias("VIS"),
        dew.alias("DEW"),
        slp.alias("SLP"),
        aa1.alias("AA1"),
        none.alias("AJ1"), none.alias("AT1"), none.alias("GA1"), none.alias("IA1"),
        none.alias("MA1"), none.alias("MD1"), none.alias("OC1"),
        F.col("props").alias("REM"),
    )


def stations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station list (STATION, CALL_SIGN): one row per reporting station."""
    return weather_reports_raw(spark, sf_dir).select("STATION", "CALL_SIGN").distinct()

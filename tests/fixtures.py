"""Hand-built rows for the flight, weather and station fixtures (FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

FLIGHT_SCHEMA = (
    "YEAR int, QUARTER int, MONTH int, DAY_OF_MONTH int, DAY_OF_WEEK int, FL_DATE date, "
    "OP_UNIQUE_CARRIER string, OP_CARRIER string, TAIL_NUM string, OP_CARRIER_FL_NUM int, "
    "ORIGIN string, ORIGIN_CITY_NAME string, ORIGIN_STATE_ABR string, DEST string, "
    "DEST_CITY_NAME string, DEST_STATE_ABR string, ORIGIN_AIRPORT_ID int, DEST_AIRPORT_ID int, "
    "ORIGIN_AIRPORT_SEQ_ID long, CRS_DEP_TIME int, DEP_TIME_BLK string, DEP_DELAY double, "
    "DEP_DELAY_NEW double, DEP_DEL15 double, CRS_ARR_TIME int, ARR_TIME_BLK string, "
    "ARR_DELAY double, ARR_DELAY_NEW double, ARR_DEL15 double, CANCELLED double, DIVERTED double, "
    "CRS_ELAPSED_TIME double, DISTANCE double, DISTANCE_GROUP int, LEG_ID string")

CITY = {"JFK": ("New York, NY", "NY"), "BOS": ("Boston, MA", "MA"), "STL": ("St. Louis, MO", "MO"),
        "MCI": ("Kansas City, MO", "MO"), "PWM": ("Portland, ME", "ME")}


def leg(leg_id, origin, dest, day, dep, arr, tail="N1", carrier="AA", arr_del15=0.0,
        cancelled=0.0, diverted=0.0, delay=10.0, dep_blk="0600-0659", arr_blk="0900-0959",
        carrier_op="AA"):
    d = dt.date.fromisoformat(day)
    return (d.year, (d.month - 1) // 3 + 1, d.month, d.day, d.isoweekday(), d,
            carrier, carrier_op, tail, 100, origin, CITY[origin][0], CITY[origin][1],
            dest, CITY[dest][0], CITY[dest][1], 1, 2, 1000 + int(leg_id[1:]), dep, dep_blk,
            delay, max(delay, 0.0), 1.0 if delay >= 15 else 0.0, arr, arr_blk, delay,
            max(delay, 0.0), arr_del15, cancelled, diverted, 120.0, 500.0, 2, leg_id)


REPORT_SCHEMA = (
    "STATION string, DATE timestamp_ntz, LATITUDE double, LONGITUDE double, NAME string, "
    "REPORT_TYPE string, CALL_SIGN string, TMP string, WND string, CIG string, VIS string, "
    "DEW string, SLP string, AA1 string, AJ1 string, AT1 string, GA1 string, IA1 string, "
    "MA1 string, MD1 string, OC1 string, REM string")


def report(station, when, name, call, tmp="+0056,1", aa1="01,0005,9,5", rtype="FM-15",
           wnd="310,1,N,0046,1"):
    return (station, dt.datetime.fromisoformat(when), 40.0, -73.0, name, rtype, call, tmp, wnd,
            None, "016000,1,9,9", "-0044,1", "10132,1", aa1, None, None, None, None, None,
            None, None, None)


def rows(df, *cols):
    """Collect selected columns as plain tuples, sorted."""
    sel = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in sel.collect()], key=lambda t: tuple((x is None, str(x)) for x in t))

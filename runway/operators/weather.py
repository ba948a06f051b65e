"""Weather reports: routine-report filters, packed-field decoding, hourly means.

Two ways to reach hourly series:

* ``hourly`` - the reference's per-hour aggregate over a set of reports
  (Spark aggregates partially before the shuffle, so a hot hour costs nothing).
* ``station_hour_partials`` + ``pool_hourly`` - the same numbers for many
  airports at once: reports are first reduced to one row per (station, hour)
  holding sums and counts, then those rows are mapped to airports and pooled.
  The station -> airport join therefore touches station-hours, not reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.functions.packed import MEASURES, decoded_measures, text_sub_fields
from runway.functions.text import comma_part
from runway.functions.timecols import trunc_hour
from runway.operators.predicates import country_is, like, open_span
from runway.params import AIRPORT_INFIX, HOURLY_COLUMNS, ROUTINE_REPORT, US_SUFFIX, WEATHER_COLUMNS


def scan_routine_us(df: DataFrame, report_type: str = ROUTINE_REPORT) -> DataFrame:
    """Routine reports of US stations: ``REPORT_TYPE = 'FM-15' AND NAME LIKE '% US'``."""
    return df.where((F.col("REPORT_TYPE") == report_type) & F.col("NAME").like(US_SUFFIX))


def weather_raw(df: DataFrame, report_type: str = ROUTINE_REPORT) -> DataFrame:
    """US airport stations' routine reports, projected to the 22 contract columns."""
    df = country_is(df, "US")
    df = like(df, "REPORT_TYPE", f"%{report_type}%")
    df = like(df, "NAME", AIRPORT_INFIX)
    return df.select(WEATHER_COLUMNS)


def observations(df: DataFrame, lo: str | None, hi: str | None,
                 report_type: str = ROUTINE_REPORT) -> DataFrame:
    """Raw reports -> filtered reports in the open time span, with the STATE text."""
    df = weather_raw(scan_routine_us(df, report_type), report_type)
    df = open_span(df, "DATE", lo, hi)
    df = like(df, "NAME", US_SUFFIX)
    return df.withColumn("STATE", comma_part("NAME", 1))


def decode(df: DataFrame, missing_codes: bool = False, keep_text: bool = False) -> DataFrame:
    """Add the decoded measures (and the hour key ``time``) to every report."""
    cols = dict(decoded_measures(missing_codes))
    if keep_text:
        cols.update(text_sub_fields())
    cols["time"] = trunc_hour("DATE")
    return df.withColumns(cols)


def _hourly_aggs():
    out = []
    for name, (how, measure) in HOURLY_COLUMNS.items():
        fn = F.avg if how == "avg" else F.sum
        out.append(fn(measure).alias(name))
    return out


def hourly(df: DataFrame, keys: tuple[str, ...] = (), missing_codes: bool = False,
           report_type: str = ROUTINE_REPORT) -> DataFrame:
    """Per-hour means (precipitation: sum) of routine reports, optionally per key.

    All reports in the same hour are pooled; a sum over only NULLs is NULL.
    """
    routine = df.where(F.col("REPORT_TYPE") == report_type)
    return decode(routine, missing_codes).groupBy(*keys, "time").agg(*_hourly_aggs())


def station_hour_partials(df: DataFrame, station_keys: tuple[str, ...] = ("NAME", "CALL_SIGN"),
                          missing_codes: bool = False,
                          report_type: str = ROUTINE_REPORT) -> DataFrame:
    """One row per (station, hour): sum and count of each measure."""
    routine = df.where(F.col("REPORT_TYPE") == report_type)
    aggs = []
    for measure in MEASURES:
        aggs.append(F.sum(measure).alias(f"s_{measure}"))
        aggs.append(F.count(measure).alias(f"n_{measure}"))
    return decode(routine, missing_codes).groupBy(*station_keys, "time").agg(*aggs)


def pool_hourly(partials: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Pool station-hour partials per (keys, hour) into the hourly columns."""
    aggs = []
    for name, (how, measure) in HOURLY_COLUMNS.items():
        total = F.sum(f"s_{measure}")
        if how == "avg":
            aggs.append(F.try_divide(total, F.sum(f"n_{measure}")).alias(name))
        else:
            aggs.append(total.alias(name))
    return partials.groupBy(*keys, "time").agg(*aggs)

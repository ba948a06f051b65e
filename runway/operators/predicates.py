"""Row filters (the reference's predicates), written so Catalyst pushes them to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.functions.text import last_two
from runway.functions.timecols import typed_literal


def either_end(df: DataFrame, code: str, origin: str = "ORIGIN", dest: str = "DEST") -> DataFrame:
    """Legs that touch the airport at either end."""
    return df.where((F.col(dest) == code) | (F.col(origin) == code))


def open_span(df: DataFrame, column: str, lo: str | None, hi: str | None) -> DataFrame:
    """``lo < column < hi`` (both ends exclusive); a bound of None is not applied.

    Bounds are ISO text cast to the column's own type: on a date column the
    start day is excluded, on a timestamp column only its midnight instant is.
    """
    data_type = df.schema[column].dataType
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(column) > typed_literal(lo, data_type))
    if hi is not None:
        cond = cond & (F.col(column) < typed_literal(hi, data_type))
    return df.where(cond)


def not_flagged(df: DataFrame, cancelled: str = "CANCELLED", diverted: str = "DIVERTED") -> DataFrame:
    """Drop cancelled and diverted legs; a NULL flag drops the row as well."""
    return df.where((F.col(cancelled) != 1) & (F.col(diverted) != 1))


def like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """SQL LIKE (``'% US'`` becomes an EndsWith filter, ``'%FM-15%'`` a Contains)."""
    return df.where(F.col(column).like(pattern))


def country_is(df: DataFrame, country: str = "US", name: str = "NAME") -> DataFrame:
    """Filter on a derived column: the last two characters of the name."""
    return df.where(last_two(name) == country)


def contains(df: DataFrame, column: str, text: str | Column) -> DataFrame:
    """Literal substring test (no pattern characters)."""
    return df.where(F.col(column).contains(text))


def delayed_from(edges: DataFrame, code: str) -> DataFrame:
    """Edges leaving the airport with a positive delay."""
    return edges.where((F.col("src") == code) & (F.col("delay") > 0))


def delayed_into(edges: DataFrame, code: str) -> DataFrame:
    """Edges entering the airport with a positive delay."""
    return edges.where((F.col("dst") == code) & (F.col("delay") > 0))


def member_of(df: DataFrame, column: str, members: DataFrame, member_column: str) -> DataFrame:
    """Rows whose ``column`` is in ``members`` (left semi join; a set of any size)."""
    keys = members.select(F.col(member_column).alias("_member")).distinct()
    return df.join(keys, F.col(column) == F.col("_member"), "left_semi")

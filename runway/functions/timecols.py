"""Time-of-day and timestamp expressions for schedule columns (HHMM integers).

All expressions are built-in Spark functions, safe under ANSI mode: malformed
text gives NULL instead of an error, as the lenient mode the reference ran in did.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def block_hour(block) -> Column:
    """Hour from a time-block label: ``'0600-0659'`` -> 6, ``''`` -> NULL."""
    return F.substring(_c(block), 1, 2).try_cast("int")


def hhmm_round_hour(hhmm) -> Column:
    """Hour of an HHMM time by rounding half up, not truncating: 1750 -> 18, 2359 -> 24."""
    return F.round(_c(hhmm) / 100).cast("int")


def minutes_to_hours(minutes) -> Column:
    """Minutes to whole hours, rounded half up."""
    return F.round(_c(minutes) / 60).cast("int")


def hhmm_text(hhmm) -> Column:
    """HHMM as 4-character text, zero padded on the left (longer text is cut to 4)."""
    return F.lpad(_c(hhmm).cast("string"), 4, "0")


def hhmm_timestamp(day, hhmm) -> Column:
    """Local ``timestamp_ntz`` from a date and an HHMM time.

    ``24:00`` and other impossible times give NULL.  The date is taken as is, so
    an arrival after midnight keeps the departure's date (as in the reference).
    """
    text = hhmm_text(hhmm)
    stamp = F.concat(_c(day).cast("string"), F.lit(" "), F.substring(text, 1, 2),
                     F.lit(":"), F.substring(text, 3, 2))
    return stamp.try_cast("timestamp_ntz")


def trunc_hour(ts) -> Column:
    """Truncate a timestamp to its hour as ``timestamp_ntz``.

    Built from the wall-clock fields, so the result does not depend on the
    session time zone (``date_trunc`` would convert through it).
    """
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t),
                                F.lit(0), F.lit(0))


def iso_weekday(day) -> Column:
    """ISO weekday, Monday = 1 ... Sunday = 7."""
    return F.weekday(_c(day)) + 1


def plus_one_day(day) -> Column:
    """Date one day later."""
    return F.date_add(_c(day).cast("date"), 1)


def typed_literal(value: str, data_type) -> Column:
    """A string bound cast to the column's own type (date stays date, NTZ stays NTZ)."""
    return F.lit(value).cast(data_type)

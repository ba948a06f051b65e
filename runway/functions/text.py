"""Text expressions: composite keys, comma parts, city keys, call signs, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runway.params import (CALL_SIGN_PREFIX, CITY_DROP_FIRST, CITY_DROP_LAST, CITY_TO_SPACE,
                           DELAY_LABEL_FORMAT)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def concat_key(*parts, sep: str) -> Column:
    """``a<sep>b<sep>...``; NULL when any part is NULL (``concat``, not ``concat_ws``)."""
    cols = []
    for i, part in enumerate(parts):
        if i:
            cols.append(F.lit(sep))
        cols.append(_c(part).cast("string"))
    return F.concat(*cols)


def comma_part(text, index: int) -> Column:
    """Element ``index`` (0-based) of ``text`` split on commas; NULL when absent.

    ``'New York, NY'`` -> ``'New York'`` (0) and ``' NY'`` (1, leading space kept).
    """
    return F.get(F.split(_c(text), ","), index)


def last_two(text) -> Column:
    """Last two characters."""
    return F.substring(_c(text), -2, 2)


def city_key(city) -> Column:
    """Clean a city for matching station names.

    In order: drop ``" City"``, upper-case, ``/`` -> space, drop ``ST.``
    (so ``'St. Louis'`` -> ``' LOUIS'``, ``'Kansas City'`` -> ``'KANSAS'``).
    """
    c = F.replace(_c(city), F.lit(CITY_DROP_FIRST), F.lit(""))
    c = F.upper(c)
    c = F.replace(c, F.lit(CITY_TO_SPACE), F.lit(" "))
    return F.replace(c, F.lit(CITY_DROP_LAST), F.lit(""))


def call_sign(code) -> Column:
    """Station call sign of an airport code: ``'K' + code``."""
    return F.concat(F.lit(CALL_SIGN_PREFIX), _c(code))


def delay_label(minutes) -> Column:
    """Minutes as ``'%2.0fh%2.0fm'`` of (floor(x/60), x mod 60 truncated).

    135.4 -> ``' 2h15m'``; -3 -> ``'-1h57m'``; NULL -> NULL.
    """
    x = _c(minutes).cast("double")
    hours = F.floor(x / 60).cast("double")
    mins = F.pmod(x, F.lit(60.0)).cast("int").cast("double")
    return F.when(x.isNotNull(), F.format_string(DELAY_LABEL_FORMAT, hours, mins))

"""Decoding of comma-packed observation fields (TMP, WND, VIS, DEW, SLP, AA1).

Each packed column is split once; sub-fields are read with ``get`` (NULL when
the pack is short) and converted with ``try_cast`` (NULL for empty or bad text),
so ANSI mode never fails on a malformed report.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runway.params import PACKED_LAYOUT

# Placeholder values meaning "missing" in the packed format (used only when asked).
MISSING_CODES = {"temp": 9999.0, "dew": 9999.0, "wnd_speed": 9999.0,
                 "vis_m": 999999.0, "slp": 99999.0, "precip_hr_dur": 99.0,
                 "precip_depth": 9999.0}

MEASURES = ("temp_f", "wnd_mps", "vis_m", "dew_pt_f", "slp_hpa", "precip_mm")


def sub_field(column: str, index: int) -> Column:
    return F.get(F.split(F.col(column), ","), index)


def sub_number(column: str, index: int, name: str | None = None,
               missing_codes: bool = False) -> Column:
    value = sub_field(column, index).try_cast("double")
    if missing_codes and name in MISSING_CODES:
        value = F.when(value != F.lit(MISSING_CODES[name]), value)
    return value


def tenths_c_to_f(value: Column) -> Column:
    """Tenths of a degree Celsius to Fahrenheit: x*9/50 + 32."""
    return value * 9 / 50 + 32


def decoded_measures(missing_codes: bool = False) -> dict[str, Column]:
    """The six numeric measures of a report, as named column expressions."""
    temp = sub_number("TMP", 0, "temp", missing_codes)
    wind = sub_number("WND", 3, "wnd_speed", missing_codes)
    vis = sub_number("VIS", 0, "vis_m", missing_codes)
    dew = sub_number("DEW", 0, "dew", missing_codes)
    slp = sub_number("SLP", 0, "slp", missing_codes)
    hours = sub_number("AA1", 0, "precip_hr_dur", missing_codes)
    depth = sub_number("AA1", 1, "precip_depth", missing_codes) / 10
    return {
        "temp_f": tenths_c_to_f(temp),
        "wnd_mps": wind / 10,
        "vis_m": vis,
        "dew_pt_f": tenths_c_to_f(dew),
        "slp_hpa": slp / 10,
        "precip_mm": F.try_divide(depth, hours),
    }


def text_sub_fields() -> dict[str, Column]:
    """The remaining positional sub-fields, kept as text (quality flags etc.)."""
    numeric = {("TMP", 0), ("WND", 3), ("VIS", 0), ("DEW", 0), ("SLP", 0),
               ("AA1", 0), ("AA1", 1)}
    out = {}
    for column, names in PACKED_LAYOUT.items():
        for i, name in enumerate(names):
            if (column, i) not in numeric:
                out[name] = sub_field(column, i)
    return out

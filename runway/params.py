"""Job parameters (airport and date span) and the reference's fixed values."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------

# Airports offered by the job's airport parameter, in the reference's order.
SELECTABLE_AIRPORTS = ("JFK", "SEA", "BOS", "ATL", "LAX", "SFO", "DEN", "DFW",
                       "ORD", "CVG", "CLT", "DCA", "IAH")

# Hub airports and the weather-station name that identifies each of them.
HUB_STATION_NAMES = {
    "JFK": "JFK INTERNATIONAL AIRPORT",
    "BOS": "BOSTON",
    "ATL": "ATLANTA HARTSFIELD JACKSON INTERNATIONAL AIRPORT",
    "DFW": "DALLAS FORT WORTH",
    "ORD": "CHICAGO OHARE INTERNATIONAL AIRPORT",
    "CLT": "CHARLOTTE DOUGLAS AIRPORT",
    "DCA": "WASHINGTON REAGAN NATIONAL AIRPORT",
    "IAH": "HOUSTON INTERCONTINENTAL AIRPORT",
    "SEA": "SEATTLE TACOMA INTERNATIONAL AIRPORT",
    "LAX": "LOS ANGELES INTERNATIONAL AIRPORT",
    "SFO": "SAN FRANCISCO INTERNATIONAL AIRPORT",
    "DEN": "DENVER INTERNATIONAL AIRPORT",
    "CVG": "CINCINNATI NORTHERN KENTUCKY INTERNATIONAL AIRPORT",
}

DEFAULT_AIRPORT = "JFK"
DEFAULT_TRAIN_START = "2018-01-01"
DEFAULT_TRAIN_END = "2019-03-15"

ROUTINE_REPORT = "FM-15"          # weather report type kept for hourly means
CALL_SIGN_PREFIX = "K"            # call sign = prefix + airport code
PAGERANK_RESET = 0.15
PAGERANK_ITERATIONS = 5
PAGERANK_TOP = 50
MOTIF_MID, MOTIF_END = "SFO", "JFK"
MOTIF_MIN_DELAY = 500.0
MOTIF_MIN_TRIP_GAP = 10000

# Columns of the normalised flight table, in order.
FLIGHT_COLUMNS = [
    "YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "FL_DATE", "FL_PATH",
    "OP_UNIQUE_CARRIER", "TAIL_NUM", "OP_CARRIER_FL_NUM", "ORIGIN", "ORIGIN_CITY_NAME",
    "ORIGIN_STATE_ABR", "DEST", "DEST_CITY_NAME", "DEST_STATE_ABR", "CRS_DEP_TIME",
    "CRS_DEP_TIME_HOUR", "DEP_TIME_HOUR", "DEP_DELAY_NEW", "DEP_TIME_BLK", "CRS_ARR_TIME",
    "CRS_ARR_TIME_HOUR", "ARR_TIME_HOUR", "ARR_DELAY_NEW", "ARR_TIME_BLK", "DISTANCE",
    "DISTANCE_GROUP", "DEP_DEL15", "ARR_DEL15", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID",
    "CRS_DEP_TIMESTAMP", "CRS_ARR_TIMESTAMP", "PR_ARR_DEL15",
]

# Columns of a weather report, in order.
WEATHER_COLUMNS = ["STATION", "DATE", "LATITUDE", "LONGITUDE", "NAME", "REPORT_TYPE",
                   "CALL_SIGN", "TMP", "WND", "CIG", "VIS", "DEW", "SLP", "AA1", "AJ1",
                   "AT1", "GA1", "IA1", "MA1", "MD1", "OC1", "REM"]

# Columns of the final feature table, in order.
FINAL_COLUMNS = [
    "YEAR", "QUARTER", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "FL_DATE", "OP_UNIQUE_CARRIER",
    "TAIL_NUM", "OP_CARRIER_FL_NUM", "ORIGIN", "ORIGIN_CITY_NAME", "ORIGIN_STATE_ABR", "DEST",
    "DEST_CITY_NAME", "DEST_STATE_ABR", "CRS_DEP_TIME", "CRS_DEP_TIME_HOUR", "DEP_TIME_HOUR",
    "DEP_DELAY_NEW", "DEP_TIME_BLK", "CRS_ARR_TIME", "CRS_ARR_TIME_HOUR", "ARR_TIME_HOUR",
    "ARR_DELAY_NEW", "ARR_TIME_BLK", "DISTANCE", "DISTANCE_GROUP", "DEP_DEL15", "ARR_DEL15",
    "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIMESTAMP", "CRS_ARR_TIMESTAMP",
    "PR_ARR_DEL15", "dep_time", "arr_time", "FL_PATH", "ORIGIN_CITY", "DEST_CITY",
    "dep_avg_temp_f", "dep_tot_precip_mm", "dep_avg_wnd_mps", "dep_avg_vis_m",
    "dep_avg_slp_hpa", "dep_avg_dewpt_f", "arr_avg_temp_f", "arr_tot_precip_mm",
    "arr_avg_wnd_mps", "arr_avg_vis_m", "arr_avg_slp_hpa", "arr_avg_dewpt_f",
]

# Hourly weather columns and what each summarises (mean, or sum for precipitation).
HOURLY_COLUMNS = {
    "avg_temp_f": ("avg", "temp_f"),
    "tot_precip_mm": ("sum", "precip_mm"),
    "avg_wnd_mps": ("avg", "wnd_mps"),
    "avg_vis_m": ("avg", "vis_m"),
    "avg_slp_hpa": ("avg", "slp_hpa"),
    "avg_dewpt_f": ("avg", "dew_pt_f"),
}

# Layout of the packed report fields: column -> sub-field names by position.
PACKED_LAYOUT = {
    "TMP": ("temp", "temp_qual"),
    "WND": ("wnd_deg", "wnd_1", "wnd_2", "wnd_speed", "wnd_4"),
    "VIS": ("vis_m", "vis_1", "vis_2", "vis_3"),
    "DEW": ("dew", "dew_1"),
    "SLP": ("slp", "slp_1"),
    "AA1": ("precip_hr_dur", "precip_depth", "precip_cond", "precip_qual"),
}

# City clean-up for station-name matching: text dropped, then (after upper-casing)
# text replaced by a space, then text dropped.
CITY_DROP_FIRST = " City"
CITY_TO_SPACE = "/"
CITY_DROP_LAST = "ST."

# Report-name patterns: country suffix, airport infix.
US_SUFFIX = "% US"
AIRPORT_INFIX = "% AIRPORT%"

# Label of a delay in minutes: hours and minutes.
DELAY_LABEL_FORMAT = "%2.0fh%2.0fm"

# ---------------------------------------------------------------------------


def next_day(day: str) -> str:
    """ISO date one day later (the default inference date)."""
    return (_dt.date.fromisoformat(day) + _dt.timedelta(days=1)).isoformat()


@dataclass(frozen=True)
class JobParams:
    """The job's parameters: one airport and an open date span.

    ``inference`` defaults to ``train_end`` + 1 day.  Flights are kept when
    ``train_start < FL_DATE < train_end`` while the lag is computed, then
    ``train_start < FL_DATE < inference`` for the feature table; weather reports
    when ``train_start < DATE < inference`` (a timestamp compare, so reports on
    the start day itself after midnight are kept).
    """

    airport: str = DEFAULT_AIRPORT
    train_start: str = DEFAULT_TRAIN_START
    train_end: str = DEFAULT_TRAIN_END
    inference: str | None = None
    hubs: dict = field(default_factory=lambda: dict(HUB_STATION_NAMES))

    @property
    def inference_date(self) -> str:
        return self.inference or next_day(self.train_end)

    @property
    def call_sign(self) -> str:
        return CALL_SIGN_PREFIX + self.airport

"""How the given tables are read as weather: one cell per route, day and waypoint from the line items.

route_id = l_suppkey div 5 and waypoint = l_suppkey % 5, so routes and cells grow with the data. `single` leaves the
route out: then all suppliers report to one route, as in a table without route_id. All measures come from whole-number
expressions over k = sum of part keys and q = sum of quantities, so both engines agree on the input to the last digit.
The expressions are plain SQL both engines read; {div} is their whole-number division.
"""

from __future__ import annotations

from alpenglow.config import WAYPOINTS

CALENDAR = {
    "s": "CASE WHEN month(d) BETWEEN 6 AND 9 THEN 600 WHEN month(d) IN (12, 1, 2) THEN -900 ELSE 0 END",
    "calm": "dayofyear(d) % 4 = 0",
    "summer": "month(d) BETWEEN 6 AND 9",
}
GUST = "(3 * q) % (CASE WHEN calm THEN 80 ELSE 250 END)"

# (weather column, whole-number form, units per 1, units -> raw payload number)
MEASURES = (
    ("temperature_max_c", "1500 - 600 * w + k % 1500 - 750 + s + shift", 100, "/ 100"),
    ("temperature_min_c", "1500 - 600 * w + k % 1500 - 750 - 300 - q % 500 + s + shift", 100, "/ 100"),
    ("windspeed_max_ms", "(6 * g) {div} 10", 10, "* 0.36"),
    ("windgusts_max_ms", "g", 10, "* 0.36"),
    ("precipitation_mm", "CASE WHEN day(d) % 3 = 0 THEN k % 200 ELSE 0 END", 100, "/ 100"),
    ("snowfall_cm", "CASE WHEN day(d) % 3 = 0 AND w > 0 THEN q % 150 ELSE 0 END", 10, "/ 10"),
    ("snow_depth_m", "CASE WHEN w = 0 THEN 0 ELSE k % (CASE WHEN summer THEN 60 ELSE 300 END) END", 100, "/ 100"),
    ("pressure_hpa", "89500 - 8500 * w + k % 2000", 100, "/ 100"),
    ("cloudcover_pct", "(7 * k) % (CASE WHEN calm THEN 41 ELSE 101 END)", 1, "* 1"),
    ("daylight_hours", "800 + 2 * dayofyear(d)", 100, "* 36"),
    ("sunshine_hours", "k % 1000", 100, "* 36"),
)

ELEVATION = "CASE w " + " ".join(f"WHEN {i} THEN {e}" for i, (_, _, _, e) in enumerate(WAYPOINTS)) + " END"
NAME = "CASE w " + " ".join(f"WHEN {i} THEN '{n}'" for i, (n, *_) in enumerate(WAYPOINTS)) + " END"
WAYPOINT = "CASE waypoint_name " + " ".join(f"WHEN '{n}' THEN {i}" for i, (n, *_) in enumerate(WAYPOINTS)) + " END"
LAT = "CASE w " + " ".join(f"WHEN {i} THEN {x}" for i, (_, x, _, _) in enumerate(WAYPOINTS)) + " END"
LON = "CASE w " + " ".join(f"WHEN {i} THEN {x}" for i, (_, _, x, _) in enumerate(WAYPOINTS)) + " END"

# Temperature shifts in hundredths of a degree, to tell states of a cell apart.
NO_SHIFT = "0"
ONE_DEGREE = "100"

# Seeded payload faults and repeats, as conditions on a cell's month.
MISSING_VARIABLE = "month(d) = 5 AND (route_id + w) % 7 = 0"
MALFORMED = "month(d) = 7 AND (route_id + w) % 5 = 0"
REFETCHED = "month(d) = 3"
RAGGED = "month(d) = 2 AND (route_id + w) % 3 = 0"  # the last snow depth is lacking
BAD_DATE = "month(d) = 10 AND (route_id + w) % 4 = 0"  # the first day is said to be in month 13
# What silver should hold after all payloads: the refetched months one degree warmer.
SILVER_SHIFT = f"CASE WHEN {REFETCHED} THEN 100 ELSE 0 END"

# Blanked measures for the null rules: (column, condition).
BLANKS = (
    ("windgusts_max_ms", "waypoint_name = 'summit' AND day(date) = 7"),
    ("temperature_max_c", "waypoint_name = 'gouter' AND day(date) = 11"),
    ("temperature_max_c", "waypoint_name = 'summit' AND day(date) = 17"),
)

# Dates that split the record into an already loaded part and a new one.
CUTOFF = "2000-12-31"
OVERLAP_FROM = "2000-11-15"
REVISED_FROM = "2000-12-10"
TODAY = "2001-12-31"
FRESHNESS_TODAY = "2001-11-17"

# What a later upsert changes beside new days: older months come again, and some rows go.
LATE_AGAIN = f"d >= DATE '{OVERLAP_FROM}' OR month(d) = 3"
GONE = "(w = 3 AND day(d) = 5) OR (w = 2 AND day(d) = 9 AND month(d) = 6)"

# Raw slices that are there already: some months not at all, some cut short, some reaching into the next month.
HELD = "(route_id + w + month(period_start)) % 5 <> 0"
HELD_START = "CASE WHEN month(period_start) % 3 = 0 THEN {nine_later} ELSE period_start END"
HELD_END = "CASE WHEN month(period_start) % 4 = 0 THEN {ten_later} ELSE period_end END"
WANTED_FROM, WANTED_TO = "1995-02-10", "1998-11-20"
MID_FROM, MID_TO = "1996-01-17", "1997-03-11"
PUSHED_FROM = "1998-01-01"

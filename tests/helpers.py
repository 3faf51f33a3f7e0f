"""Rows, payloads and days that several test modules build on."""

from __future__ import annotations

import json
from datetime import date, timedelta

from pyspark.sql import types as T

from alpenglow.config import MEASURES, VARIABLE_NAMES

WEATHER = T.StructType(
    [
        T.StructField("waypoint_name", T.StringType()),
        T.StructField("elevation", T.IntegerType()),
        T.StructField("date", T.DateType()),
    ]
    + [T.StructField(name, T.DecimalType(10, 2)) for name in MEASURES]
)
HEIGHTS = {"chamonix": 1035, "tete_rousse": 3167, "gouter": 3835, "vallot": 4362, "summit": 4808}
CALM_DAY = {
    "temperature_max_c": "-5", "temperature_min_c": "-12", "windspeed_max_ms": "3", "windgusts_max_ms": "6",
    "precipitation_mm": "0", "snowfall_cm": "0", "snow_depth_m": "1", "pressure_hpa": "600", "cloudcover_pct": "20",
    "daylight_hours": "12", "sunshine_hours": "6", "air_density_kgm3": "0.8",
}


def days(start: date, count: int):
    return [start + timedelta(days=n) for n in range(count)]


def daily(times, **overrides):
    """A payload's daily object with one default value per day and variable."""
    base = dict(zip(
        VARIABLE_NAMES, (5.0, -2.0, 36.0, 72.0, 1.5, 0.5, 0.3, 1013.0, 75.0, 36000.0, 18000.0), strict=True
    ))
    body = {"time": list(times), **{name: [value] * len(times) for name, value in base.items()}}
    body.update(overrides)
    return {name: values for name, values in body.items() if values is not ...}


def payload(times, **overrides):
    return json.dumps({"daily": daily(times, **overrides)})

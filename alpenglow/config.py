"""Fixed values of the weather model and the settings of a run.

Everything that decides a result (waypoints, variables, score ramps, gate limits, accepted ranges) is listed here as
plain data, so the operators hold no magic numbers and another mountain needs only another set of values.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

# --- Fixed values: waypoints (name, latitude, longitude, elevation in metres), lowest first --------------------------
WAYPOINTS = (
    ("chamonix", 45.9237, 6.8694, 1035),
    ("tete_rousse", 45.8461, 6.8311, 3167),
    ("gouter", 45.8344, 6.8233, 3835),
    ("vallot", 45.8340, 6.8510, 4362),
    ("summit", 45.8326, 6.8652, 4808),
)
WAYPOINT_NAMES = tuple(name for name, *_ in WAYPOINTS)

# The roles the route model reads; snow depth and sunshine are averaged over SNOWPACK, precipitation over every waypoint.
SUMMIT, GOUTER, VALLOT = "summit", "gouter", "vallot"
SNOWPACK = ("tete_rousse", "gouter", "vallot")

# --- Fixed values: payload variables, in request order: (payload field, weather column, divisor of the raw value) ----
VARIABLES = (
    ("temperature_2m_max", "temperature_max_c", None),
    ("temperature_2m_min", "temperature_min_c", None),
    ("windspeed_10m_max", "windspeed_max_ms", 3.6),
    ("windgusts_10m_max", "windgusts_max_ms", 3.6),
    ("precipitation_sum", "precipitation_mm", None),
    ("snowfall_sum", "snowfall_cm", None),
    ("snow_depth_max", "snow_depth_m", None),
    ("surface_pressure_mean", "pressure_hpa", None),
    ("cloudcover_mean", "cloudcover_pct", None),
    ("daylight_duration", "daylight_hours", 3600),
    ("sunshine_duration", "sunshine_hours", 3600),
)
VARIABLE_NAMES = tuple(source for source, _, _ in VARIABLES)
MEASURES = tuple(target for _, target, _ in VARIABLES) + ("air_density_kgm3",)
TIME_FIELD = "time"
REQUEST_TIMEZONE = "Europe/Paris"

# --- Fixed values: physics ------------------------------------------------------------------------------------------
DRY_AIR_GAS_CONSTANT = 287.05
KELVIN_OFFSET = 273.15

# --- Fixed values: loading ------------------------------------------------------------------------------------------
NO_WATERMARK = date(1900, 1, 1)
FIRST_LOAD_START = date(2020, 1, 1)
FIXED_END = date(2020, 2, 28)
ARCHIVE_LAG_DAYS = 7
FETCH_ATTEMPTS = 3
WARN_AFTER_DAYS = 14
FAIL_AFTER_DAYS = 16
LOOKBACK_DAYS = 30

# --- Fixed values: elevation gradients (output column, measure, factor per metre of height difference) ---------------
GRADIENTS = (
    ("temp_max_per_100m", "temperature_max_c", (100,)),
    ("temp_min_per_100m", "temperature_min_c", (100,)),
    ("windspeed_per_100m", "windspeed_max_ms", (100,)),
    ("windgusts_per_100m", "windgusts_max_ms", (100,)),
    ("air_density_per_1000m", "air_density_kgm3", (1000,)),
    ("snow_depth_cm_per_100m", "snow_depth_m", (100, 100)),
)

# --- Fixed values: rolling frames, in rows of the dates that have a gouter row -------------------------------------
SHORT_FRAME = 3
LONG_FRAME = 30
DEPTH_CHANGE_LAG = 7

# --- Fixed values: falling ramps: 100 points at zero_at - width, 0 points at zero_at --------------------------------
# (output column, measure, zero_at, width)
FALLING_RAMPS = (
    ("wind_score_summit", "summit_windgusts_max_ms", 14, Decimal("7.0")),
    ("wind_score_gouter", "gouter_windgusts_max_ms", 18, Decimal("9.0")),
    ("wind_score_vallot", "vallot_windgusts_max_ms", 18, Decimal("9.0")),
    ("grand_couloir_score_thaw", "gouter_3d_temp_mean", 3, Decimal("5.0")),
    ("visibility_score", "summit_cloudcover_pct", 80, Decimal("50.0")),
)

# --- Fixed values: plateau scores: full marks up to a temperature, then a ramp --------------------------------------
COLD_FULL_FROM, COLD_ZERO_AT, COLD_WIDTH = -10, -15, Decimal("5.0")
HEAT_FULL_TO, HEAT_ZERO_AT, HEAT_WIDTH = 0, 2, Decimal("2.0")
FREEZE_FULL_TO, FREEZE_ZERO_AT, FREEZE_WIDTH = 2, 7, Decimal("5.0")

# --- Fixed values: avalanche terms ----------------------------------------------------------------------------------
THERMAL_ZERO_AT, THERMAL_WIDTH = -10, Decimal("15.0")
SOLAR_FULL_SUN_HOURS, SOLAR_ZERO_AT, SOLAR_WIDTH = Decimal("6.0"), -10, Decimal("10.0")
DRY_SLAB_MIN_DEPTH_M, DRY_SLAB_COVER_M = Decimal("0.01"), Decimal("0.5")
WET_SLAB_FULL_DEPTH_M = Decimal("2.0")
WIND_SLAB_FULL_SNOWFALL_CM, WIND_SLAB_FULL_GUST_MS = Decimal("30.0"), Decimal("20.0")

# --- Fixed values: weights of the combined scores ---------------------------------------------------------------------
WIND_WEIGHTS = (
    ("wind_score_summit", Decimal("0.6")),
    ("wind_score_gouter", Decimal("0.2")),
    ("wind_score_vallot", Decimal("0.2")),
)
COULOIR_WEIGHTS = (("grand_couloir_score_freeze", Decimal("0.6")), ("grand_couloir_score_thaw", Decimal("0.4")))
OVERALL_WEIGHTS = (
    ("wind_score", Decimal("0.25")),
    ("temperature_score", Decimal("0.15")),
    ("visibility_score", Decimal("0.15")),
    ("grand_couloir_score", Decimal("0.25")),
    ("avalanche_score", Decimal("0.20")),
)
IDEAL_MIN_SCORE = 75


# --- Fixed values: gates of the day flags ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Gates:
    """Inclusive upper limits of a day flag; gouter minimum must be below zero and the day must be dry."""

    summit_gust: int
    summit_coldest: int
    summit_warmest: int
    summit_cloud: int
    lower_gust: int
    snowfall_3d: int
    mean_temp_below: int | None = None


VIABLE = Gates(summit_gust=18, summit_coldest=-18, summit_warmest=2, summit_cloud=80, lower_gust=20, snowfall_3d=20)
RECOMMENDED = Gates(
    summit_gust=14, summit_coldest=-15, summit_warmest=2, summit_cloud=70, lower_gust=18, snowfall_3d=15,
    mean_temp_below=0,
)

# --- Fixed values: accepted ranges of the weather table, inclusive ----------------------------------------------------
ACCEPTED_RANGES = {
    "elevation": (1000, 5000),
    "temperature_max_c": (-60, 50),
    "temperature_min_c": (-60, 50),
    "windspeed_max_ms": (0, 100),
    "windgusts_max_ms": (0, 150),
    "precipitation_mm": (0, 500),
    "snowfall_cm": (0, 300),
    "snow_depth_m": (0, 20),
    "pressure_hpa": (500, 1100),
    "cloudcover_pct": (0, 100),
    "daylight_hours": (0, 24),
    "sunshine_hours": (0, 24),
    "air_density_kgm3": (Decimal("0.5"), Decimal("1.5")),
}

# Columns tested as never null, per table.
NOT_NULL = {
    "weather": ("waypoint_name", "elevation", "date", *MEASURES),
    "daily_conditions": ("waypoint_name", "date", "elevation"),
    "elevation_gradient": ("waypoint_name", "date", "elevation"),
    "summit_window": ("date", "is_viable", "is_recommended", "is_ideal", "overall_score"),
}


# --- Settings of a run ------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class LoadSettings:
    """Which days a load covers and how old data may be. `today` stands in for the clock, for replays and tests."""

    start: date = FIRST_LOAD_START
    fixed_end: date | None = FIXED_END
    lag_days: int = ARCHIVE_LAG_DAYS
    warn_after_days: int = WARN_AFTER_DAYS
    fail_after_days: int = FAIL_AFTER_DAYS
    today: date | None = None
    commit: str = "load"  # "load": one job and one watermark; "slice": one per calendar month
    requests_per_task: int = 500
    late_periods: bool = False  # take in re-fetched slices that start before the silver watermark
    capture_changes: bool = False  # keep the row changes of every weather upsert
    follow_changes: bool = False  # keep the models up from these changes, so that late slices reach all of them
    divert: bool = True  # write unusable days to the table of rejected days
    resume: str = "watermark"  # "watermark": ask for the days after it; "gaps": for the days no landed slice holds

    def __post_init__(self):
        if self.commit not in ("load", "slice"):
            raise ValueError(f"commit must be 'load' or 'slice', not {self.commit!r}")
        if self.resume not in ("watermark", "gaps"):
            raise ValueError(f"resume must be 'watermark' or 'gaps', not {self.resume!r}")


@dataclass(frozen=True)
class TableNames:
    """Two-level table names; `prefix` keeps environments apart (dev_silver.weather, prod_silver.weather)."""

    prefix: str = "dev"
    layers: tuple[str, ...] = field(default=("bronze", "silver", "gold", "meta"))

    def database(self, layer: str) -> str:
        if layer not in self.layers:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.prefix}_{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

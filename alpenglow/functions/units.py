"""Unit conversion and derived physics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alpenglow.config import DRY_AIR_GAS_CONSTANT, KELVIN_OFFSET
from alpenglow.schemas import MEASURE_TYPE


def measure(raw: Column, divisor: float | None = None) -> Column:
    """A raw payload number as a table measure: km/h to m/s is divisor 3.6, seconds to hours is 3600."""
    return (raw if divisor is None else raw / F.lit(divisor)).cast(MEASURE_TYPE)


def air_density(pressure_hpa: Column, temperature_c: Column) -> Column:
    """Dry-air density in kg/m3 from the already rounded pressure and temperature."""
    kelvin = temperature_c + F.lit(KELVIN_OFFSET)
    return (pressure_hpa * 100 / (F.lit(DRY_AIR_GAS_CONSTANT) * kelvin)).cast(MEASURE_TYPE)

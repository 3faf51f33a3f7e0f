"""Table and payload schemas, generated from the variable list where they follow it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from alpenglow.config import MEASURES, TIME_FIELD, VARIABLE_NAMES

MEASURE_TYPE = T.DecimalType(10, 2)

# Extra leading key of tables that hold several routes. Optional everywhere: without it a table is one route.
ROUTE_KEY = "route_id"

# The fetch a weather row stems from (period end, ingestion, payload hash); later ones compare as greater. Kept with the
# rows of the weather table, outside its fifteen columns.
FETCHED = "_fetched"

PAYLOAD = T.StructType([
    T.StructField(
        "daily",
        T.StructType(
            [T.StructField(TIME_FIELD, T.ArrayType(T.StringType()))]
            + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in VARIABLE_NAMES]
        ),
    )
])

WEATHER_RAW = T.StructType([
    T.StructField("waypoint_name", T.StringType(), False),
    T.StructField("elevation", T.IntegerType(), False),
    T.StructField("period_start", T.DateType(), False),
    T.StructField("period_end", T.DateType(), False),
    T.StructField("response_json", T.StringType(), False),
    T.StructField("ingestion_timestamp", T.TimestampType(), False),
])

WATERMARK = T.StructType([
    T.StructField("layer", T.StringType(), False),
    T.StructField("last_completed_date", T.DateType(), False),
])

WEATHER_COLUMNS = ("waypoint_name", "elevation", "date", *MEASURES)


def route_key(df: DataFrame) -> list[str]:
    """The route column if the table has one. Used as the leading key of every grouping, window and join."""
    return [ROUTE_KEY] if ROUTE_KEY in df.columns else []

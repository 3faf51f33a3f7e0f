"""Landing rows: fetched entries as typed raw rows."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alpenglow.schemas import WEATHER_RAW


def land_entries(spark: SparkSession, entries: Iterable[dict]) -> DataFrame:
    """Raw rows from a handful of entries held by the caller (waypoint_name, elevation, period_start, period_end,
    response). Bulk loads go through sources.archive, where the entries never leave the tasks."""
    given = T.StructType([field for field in WEATHER_RAW if field.name != "ingestion_timestamp"])
    rows = [
        (e["waypoint_name"], e["elevation"], e["period_start"], e["period_end"], json.dumps(e["response"]))
        for e in entries
    ]
    return spark.createDataFrame(rows, given).withColumn("ingestion_timestamp", F.current_timestamp())

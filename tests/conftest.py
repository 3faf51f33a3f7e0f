from __future__ import annotations

import sys
import uuid
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]

from helpers import CALM_DAY, HEIGHTS, WEATHER  # noqa: E402

from alpenglow.config import MEASURES, TableNames  # noqa: E402
from alpenglow.operators.tables import create_databases  # noqa: E402
from alpenglow.plans.medallion import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def views_go_with_their_test():
    """A catalog lists temporary views with the tables of every database."""
    yield
    session = SparkSession.getActiveSession()
    if session is not None:
        for found in session.catalog.listTables():
            if found.isTemporary:
                session.catalog.dropTempView(found.name)


@pytest.fixture
def tables(spark, tmp_path):
    names = TableNames(f"t_{uuid.uuid4().hex[:12]}")
    create_databases(spark, names, str(tmp_path / "tables"))
    return Tables(names)


@pytest.fixture
def weather_rows(spark):
    """Rows from (waypoint, date, overrides) on top of a calm day; with routes from (route, waypoint, date, overrides)."""

    def build(rows, routes=False):
        schema = WEATHER
        if routes:
            schema = T.StructType([T.StructField("route_id", T.LongType()), *WEATHER.fields])
        data = []
        for row in rows:
            *route, waypoint, day, overrides = row
            values = {**CALM_DAY, **overrides}
            measures = [None if values[name] is None else Decimal(str(values[name])) for name in MEASURES]
            data.append((*route, waypoint, HEIGHTS[waypoint], day, *measures))
        return spark.createDataFrame(data, schema)

    return build

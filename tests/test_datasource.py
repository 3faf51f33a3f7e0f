"""The archive as a data source: partitions, filters taken over, errors."""

import json
import sys
from datetime import date

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from alpenglow.config import NO_WATERMARK, LoadSettings
from alpenglow.schemas import WEATHER_RAW
from alpenglow.sources.archive import FetchError, MissingSliceError
from alpenglow.sources.datasource import FORMAT, load_archive, read_archive, register, stage_manifest
from alpenglow.sources.planner import request_manifest, waypoints, with_load_range

cloudpickle.register_pickle_by_value(sys.modules[__name__])
SETTINGS = LoadSettings(start=date(2020, 1, 10), fixed_end=date(2020, 4, 5))


class Echo:
    """Notes every request as a file; fails those for waypoints in `down`."""

    def __init__(self, folder, down=(), lacks=()):
        self.folder, self.down, self.lacks = str(folder), down, lacks

    def get(self, request):
        name = f"{request['waypoint_name']}_{request['start_date']}"
        with open(f"{self.folder}/{name}", "a") as out:
            out.write("x")
        if request["waypoint_name"] in self.down:
            raise FetchError("down")
        if request["waypoint_name"] in self.lacks:
            raise MissingSliceError(name)
        return {"asked": [request["waypoint_name"], request["start_date"], request["end_date"]]}


@pytest.fixture
def folders(tmp_path):
    (tmp_path / "asked").mkdir()
    return tmp_path / "asked", str(tmp_path / "manifest")


def manifest(spark):
    return request_manifest(with_load_range(waypoints(spark), NO_WATERMARK, SETTINGS))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_row_per_request_and_one_partition_per_group(spark, folders):
    asked, staged = folders
    df = read_archive(spark, manifest(spark), Echo(asked), staged, requests_per_task=6)
    assert df.columns == WEATHER_RAW.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in WEATHER_RAW]
    assert df.rdd.getNumPartitions() == 4
    rows = df.collect()
    assert len(rows) == 5 * 4 == len(list(asked.iterdir()))
    for row in rows:
        assert json.loads(row.response_json)["asked"] == [row.waypoint_name, str(row.period_start), str(row.period_end)]
        assert row.ingestion_timestamp is not None


def test_filters_are_taken_over_and_save_requests(spark, folders):
    asked, staged = folders
    df = read_archive(spark, manifest(spark), Echo(asked), staged, requests_per_task=3)
    wanted = df.filter(F.col("waypoint_name").isin("summit", "gouter") & (F.col("period_start") >= date(2020, 3, 1)))
    plan = plan_of(wanted)
    assert "BatchScan weather_archive" in plan and "Filter " not in plan, plan  # nothing is left to filter after the scan
    assert 0 < wanted.rdd.getNumPartitions() < 7  # files that hold nothing wanted are not scheduled
    assert {(r.waypoint_name, str(r.period_start)) for r in wanted.collect()} == {
        (name, day) for name in ("summit", "gouter") for day in ("2020-03-01", "2020-04-01")}
    assert len(list(asked.iterdir())) == 4
    assert df.rdd.getNumPartitions() == 7
    assert df.count() == 20 and df.filter("waypoint_name = 'summit'").count() == 4 and df.count() == 20
    both = [load_archive(spark, staged).filter(f"waypoint_name = '{name}'") for name in ("summit", "gouter")]
    found = both[0].union(both[1]).union(load_archive(spark, staged)).groupBy("waypoint_name").count().collect()
    assert sorted(map(tuple, found)) == [("chamonix", 4), ("gouter", 8), ("summit", 8), ("tete_rousse", 4), ("vallot", 4)]


@pytest.mark.parametrize("condition, n", [
    ("waypoint_name = 'summit'", 4), ("elevation > 4000", 8), ("elevation <= 1035", 4), ("period_end < DATE'2020-02-01'", 5),
    ("NOT waypoint_name = 'summit'", 16), ("waypoint_name LIKE 'ch%'", 4), ("length(waypoint_name) = 6", 12),
    ("response_json LIKE '%summit%'", 4), ("waypoint_name IS NULL", 0), ("period_start IN (DATE'2020-01-10', DATE'2020-03-01')", 10),
])
def test_filters_give_what_spark_would(spark, folders, condition, n):
    asked, staged = folders
    assert read_archive(spark, manifest(spark), Echo(asked), staged).filter(condition).count() == n


def test_errors_keep_their_type(spark, folders):
    asked, staged = folders
    with pytest.raises(Exception, match="MissingSliceError"):
        read_archive(spark, manifest(spark), Echo(asked, lacks=("summit",)), staged).collect()
    assert (asked / "summit_2020-01-10").read_text() == "x"
    for noted in asked.iterdir():
        noted.write_text("")
    register(spark, Echo(asked, down=("gouter",)))
    with pytest.raises(Exception, match="FetchError"):
        spark.read.format(FORMAT).option("manifest", staged).load().filter("waypoint_name = 'gouter'").collect()
    assert (asked / "gouter_2020-01-10").read_text() == "xxx"  # three attempts


def test_routes_lead_and_empty_manifests_read_as_empty(spark, folders):
    asked, staged = folders
    df = read_archive(spark, manifest(spark).withColumn("route_id", F.lit(7)), Echo(asked), staged)
    assert df.columns == ["route_id", *WEATHER_RAW.fieldNames()] and df.select("route_id").distinct().collect() == [(7,)]
    nothing = stage_manifest(manifest(spark).limit(0), staged + "_none")
    assert spark.read.format(FORMAT).option("manifest", nothing).load().collect() == []

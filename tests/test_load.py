"""The load end to end: batch, slice by slice, late slices, and as a stream."""

import sys
from dataclasses import replace
from datetime import date, datetime, timedelta

import helpers
import pytest
from helpers import daily, payload
from pyspark import cloudpickle
from pyspark.sql import functions as F

from alpenglow.config import NO_WATERMARK, LoadSettings
from alpenglow.operators.tables import read_watermark
from alpenglow.plans import medallion as md
from alpenglow.plans.summit import summit_window
from alpenglow.schemas import WEATHER_RAW
from alpenglow.sources.archive import FetchError
from alpenglow.sources.planner import waypoints
from alpenglow.streaming.silver import stream_silver

for module in (helpers, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(module)  # Station runs in the Python workers

SETTINGS = LoadSettings(start=date(2024, 1, 10), fixed_end=date(2024, 2, 20), today=date(2024, 3, 1))


class Station:
    """Weather that depends on the day; requests for months in `down` fail."""

    def __init__(self, down=(), temperature=-5.0):
        self.down = down
        self.temperature = temperature

    def get(self, request):
        if request["start_date"][:7] in self.down:
            raise FetchError("down")
        first, last = (date.fromisoformat(request[name]) for name in ("start_date", "end_date"))
        times = [str(first + timedelta(days=n)) for n in range((last - first).days + 1)]
        count = len(times)
        return {"daily": daily(
            times, temperature_2m_max=[self.temperature] * count, temperature_2m_min=[-12.0] * count,
            surface_pressure_mean=[600.0] * count, precipitation_sum=[0.0] * count,
        )}


def marks(spark, tables):
    return tuple(read_watermark(spark, tables.watermark, layer) for layer in ("bronze", "silver"))


def test_two_runs_build_every_table(spark, tables):
    first = md.run_load(spark, tables, waypoints(spark), Station(), SETTINGS)
    assert first.loaded_to == date(2024, 2, 20) and first.freshness == "pass"
    assert (first.silver.created, first.silver.rows) == (True, 5 * 42)
    assert marks(spark, tables) == (date(2024, 2, 20), date(2024, 2, 20))

    later = replace(SETTINGS, fixed_end=date(2024, 3, 31), today=date(2024, 4, 15))
    second = md.run_load(spark, tables, waypoints(spark), Station(), later)
    assert second.freshness == "warn"
    assert (second.silver.created, second.silver.rows) == (False, 5 * 40)
    assert second.silver.min_date == date(2024, 2, 21)
    assert spark.table(tables.weather).count() == 5 * 82
    for model, rows in (
        ("daily_conditions", 5 * 82), ("elevation_gradient", 5 * 82), ("summit_window", 82),
        ("monthly_conditions", 5 * 3), ("seasonal_summary", 3),
    ):
        assert spark.table(tables.gold(model)).count() == rows, model
    full = summit_window(spark.table(tables.weather).drop("month"))
    stored = spark.table(tables.gold("summit_window")).select(full.columns)
    assert full.exceptAll(stored).isEmpty()
    february = spark.table(tables.gold("monthly_conditions")).filter("waypoint_name = 'summit' AND month = '2024-02-01'")
    assert february.first().n_days == 29


def test_nothing_due_loads_nothing(spark, tables):
    assert md.load_bronze(spark, tables, waypoints(spark), Station(), SETTINGS) is not None
    assert md.load_bronze(spark, tables, waypoints(spark), Station(), SETTINGS) is None
    assert spark.table(tables.raw).count() == 5 * 2


def test_slices_resume_where_the_load_stopped(spark, tables):
    settings = replace(SETTINGS, commit="slice")
    with pytest.raises(Exception, match="down"):
        md.load_bronze(spark, tables, waypoints(spark), Station(down=["2024-02"]), settings)
    assert marks(spark, tables) == (date(2024, 1, 31), NO_WATERMARK)
    md.load_bronze(spark, tables, waypoints(spark), Station(), settings)
    raw = spark.table(tables.raw)
    assert {(r.period_start, r["count"]) for r in raw.groupBy("period_start").count().collect()} == {
        (date(2024, 1, 10), 5), (date(2024, 2, 1), 5)
    }


def test_a_failed_single_commit_leaves_nothing(spark, tables):
    with pytest.raises(Exception, match="down"):
        md.load_bronze(spark, tables, waypoints(spark), Station(down=["2024-02"]), SETTINGS)
    assert marks(spark, tables) == (NO_WATERMARK, NO_WATERMARK)
    assert not spark.catalog.tableExists(tables.raw)


def test_old_data_fails_the_run(spark, tables):
    with pytest.raises(md.QualityError, match="days old"):
        md.run_load(spark, tables, waypoints(spark), Station(), replace(SETTINGS, today=date(2024, 3, 20)))


def test_violations_fail_the_run(spark, tables):
    with pytest.raises(md.QualityError, match="weather.temperature_max_c accepted_range"):
        md.run_load(spark, tables, waypoints(spark), Station(temperature=70.0), SETTINGS)


def raw_rows(spark, *slices):
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in WEATHER_RAW)
    rows = [("summit", 4808, start, end, text) for start, end, text in slices]
    given = spark.createDataFrame(rows, schema.rsplit(",", 1)[0])
    return given.withColumn("ingestion_timestamp", F.current_timestamp())


JANUARY = (date(2024, 1, 1), date(2024, 1, 31))
FEBRUARY = (date(2024, 2, 1), date(2024, 2, 29))


def tmax(spark, tables):
    return {str(r.date): float(r.temperature_max_c) for r in spark.table(tables.weather).collect()}


@pytest.mark.parametrize("late, expected", [(False, 5.0), (True, 9.0)])
def test_refetched_older_slices(spark, tables, late, expected):
    md.append_raw(raw_rows(spark, (*JANUARY, payload(["2024-01-05"])), (*FEBRUARY, payload(["2024-02-05"]))), tables.raw)
    md.load_silver(spark, tables, late_periods=late)
    again = payload(["2024-01-05"], temperature_2m_max=[9.0])
    md.append_raw(raw_rows(spark, (*JANUARY, again)), tables.raw)
    md.load_silver(spark, tables, late_periods=late)
    assert tmax(spark, tables) == {"2024-01-05": expected, "2024-02-05": 5.0}
    assert marks(spark, tables)[1] == date(2024, 2, 5)


def test_stream_takes_files_once_and_resumes(spark, tables, tmp_path):
    landing, progress = str(tmp_path / "landing"), str(tmp_path / "progress")

    def deliver(*slices):
        rows = raw_rows(spark, *slices)
        rows.coalesce(1).write.mode("append").parquet(landing)
        query = stream_silver(spark, landing, rows.schema, tables, progress, max_files_per_batch=1)
        query.awaitTermination()
        return query.lastProgress

    deliver((*JANUARY, payload(["2024-01-05", "2024-01-06"])), (*JANUARY, "broken"))
    assert tmax(spark, tables) == {"2024-01-05": 5.0, "2024-01-06": 5.0}
    deliver((*FEBRUARY, payload(["2024-02-05"])))
    deliver((*JANUARY, payload(["2024-01-05"], temperature_2m_max=[7.0])))
    assert tmax(spark, tables) == {"2024-01-05": 7.0, "2024-01-06": 5.0, "2024-02-05": 5.0}
    assert marks(spark, tables)[1] == date(2024, 2, 5)
    # Nothing new: nothing happens.
    query = stream_silver(spark, landing, raw_rows(spark).schema, tables, progress)
    query.awaitTermination()
    assert len(tmax(spark, tables)) == 3


def test_a_load_that_follows_changes_takes_late_slices_to_all_models(spark, tables):
    settings = replace(SETTINGS, late_periods=True, follow_changes=True)
    md.run_load(spark, tables, waypoints(spark), Station(), settings, check_freshness=False)
    late = md.month_slices(waypoints(spark).withColumns({"load_start": F.lit(date(2024, 1, 12)), "load_end": F.lit(date(2024, 1, 14))}))
    again = md.fetch_payloads(md.request_manifest(waypoints(spark).withColumns(
        {"load_start": F.lit(date(2024, 1, 12)), "load_end": F.lit(date(2024, 2, 1))})), Station(temperature=4.0))
    assert late.count() == 5
    md.append_raw(again.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 DAY")), tables.raw)
    md.run_load(spark, tables, waypoints(spark), Station(), settings, check_freshness=False)
    weather = spark.table(tables.weather)
    assert weather.filter("temperature_max_c = 4").count() > 0
    full = summit_window(weather.drop("month"))
    found = spark.table(tables.gold("summit_window")).select(*full.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, full.collect()))


def test_a_load_by_gaps_asks_for_what_is_not_there(spark, tables):
    asked = []
    settings = replace(SETTINGS, resume="gaps")
    first = md.fetch_payloads(md.request_manifest(waypoints(spark).filter("waypoint_name <> 'summit'").withColumns(
        {"load_start": F.lit(date(2024, 1, 15)), "load_end": F.lit(date(2024, 2, 20))})), Station())
    md.append_raw(first, tables.raw)
    assert md.load_bronze(spark, tables, waypoints(spark), Station(), settings) == date(2024, 2, 20)
    asked = {(r.waypoint_name, r.period_start, r.period_end) for r in spark.table(tables.raw).collect()}
    assert {(date(2024, 1, 10), date(2024, 1, 14)), (date(2024, 1, 15), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 20))} == {
        x[1:] for x in asked if x[0] == "gouter"}
    assert {x[1:] for x in asked if x[0] == "summit"} == {(date(2024, 1, 10), date(2024, 1, 31)), (date(2024, 2, 1), date(2024, 2, 20))}
    assert md.load_bronze(spark, tables, waypoints(spark), Station(), settings) is None
    assert read_watermark(spark, tables.watermark, "bronze") == date(2024, 2, 20)


def test_rejected_days_are_kept_once(spark, tables):
    times = ["2024-01-10", "2024-13-11", "2024-01-12"]
    raw = spark.createDataFrame([("summit", 4808, date(2024, 1, 1), date(2024, 1, 31), payload(times), datetime(2024, 2, 8))], WEATHER_RAW)
    md.append_raw(raw, tables.raw)
    for _ in range(2):
        md.load_silver(spark, tables, late_periods=True, divert=True)
    assert [(r.position, r.reason) for r in spark.table(tables.rejected).collect()] == [(1, "bad_date")]
    assert sorted(r.date.day for r in spark.table(tables.weather).collect()) == [10, 12]


@pytest.mark.parametrize("files_per_batch", [1, 50])
def test_the_stream_does_not_depend_on_batches_or_arrival(spark, tables, tmp_path, files_per_batch):
    landing = str(tmp_path / "landing")
    fetches = [(5.0, date(2024, 2, 29)), (3.0, date(2024, 1, 31)), (4.0, date(2024, 2, 10))]  # the newest lands first
    for value, period_end in fetches:
        rows = [("summit", 4808, date(2024, 1, 1), period_end, payload(["2024-01-05"], temperature_2m_max=[value]), datetime(2024, 3, 1))]
        spark.createDataFrame(rows, WEATHER_RAW).coalesce(1).write.mode("append").parquet(landing)
    stream_silver(spark, landing, WEATHER_RAW, tables, str(tmp_path / "progress"), files_per_batch).awaitTermination()
    assert [float(r.temperature_max_c) for r in spark.table(tables.weather).collect()] == [5.0]

"""Upserts by recency, deletions, kept changes, earlier states, progress notes."""

import re
from datetime import date
from decimal import Decimal

import pytest
from helpers import days
from pyspark.sql import functions as F

from alpenglow.operators import tables as tb
from alpenglow.plans.gradient import elevation_gradient
from alpenglow.schemas import FETCHED

KEYS = ["waypoint_name", "date"]
FIRST = date(2024, 1, 30)


@pytest.fixture
def rows(weather_rows):
    """Some days of gouter with a temperature each."""

    def make(*given):
        return weather_rows([("gouter", day, {"temperature_max_c": value}) for day, value in given])

    return make


def state(df):
    return sorted((r.date, float(r.temperature_max_c)) for r in df.collect())


def test_only_newer_rows_replace(spark, tables, rows):
    day, other = days(FIRST, 2)

    def fetched(number, *given):
        return rows(*given).withColumn(FETCHED, F.struct(F.lit(number).alias("fetch")))

    tb.upsert(fetched(5, (day, 5)), tables.weather, KEYS, newer_by=FETCHED)
    tb.upsert(fetched(3, (day, 3), (other, 3)), tables.weather, KEYS, newer_by=FETCHED)
    assert state(spark.table(tables.weather)) == [(day, 5.0), (other, 3.0)]
    tb.upsert(fetched(5, (day, 9)), tables.weather, KEYS, newer_by=FETCHED)  # not newer
    tb.upsert(fetched(6, (other, 6)), tables.weather, KEYS, newer_by=FETCHED)
    assert state(spark.table(tables.weather)) == [(day, 5.0), (other, 6.0)]
    with pytest.raises(ValueError, match="no column"):
        tb.upsert(rows((day, 1)), tables.weather, KEYS, newer_by="_other")


def test_rows_that_go(spark, tables, rows):
    january, february = date(2024, 1, 30), date(2024, 2, 1)
    tb.upsert(rows((january, 1), (february, 2), (date(2024, 3, 1), 3)), tables.weather, KEYS)
    gone = spark.createDataFrame([("gouter", january), ("gouter", february), ("gouter", date(2030, 1, 1))], "waypoint_name string, date date")
    tb.upsert(rows((february, 7), (date(2024, 4, 1), 4)), tables.weather, KEYS, gone=gone)
    assert state(spark.table(tables.weather)) == [(february, 7.0), (date(2024, 3, 1), 3.0), (date(2024, 4, 1), 4.0)]
    assert tb.table_months(spark, tables.weather) == [date(2024, 2, 1), date(2024, 3, 1), date(2024, 4, 1)]
    assert not [t.name for t in spark.catalog.listTables(tables.names.database("silver")) if "__" in t.name]


def test_a_deletion_that_broke_off_is_finished(spark, tables, rows, monkeypatch):
    january = date(2024, 1, 30)
    tb.upsert(rows((january, 1), (date(2024, 2, 1), 2)), tables.weather, KEYS)
    replaced = tb.replace_partitions

    def breaks(*args, **how):
        replaced(*args, **how)
        raise RuntimeError("lost")

    monkeypatch.setattr(tb, "replace_partitions", breaks)
    gone = rows((january, 0)).select(*KEYS)
    with pytest.raises(RuntimeError):
        tb.upsert(rows((date(2024, 2, 2), 3)), tables.weather, KEYS, gone=gone, capture_changes=True)
    monkeypatch.undo()
    assert tb.recover(spark, tables.weather, KEYS) == 1
    assert state(spark.table(tables.weather)) == [(date(2024, 2, 1), 2.0), (date(2024, 2, 2), 3.0)]
    assert state(tb.as_of(spark, tables.weather, KEYS, 0)) == [(january, 1.0), (date(2024, 2, 1), 2.0)]


def test_every_earlier_state_and_its_validity(spark, tables, rows):
    a, b, c = days(FIRST, 3)
    states = [{a: 1.0, b: 2.0}, {a: 1.5, b: 2.0, c: 3.0}, {a: 1.5, c: 3.5}, {a: 1.5, b: 9.0, c: 3.5}, {a: 1.0, b: 9.0, c: 3.5}]
    tb.upsert(rows(*states[0].items()), tables.weather, KEYS, capture_changes=True)
    assert tb.version(spark, tables.weather) == 0 and tb.commits(spark, tables.weather) == []
    for old, new in zip(states[:-1], states[1:], strict=True):
        gone = rows(*[(day, 0) for day in old.keys() - new.keys()]).select(*KEYS)
        tb.upsert(rows(*new.items()), tables.weather, KEYS, capture_changes=True, gone=gone)
    assert tb.version(spark, tables.weather) == 4
    for at, expected in enumerate(states):
        assert state(tb.as_of(spark, tables.weather, KEYS, at)) == sorted(expected.items())
    found = {(r.date, float(r.temperature_max_c), r.valid_from, r.valid_to) for r in tb.validity(spark, tables.weather, KEYS).collect()}
    assert found == {
        (a, 1.0, None, 1), (a, 1.5, 1, 4), (a, 1.0, 4, None), (b, 2.0, None, 2), (b, 9.0, 3, None), (c, 3.0, 1, 2), (c, 3.5, 2, None)}
    assert tb.changes_between(spark, tables.weather, 1, 2).select("version").distinct().collect() == [(2,)]


def test_net_changes_leave_out_what_came_and_went(spark, tables, rows):
    a, b = days(FIRST, 2)
    tb.upsert(rows((a, 1)), tables.weather, KEYS, capture_changes=True)
    tb.upsert(rows((a, 2), (b, 5)), tables.weather, KEYS, capture_changes=True)
    tb.upsert(rows((a, 3)), tables.weather, KEYS, capture_changes=True, gone=rows((b, 0)).select(*KEYS))
    net = tb.net_changes(tb.changes_between(spark, tables.weather, 0), KEYS)
    found = sorted((r.date, r._change_type, r.temperature_max_c) for r in net.collect())
    assert found == [(a, "update_postimage", Decimal("3.00")), (a, "update_preimage", Decimal("1.00")), (b, "delete", Decimal("5.00"))] or \
        found == [(a, "update_postimage", Decimal("3.00")), (a, "update_preimage", Decimal("1.00"))]


def test_changes_do_not_count_fetches(spark, tables, rows):
    day = FIRST
    for fetch in (1, 2):
        given = rows((day, 1)).withColumn(FETCHED, F.struct(F.lit(fetch).alias("fetch")))
        tb.upsert(given, tables.weather, KEYS, capture_changes=True)
    assert tb.changes_between(spark, tables.weather, 0).count() == 0


def test_progress_is_noted_and_seeded(spark, tables, weather_rows):
    def of(*routes):
        return weather_rows([(route, "gouter", day, {}) for route, day in routes], routes=True)

    keys = ["route_id", *KEYS]
    tb.upsert(of((1, date(2024, 1, 5)), (2, date(2024, 1, 7))), tables.weather, keys)
    seeded = {r.route_id: (r.first_day, r.last_day) for r in tb.progress(spark, tables.weather, ["route_id"]).collect()}
    assert seeded == {1: (date(2024, 1, 5), date(2024, 1, 5)), 2: (date(2024, 1, 7), date(2024, 1, 7))}
    tb.upsert(of((1, date(2024, 2, 1)), (3, date(2023, 1, 1))), tables.weather, keys, progress_by=["route_id"])
    found = {r.route_id: (r.first_day, r.last_day) for r in tb.progress(spark, tables.weather, ["route_id"]).collect()}
    assert found == {**seeded, 1: (date(2024, 1, 5), date(2024, 2, 1)), 3: (date(2023, 1, 1), date(2023, 1, 1))}


def test_a_refresh_reads_the_open_months_alone(spark, tables, weather_rows, monkeypatch):
    """Cutoffs come from notes: the target is not read at all, the source from the earliest open month on."""
    keys = ["route_id", *KEYS]

    def of(first, count):
        return weather_rows([(route, "gouter", day, {}) for route in (1, 2) for day in days(first, count)], routes=True)

    target = tables.gold("elevation_gradient")
    tb.upsert(of(date(2023, 1, 1), 300), tables.weather, keys, progress_by=["route_id"])
    tb.refresh_new_dates(spark.table(tables.weather), target, keys, elevation_gradient)
    tb.upsert(of(date(2023, 10, 28), 20), tables.weather, keys, progress_by=["route_id"])
    plans, real = [], tb.upsert

    def watched(batch, *args, **how):
        plans.append(batch._jdf.queryExecution().executedPlan().toString())
        return real(batch, *args, **how)

    monkeypatch.setattr(tb, "upsert", watched)
    ends = tb.progress(spark, tables.weather, ["route_id"])
    result = tb.refresh_new_dates(spark.table(tables.weather), target, keys, elevation_gradient, ends)
    assert (result.rows, result.min_date, result.max_date) == (40, date(2023, 10, 28), date(2023, 11, 16))
    scans = re.findall(r"FileScan parquet \S*?\.(\w+)\[.*?PartitionFilters: \[(.*?)\], PushedFilters", plans[0])
    assert {name for name, _ in scans} == {"weather", "elevation_gradient_progress"}
    assert all(">= 2023-10-01" in filters for name, filters in scans if name == "weather")


def test_a_table_that_was_never_noted_is_noted_in_whole(spark, tables, weather_rows):
    keys = ["route_id", *KEYS]
    for day, noted in ((date(2024, 1, 5), []), (date(2024, 3, 5), ["route_id"])):
        tb.upsert(weather_rows([(1, "gouter", day, {})], routes=True), tables.weather, keys, progress_by=noted)
    row = tb.progress(spark, tables.weather, ["route_id"]).first()
    assert (row.first_day, row.last_day) == (date(2024, 1, 5), date(2024, 3, 5))

"""Models kept up from the weather table's changes equal a full rebuild, whatever arrives and wherever a run breaks off."""

import random
import re
from collections import Counter
from datetime import date, timedelta

import pytest
from helpers import HEIGHTS, days

from alpenglow.operators import tables as tb
from alpenglow.plans import conditions as cond
from alpenglow.plans import summit as sm
from alpenglow.plans import upkeep
from alpenglow.plans.gradient import elevation_gradient

FIRST = date(2023, 1, 1)


def random_rows(seed, dates, routes=(1, 2), share=0.7):
    rng = random.Random(seed)
    return [
        (route, name, day, {x: rng.randint(-15, 9) for x in ("temperature_max_c", "temperature_min_c", "snow_depth_m")}
         | {"windgusts_max_ms": rng.randint(0, 30), "precipitation_mm": rng.choice([0, 0, None, 3])})
        for route in routes for name in HEIGHTS for day in dates if rng.random() < share
    ]


def bag(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def expected(weather):
    summit = sm.summit_window(weather)
    return {
        "monthly_conditions": cond.monthly_conditions(weather), "elevation_gradient": elevation_gradient(weather),
        "summit_window": summit, "seasonal_summary": cond.seasonal_summary(weather, summit),
    }


def check(spark, tables):
    weather = spark.table(tables.weather).drop(tb.MONTH)
    for name, full in expected(weather).items():
        found = spark.table(tables.gold(name))
        if name not in ("monthly_conditions", "seasonal_summary"):
            found = found.drop(tb.MONTH)
        assert {f.name: f.dataType for f in found.schema} == {f.name: f.dataType for f in full.schema}, name
        assert bag(found) == bag(full), name


@pytest.fixture
def put(spark, tables, weather_rows):
    keys = ["route_id", "waypoint_name", "date"]

    def upsert(rows, gone=()):
        lost = weather_rows([(*key, {}) for key in gone], routes=True).select(*keys) if gone else None
        tb.upsert(weather_rows(rows, routes=True), tables.weather, keys, capture_changes=True, gone=lost)

    return upsert


def test_late_slices_corrections_and_deletions_reach_all_models(spark, tables, put):
    span = days(FIRST, 72)
    put(random_rows(1, span[:60]))
    assert upkeep.follow_changes(spark, tables) == 0
    check(spark, tables)
    put(random_rows(2, span[60:]))  # new days
    put(random_rows(3, span[20:24], share=0.3))  # a late slice: some rows corrected, some inserted
    put([], gone=[(1, name, day) for name in HEIGHTS for day in span[31:59]])  # a whole month of a route goes
    assert upkeep.follow_changes(spark, tables) == 3
    check(spark, tables)
    assert upkeep.follow_changes(spark, tables) == 3  # nothing to do
    check(spark, tables)


def test_a_month_without_rows_goes_and_comes_back(spark, tables, put):
    rows = random_rows(4, days(FIRST, 62), routes=(1,), share=0.9)
    put(rows)
    upkeep.follow_changes(spark, tables)
    february = [(r[0], r[1], r[2]) for r in rows if r[2].month == 2]
    put([], gone=february)
    upkeep.follow_changes(spark, tables)
    check(spark, tables)
    put([r for r in rows if r[2].month == 2][:40])
    upkeep.follow_changes(spark, tables)
    check(spark, tables)


@pytest.mark.parametrize("breaks_at", ["monthly_conditions", "summit_window", "seasonal_states"])
def test_a_run_that_broke_off_is_repeated(spark, tables, put, monkeypatch, breaks_at):
    put(random_rows(5, days(FIRST, 40), routes=(1,)))
    upkeep.follow_changes(spark, tables)
    put(random_rows(6, days(FIRST + timedelta(days=25), 10), routes=(1, 2)))

    def broken(real):
        def run(*args, **how):
            table = next(x for x in args if isinstance(x, str))
            if table.endswith(breaks_at):
                raise RuntimeError("lost")
            return real(*args, **how)

        return run

    for module, name in ((upkeep, "upsert"), (cond, "_replace_groups")):
        monkeypatch.setattr(module, name, broken(getattr(module, name)))
    with pytest.raises(RuntimeError):
        upkeep.follow_changes(spark, tables)
    monkeypatch.undo()
    put(random_rows(7, days(FIRST, 5), routes=(1,)))  # more has come meanwhile
    upkeep.follow_changes(spark, tables)
    check(spark, tables)


def test_only_affected_days_are_computed_again(spark, weather_rows):
    """A change reaches its own day and the 29 gouter days after it, across gaps."""
    calendar = days(FIRST, 200)
    gouter = [day for k, day in enumerate(calendar) if k % 3 or k > 150]
    weather = weather_rows([(1, "gouter", day, {}) for day in gouter] + [(2, "gouter", day, {}) for day in gouter], routes=True)
    changed = spark.createDataFrame([(1, calendar[30]), (1, calendar[160])], "route_id bigint, date date")  # no gouter row on day 30
    found = sorted(r.date for r in sm.days_affected(weather, changed).collect())
    after = [day for day in gouter if day > calendar[30]][:30]
    assert set(found) >= {calendar[30], *after[:29], calendar[160], *calendar[161:190]}
    assert set(found) <= {calendar[30], *after, *calendar[160:191]}
    assert {r.route_id for r in sm.days_affected(weather, changed).collect()} == {1}


def test_the_read_is_pruned_to_the_affected_months(spark, tables, put):
    put(random_rows(8, days(FIRST, 240), routes=(1,), share=0.95))
    weather = spark.table(tables.weather)
    affected = spark.createDataFrame([(1, date(2023, 7, 10))], "route_id bigint, date date")
    rows = sm.recompute_days(weather, affected)
    assert [r.date for r in rows.collect()] in ([date(2023, 7, 10)], [])
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", rows._jdf.queryExecution().executedPlan().toString())
    assert filters and all(re.search(r">= 2023-0[56]-01", x) and "<= 2023-07-01" in x for x in filters), filters

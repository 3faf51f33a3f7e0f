import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from helpers import HEIGHTS, days
from pyspark.sql import functions as F

from alpenglow.operators.tables import with_month
from alpenglow.plans import summit as sm

START = date(2024, 1, 1)
ROLES = ("tete_rousse", "gouter", "vallot", "summit")


def table(weather_rows, dates, overrides=(), skip=()):
    """All route waypoints on all dates; overrides {(waypoint, date): {...}}; skip [(waypoint, date)]."""
    overrides = dict(overrides)
    return weather_rows([
        (w, d, overrides.get((w, d), {})) for d in dates for w in ROLES if (w, d) not in skip
    ])


def by_date(df):
    return {r.date: r for r in df.collect()}


def test_a_calm_day(weather_rows):
    row = by_date(sm.summit_window(table(weather_rows, days(START, 1))))[START]
    assert (row.wind_score_summit, row.wind_score_gouter, row.wind_score) == (100, 100, 100)
    assert (row.temperature_score_cold, row.temperature_score_heat, row.temperature_score) == (100, 100, 100)
    assert row.visibility_score == 100
    assert (row.grand_couloir_score_freeze, row.grand_couloir_score_thaw) == (100, 100)
    assert row.avalanche_risk_thermal == 33  # 100 * (-5 + 10) / 15
    assert row.avalanche_risk_solar == 50  # 6/6 h of sun at half of the temperature range
    assert row.avalanche_risk_dry_slab == 0  # a metre of snow covered the ice
    assert row.avalanche_risk_wet_slab == 25  # half of 50
    assert row.avalanche_risk_wind_slab == 0
    assert row.avalanche_score == 75
    assert row.overall_score == 95
    assert (row.is_viable, row.is_recommended, row.is_ideal) == (True, True, True)
    assert row.gouter_3d_temp_mean_c == Decimal("-8.50")
    assert row.route_7d_snow_depth_change_m is None


@pytest.mark.parametrize("column, waypoint, measure, values", [
    ("wind_score_summit", "summit", "windgusts_max_ms", {"7": 100, "10.5": 50, "14": 0, "30": 0}),
    ("wind_score_vallot", "vallot", "windgusts_max_ms", {"9": 100, "13.5": 50, "18": 0}),
    ("temperature_score_cold", "summit", "temperature_max_c", {"-10": 100, "-12.5": 50, "-15": 0, "-30": 0}),
    ("temperature_score_heat", "summit", "temperature_max_c", {"0": 100, "1": 50, "2": 0, "9": 0}),
    ("grand_couloir_score_freeze", "gouter", "temperature_max_c", {"2": 100, "4.5": 50, "7": 0, "12": 0}),
    ("visibility_score", "summit", "cloudcover_pct", {"30": 100, "55": 50, "80": 0, "100": 0}),
])
def test_ramps(weather_rows, column, waypoint, measure, values):
    dates = days(START, len(values))
    overrides = {(waypoint, d): {measure: v} for d, v in zip(dates, values, strict=True)}
    found = by_date(sm.summit_window(table(weather_rows, dates, overrides)))
    assert [found[d][column] for d in dates] == list(values.values())


def test_missing_measures_score_as_the_bounds(weather_rows):
    gust, cold, warm = days(START, 3)
    found = by_date(sm.summit_window(table(weather_rows, (gust, cold, warm), {
        ("summit", gust): {"windgusts_max_ms": None},
        ("summit", cold): {"temperature_max_c": None},
        ("gouter", warm): {"temperature_max_c": None},
    })))
    assert found[gust].wind_score_summit == 100
    assert found[gust].is_viable is None and found[gust].is_recommended is None
    assert (found[cold].temperature_score_cold, found[cold].temperature_score_heat) == (0, 0)
    assert found[warm].grand_couloir_score_freeze == 0
    assert found[warm].avalanche_risk_solar == 0


def test_a_failed_gate_beats_an_unknown_one(weather_rows):
    overrides = {("summit", START): {"windgusts_max_ms": None, "cloudcover_pct": 99}}
    row = by_date(sm.summit_window(table(weather_rows, [START], overrides)))[START]
    assert row.is_viable is False and row.is_ideal is False


def test_viable_is_wider_than_recommended(weather_rows):
    row = by_date(sm.summit_window(table(weather_rows, [START], {("summit", START): {"windgusts_max_ms": 16}})))[START]
    assert (row.is_viable, row.is_recommended, row.is_ideal) == (True, False, False)


def test_scores_have_the_decimal_stages_of_plain_sql(spark, weather_rows):
    """A snowfall sum of 3.333333 and a gust of 6.3 make 3.49999965 points, which the decimal product carries as
    3.500000: the score must be the one the same formula gives in Spark SQL."""
    dates = days(START, 2)
    overrides = {("gouter", d): {"windgusts_max_ms": "6.3"} for d in dates}
    df = table(weather_rows, dates, {**overrides, ("summit", dates[0]): {"snowfall_cm": 10}}, skip=[("tete_rousse", dates[0])])
    scored = sm.with_sub_scores(sm.complete_days(sm.rolling_conditions(sm.route_pivot(df))))
    plain = scored.selectExpr(
        "date", "avalanche_risk_wind_slab AS found",
        "least(100, greatest(0, round(least(1.0, route_3d_snowfall / 30.0)"
        " * least(1.0, gouter_windgusts_max_ms / 20.0) * 100))) AS expected",
    )
    assert plain.schema["found"].dataType == plain.schema["expected"].dataType
    assert [(r.found, r.expected) for r in plain.collect()] == [(4, 4), (4, 4)]


def test_any_snow_anywhere_closes_the_day(weather_rows):
    row = by_date(sm.summit_window(table(weather_rows, [START], {("tete_rousse", START): {"snowfall_cm": "0.1"}})))[START]
    assert row.is_viable is False
    assert row.route_snowfall_cm == Decimal("0.03")  # averaged over the four waypoints: 0.025


def test_windows_count_gouter_days_even_without_summit(weather_rows):
    dates = days(START, 3)
    overrides = {("gouter", d): {"temperature_max_c": t, "temperature_min_c": t} for d, t in zip(dates, (0, 3, 6), strict=True)}
    found = by_date(sm.summit_window(table(weather_rows, dates, overrides, skip=[("summit", dates[1])])))
    assert set(found) == {dates[0], dates[2]}
    assert found[dates[2]].gouter_3d_temp_mean_c == Decimal("3.00")


def test_windows_stretch_over_gaps(weather_rows):
    dates = [START, START + timedelta(days=100), START + timedelta(days=200)]
    overrides = {("gouter", d): {"temperature_max_c": t} for d, t in zip(dates, (0, 3, 6), strict=True)}
    found = by_date(sm.summit_window(table(weather_rows, dates, overrides)))
    assert found[dates[2]].gouter_30d_temp_max_c == Decimal("3.00")


def test_depth_change_looks_seven_rows_back(weather_rows):
    dates = days(START, 8)
    overrides = {(w, d): {"snow_depth_m": n} for n, d in enumerate(dates) for w in ("tete_rousse", "gouter", "vallot")}
    found = by_date(sm.summit_window(table(weather_rows, dates, overrides)))
    assert found[dates[7]].route_7d_snow_depth_change_m == Decimal("7.000")
    assert found[dates[6]].route_7d_snow_depth_change_m is None
    assert found[dates[7]].route_30d_snow_depth_m == Decimal("3.500")


@pytest.mark.parametrize("role", ["summit", "gouter", "vallot"])
def test_every_role_must_be_present(weather_rows, role):
    assert sm.summit_window(table(weather_rows, [START], skip=[(role, START)])).count() == 0


def random_weather(weather_rows, routes, count, seed, density=0.8):
    rng = random.Random(seed)
    rows = [
        (route, w, d, {
            "temperature_max_c": round(rng.uniform(-20, 8), 2), "temperature_min_c": round(rng.uniform(-30, -1), 2),
            "windgusts_max_ms": round(rng.uniform(0, 25), 1), "snowfall_cm": round(rng.choice([0, 0, rng.uniform(0, 20)]), 1),
            "snow_depth_m": round(rng.uniform(0, 2), 2), "sunshine_hours": round(rng.uniform(0, 10), 2),
        })
        for route in routes for d in days(START, count) for w in HEIGHTS if rng.random() < density
    ]
    return weather_rows(rows, routes=True)


def test_the_table_is_read_once(weather_rows, spark, tmp_path):
    random_weather(weather_rows, [1], 5, 1).write.parquet(str(tmp_path / "w"))
    plan = sm.summit_window(spark.read.parquet(str(tmp_path / "w")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Window [") == 1


@pytest.mark.parametrize("routes", [True, False])
def test_incremental_refresh_equals_a_full_run(spark, tables, weather_rows, routes):
    # Route 2 is so sparse that its windows reach back over most of the record; route 3 starts after the cutoff.
    weather = random_weather(weather_rows, [1], 150, 2)
    if routes:
        weather = weather.unionByName(random_weather(weather_rows, [2], 150, 3, density=0.35)).unionByName(
            random_weather(weather_rows, [3], 150, 4).filter(F.col("date") > F.lit(START + timedelta(days=95)))
        )
    else:
        weather = weather.drop("route_id")
    with_month(weather).write.partitionBy("month").saveAsTable(tables.weather)
    source = spark.table(tables.weather)
    target = tables.gold("summit_window")
    sm.refresh_summit_window(source.filter(F.col("date") <= F.lit(START + timedelta(days=120))), target)
    before = spark.table(target).count()
    sm.refresh_summit_window(source, target)
    full = sm.summit_window(source.drop("month"))
    found = spark.table(target).drop("month").select(full.columns)
    assert found.count() > before
    assert full.exceptAll(found).isEmpty() and found.exceptAll(full).isEmpty()


def test_refresh_takes_added_and_lagging_routes_whole(spark, tables, weather_rows):
    weather = random_weather(weather_rows, [1], 90, 5).unionByName(random_weather(weather_rows, [2], 90, 6)).unionByName(
        random_weather(weather_rows, [3], 90, 7)).unionByName(
        random_weather(weather_rows, [4], 90, 8, density=1.0).filter(F.col("date") < F.lit(START + timedelta(days=10))))
    target = tables.gold("summit_window")
    lagging = (F.col("route_id") == 2) & (F.col("date") >= F.lit(START + timedelta(days=20)))
    sm.refresh_summit_window(weather.filter((F.col("route_id") != 3) & ~lagging), target)
    sm.refresh_summit_window(weather, target)
    full = sm.summit_window(weather)
    found = spark.table(target).drop("month").select(full.columns)
    assert full.exceptAll(found).isEmpty() and found.exceptAll(full).isEmpty()
    last = full.agg(F.max("date")).first()[0]
    stale = sm.routes_to_refresh(weather, spark.table(target), last, 30)
    assert {r.route_id for r in stale.collect()} == {1, 2, 3}  # route 4 ended long ago and holds nothing back


def test_history_starts_no_earlier_than_needed(spark, weather_rows):
    weather = table(weather_rows, days(START, 100))
    kept = sm.history_for_windows(weather, START + timedelta(days=69))
    assert kept.agg(F.min("date")).first()[0] == START + timedelta(days=41)  # 29 gouter days up to the cutoff


@pytest.mark.parametrize("block_days, share", [(1, 1.0), (3, 0.5), (7, 0.2), (40, 0.9), (100_000, 1.0)])
def test_a_series_in_blocks_rolls_as_in_one_window(spark, weather_rows, monkeypatch, block_days, share):
    rng = random.Random(block_days)
    rows = [("gouter", day, {"temperature_max_c": rng.randint(-20, 5), "snow_depth_m": rng.randint(0, 9)})
            for day in days(date(2023, 12, 1), 150) if rng.random() < share]
    pivot = sm.route_pivot(weather_rows(rows))
    plain = sm.rolling_conditions(pivot.withColumn("route_id", F.lit(1))).drop("route_id")
    monkeypatch.setattr(sm.with_halo, "__defaults__", (block_days,))
    blocked = sm.rolling_conditions(pivot)
    assert sorted(map(tuple, blocked.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    copies = sm.with_halo(pivot.filter("has_gouter"), 29, block_days).filter("__halo").groupBy("__block").count()
    assert all(r["count"] <= 29 for r in copies.collect())


def test_history_is_looked_for_near_the_cutoff_first(spark, tables, weather_rows):
    """Dense routes read some months; a sparse one is looked up in all of them, alone."""
    dense = [(1, "gouter", day, {}) for day in days(date(2022, 1, 1), 700)]
    sparse = [(2, "gouter", day, {}) for day in days(date(2022, 1, 1), 700)[::20]]
    weather = with_month(weather_rows(dense + sparse, routes=True))
    weather.write.partitionBy("month").saveAsTable(tables.weather)
    weather = spark.table(tables.weather)
    cutoff = date(2023, 11, 1)
    stale = spark.createDataFrame([(1, cutoff, date(2022, 1, 1)), (2, cutoff, date(2022, 1, 1))], "route_id bigint, cutoff date, first_day date")
    found = {r.route_id: r.first_needed for r in sm._first_needed(weather, stale).collect()}
    gouter = {route: sorted(day for r, _, day, _ in dense + sparse if r == route and day <= cutoff) for route in (1, 2)}
    assert found == {route: own[-29] for route, own in gouter.items()}
    plan = sm._first_needed(weather, stale.filter("route_id = 1"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and ">= 2023-08-01" in plan, plan

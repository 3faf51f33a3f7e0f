import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from helpers import days
from pyspark.sql import functions as F

from alpenglow.config import ACCEPTED_RANGES, MEASURES, WAYPOINT_NAMES
from alpenglow.operators import quality as dq
from alpenglow.operators.profile import (
    day_sketches, drift, drift_distribution, histograms, profile, profile_sketches, roll_up, sketched_metrics, within_bounds,
)

TODAY = date(2024, 2, 1)


def violations(df):
    return {(r.check_name, r.column_name): r.violations for r in df.collect()}


def test_column_checks_count_each_violation(spark):
    df = spark.createDataFrame([("summit", 1), ("nowhere", 7), (None, None), ("nowhere", 99)], "name string, x int")
    assert violations(dq.not_null(df, ["name", "x"])) == {("not_null", "name"): 1, ("not_null", "x"): 1}
    assert violations(dq.accepted_values(df, "name", WAYPOINT_NAMES)) == {("accepted_values", "name"): 2}
    assert violations(dq.accepted_range(df, {"x": (1, 7)})) == {("accepted_range", "x"): 1}


def test_many_checks_take_one_scan(spark, tmp_path):
    spark.range(5).withColumn("x", F.lit(1)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    checks = dq.column_checks(df, *dq.null_checks(["id", "x"]), *dq.range_checks({"id": (0, 3), "x": (0, 3)}))
    assert checks._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert violations(checks)["accepted_range", "id"] == 1


def test_ranges_are_inclusive(weather_rows):
    df = weather_rows([("summit", TODAY, {"cloudcover_pct": 100, "temperature_max_c": -60, "air_density_kgm3": "1.5"})])
    assert set(violations(dq.accepted_range(df, ACCEPTED_RANGES)).values()) == {0}


def test_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c"), (2, "c"), (2, "c")], "k int, v string")
    assert {tuple(r) for r in dq.duplicate_keys(df, ["k", "v"]).collect()} == {(1, "a", 2), (2, "c", 3)}
    assert violations(dq.unique(df, ["k", "v"])) == {("unique", "k,v"): 2}


def test_missing_members(spark):
    expected = spark.createDataFrame([(n,) for n in WAYPOINT_NAMES], "waypoint_name string")
    actual = expected.filter("waypoint_name <> 'vallot'").unionByName(expected.filter("waypoint_name = 'summit'"))
    assert [r[0] for r in dq.missing_members(actual, expected, ["waypoint_name"]).collect()] == ["vallot"]
    assert dq.missing_members(expected, expected, ["waypoint_name"]).isEmpty()


def test_has_rows(spark):
    found = {r.table_name: r.is_populated for r in dq.has_rows({"a": spark.range(3), "b": spark.range(0)}).collect()}
    assert found == {"a": True, "b": False}


@pytest.mark.parametrize("age, status", [(0, "pass"), (14, "pass"), (15, "warn"), (16, "warn"), (17, "fail")])
def test_freshness(spark, age, status):
    df = spark.createDataFrame([(TODAY - timedelta(days=age),), (TODAY - timedelta(days=400),), (None,)], "date date")
    row = dq.freshness(df, TODAY).first()
    assert (row.age_days, row.status) == (age, status)


def test_freshness_of_nothing_fails(spark):
    assert dq.freshness(spark.createDataFrame([], "date date"), TODAY).first().status == "fail"


def test_profile_and_drift(weather_rows):
    dates = days(date(2024, 1, 30), 4)
    df = weather_rows([
        ("summit", d, {"snow_depth_m": v}) for d, v in zip(dates, (1, 3, None, 5), strict=True)
    ])
    rows = {r.window_start: r for r in profile(df, ["snow_depth_m"], "1 month").collect()}
    january, february = rows[date(2024, 1, 1)], rows[date(2024, 2, 1)]
    assert (january.n_rows, january.n_nulls, january.minimum, january.maximum, january["mean"]) == (2, 0, 1.0, 3.0, 2.0)
    assert january.stddev == pytest.approx(2**0.5, abs=1e-4)
    assert (february.n_rows, february.n_nulls, february["mean"], february.stddev) == (2, 1, 5.0, None)
    changes = {r.window_start: r for r in drift(profile(df, ["snow_depth_m"], "1 month")).collect()}
    assert changes[date(2024, 1, 1)].mean_change is None
    assert (changes[date(2024, 2, 1)].mean_change, changes[date(2024, 2, 1)].n_nulls_change) == (3.0, 1)
    assert profile(df, MEASURES, "1 day").count() == 4 * len(MEASURES)
    with pytest.raises(ValueError):
        profile(df, MEASURES, "1 week")


def test_sketches(weather_rows):
    df = weather_rows([("summit", d, {"snow_depth_m": n % 5}) for n, d in enumerate(days(date(2024, 1, 1), 25))])
    row = profile_sketches(df, ["snow_depth_m"], "1 month").first()
    assert row.approx_distinct == 5
    assert row.quartiles == [1.0, 2.0, 3.0]


# --- Gaps, sketches, distributions ------------------------------------------------------------------------------------


def test_gaps(spark, weather_rows):
    present = [date(2024, 1, 3), date(2024, 1, 4), date(2024, 1, 4), date(2024, 1, 8), date(2024, 1, 31), date(2024, 2, 9)]
    weather = weather_rows([("summit", day, {}) for day in present] + [("vallot", day, {}) for day in days(date(2024, 1, 1), 31)])
    expected = spark.createDataFrame([("summit",), ("vallot",), ("gouter",), ("gouter",)], "waypoint_name string")
    found = dq.gaps(weather, expected, ["waypoint_name"], date(2024, 1, 1), date(2024, 1, 31))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("gouter", date(2024, 1, 1), date(2024, 1, 31), 31),
        ("summit", date(2024, 1, 1), date(2024, 1, 2), 2),
        ("summit", date(2024, 1, 5), date(2024, 1, 7), 3),
        ("summit", date(2024, 1, 9), date(2024, 1, 30), 22),
    ]


def numbers(spark, rows):
    return spark.createDataFrame(rows, "date date, x double, y double")


def test_day_sketches_merge_to_months_within_their_bounds(spark):
    rng = random.Random(1)
    rows = [(date(2024, 1 + k % 3, 1 + k % 28), rng.gauss(0, 1), float(k % 9000) if k % 7 else None) for k in range(60_000)]
    df = numbers(spark, rows)
    stored = day_sketches(df, ["x", "y"])
    assert stored.count() == 2 * len({r[0] for r in rows})
    rolled = roll_up(stored, "1 month")
    judged = within_bounds(sketched_metrics(rolled), df, ["x", "y"], "1 month").collect()
    assert len(judged) == 6 and all(r.distinct_ok and r.quartiles_ok for r in judged)
    counts = {(r.window_start, r.column_name): (r.n_rows, r.n_nulls) for r in rolled.collect()}
    assert counts[date(2024, 1, 1), "y"] == (20_000, sum(r[0].month == 1 and r[2] is None for r in rows))


def test_bounds_catch_wrong_metrics(spark):
    df = numbers(spark, [(date(2024, 1, 1), float(k), 1.0) for k in range(1000)])
    good = sketched_metrics(roll_up(day_sketches(df, ["x"]), "1 month"))
    wrong = good.withColumn("quartiles", F.transform("quartiles", lambda q: q + 50))
    assert within_bounds(good, df, ["x"], "1 month").first().quartiles_ok
    assert not within_bounds(wrong, df, ["x"], "1 month").first().quartiles_ok
    fewer = good.withColumn("approx_distinct", F.lit(800).cast("bigint"))
    assert not within_bounds(fewer, df, ["x"], "1 month").first().distinct_ok


def test_sketches_of_nothing_but_nulls(spark):
    df = numbers(spark, [(date(2024, 1, 1), None, 1.0)])
    row = sketched_metrics(roll_up(day_sketches(df, ["x"]), "1 month")).first()
    assert (row.n_rows, row.n_nulls, row.quartiles, row.approx_distinct) == (1, 1, None, 0)


def test_drift_of_distributions(spark):
    schema = "date date, x decimal(10,2)"
    values = {1: [1, 2, 3, 9], 2: [1, 2, 3, 9], 3: [9, 9, 9, 12], 4: [-1, None, 10, 10]}
    df = spark.createDataFrame([(date(2024, m, 1), None if v is None else Decimal(v)) for m, x in values.items() for v in x], schema)
    counts = histograms(df, {"x": (0, 10)}, "1 month", bins=5)
    assert sorted((r.window_start.month, r.bin, r.n) for r in counts.collect()) == [
        (1, 1, 1), (1, 2, 2), (1, 5, 1), (2, 1, 1), (2, 2, 2), (2, 5, 1), (3, 5, 3), (3, 6, 1), (4, 0, 1), (4, 5, 2)]
    found = {r.window_start.month: (r.n, r.psi, r.ks) for r in drift_distribution(counts, bins=5).collect()}
    assert found[1] == (4, None, None) and found[2] == (4, 0.0, 0.0)
    assert found[3][0] == 4 and found[3][2] == 0.75 and found[3][1] > 0.5
    assert found[4][0] == 3 and found[4][2] == 0.3333


def test_histograms_take_each_value_once(spark):
    """Five copies of every column's arithmetic in one generator grew over what is compiled."""
    schema = "date date, x decimal(10,2), y double"
    df = spark.createDataFrame([(date(2024, 1, 1), Decimal("9.99"), -0.5), (date(2024, 1, 2), None, 1.0), (None, Decimal(11), None)], schema)
    counts = histograms(df, {"x": (0, 10), "y": (-1, 1)}, "1 month", bins=4)
    assert sorted((r.column_name, r.window_start is None, r.bin, r.n) for r in counts.collect()) == [
        ("x", False, 4, 1), ("x", True, 5, 1), ("y", False, 2, 1), ("y", False, 4, 1)]
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" * 100") == 2  # once a column

from datetime import date
from pathlib import Path
from urllib.parse import urlparse

import pyarrow.parquet as pq
import pytest
from helpers import days
from pyspark.sql import functions as F

from alpenglow.config import NO_WATERMARK
from alpenglow.operators import tables as tb
from alpenglow.session import conf_scope, shared_folder

KEYS = ["waypoint_name", "date"]
DATES = "date date"


def table_rows(spark, table):
    return {(r.waypoint_name, r.date): float(r.temperature_max_c) for r in spark.table(table).collect()}


def weather(weather_rows, first, count, tmax, waypoint="summit"):
    return weather_rows([(waypoint, d, {"temperature_max_c": tmax}) for d in days(first, count)])


# --- Watermark --------------------------------------------------------------------------------------------------------


def test_watermark_defaults_to_the_sentinel(spark, tables):
    assert tb.read_watermark(spark, tables.watermark, "silver") == NO_WATERMARK
    tb.write_watermark(spark, tables.watermark, "bronze", date(2024, 1, 31))
    assert tb.read_watermark(spark, tables.watermark, "silver") == NO_WATERMARK


def test_watermark_replaces_only_its_layer(spark, tables):
    tb.write_watermark(spark, tables.watermark, "bronze", date(2024, 1, 31))
    tb.write_watermark(spark, tables.watermark, "silver", date(2024, 1, 15))
    tb.write_watermark(spark, tables.watermark, "bronze", date(2024, 2, 29))
    tb.write_watermark(spark, tables.watermark, "silver", None)
    rows = {tuple(r) for r in spark.table(tables.watermark).select("layer", "last_completed_date").collect()}
    assert rows == {("bronze", date(2024, 2, 29)), ("silver", date(2024, 1, 15))}
    assert tb.read_watermark(spark, tables.watermark, "bronze") == date(2024, 2, 29)


def test_a_broken_watermark_table_is_an_error(spark, tables):
    tb.append(spark.range(1), tables.watermark)
    with pytest.raises(Exception, match="last_completed_date|layer"):
        tb.read_watermark(spark, tables.watermark, "bronze")


@pytest.mark.parametrize("values, expected", [
    ([date(2024, 1, 1), date(2024, 3, 15), date(2024, 2, 10)], date(2024, 3, 15)),
    ([date(2024, 6, 1)], date(2024, 6, 1)),
    ([], None),
    ([None, date(2024, 5, 20), None], date(2024, 5, 20)),
])
def test_max_date(spark, values, expected):
    assert tb.max_date(spark.createDataFrame([(v,) for v in values], DATES)) == expected


# --- Appends and upserts ----------------------------------------------------------------------------------------------


def test_append_creates_then_adds(spark, tables):
    tb.append(spark.range(2), tables.raw)
    tb.append(spark.range(3), tables.raw)
    assert spark.table(tables.raw).count() == 5
    tb.append(spark.range(1), tables.raw, mode="overwrite")
    assert spark.table(tables.raw).count() == 1


def test_first_upsert_creates_the_table(spark, tables, weather_rows):
    result = tb.upsert(weather(weather_rows, date(2024, 1, 30), 4, 1), tables.weather, KEYS)
    assert (result.created, result.rows, result.min_date, result.max_date) == (
        True, 4, date(2024, 1, 30), date(2024, 2, 2)
    )
    assert {r.partition for r in spark.sql(f"SHOW PARTITIONS {tables.weather}").collect()} == {
        "month=2024-01-01", "month=2024-02-01"
    }


def test_upsert_updates_and_inserts(spark, tables, weather_rows):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 60, 1), tables.weather, KEYS)
    result = tb.upsert(weather(weather_rows, date(2024, 2, 20), 20, 2), tables.weather, KEYS)
    assert (result.created, result.rows) == (False, 20)
    found = table_rows(spark, tables.weather)
    assert len(found) == 70  # 60 + 20 days, ten of them (20 to 29 February) in both
    assert {v for (_, d), v in found.items() if d < date(2024, 2, 20)} == {1.0}
    assert {v for (_, d), v in found.items() if d >= date(2024, 2, 20)} == {2.0}
    database = tables.weather.split(".")[0]
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["weather"]  # no staging left


def test_upsert_leaves_other_months_alone(spark, tables, weather_rows):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 90, 1), tables.weather, KEYS)
    folder = Path(urlparse(spark.table(tables.weather).inputFiles()[0]).path).parent.parent
    before = {p: p.stat().st_mtime_ns for p in folder.glob("month=*/*.parquet")}
    tb.upsert(weather(weather_rows, date(2024, 2, 10), 1, 2), tables.weather, KEYS)
    after = {p: p.stat().st_mtime_ns for p in folder.glob("month=*/*.parquet")}
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert changed == {"month=2024-02-01"}
    assert all(after[p] == before[p] for p in before.keys() & after.keys())


def test_upsert_with_an_empty_batch_changes_nothing(spark, tables, weather_rows):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 3, 1), tables.weather, KEYS)
    result = tb.upsert(weather(weather_rows, date(2024, 1, 1), 3, 2).filter("false"), tables.weather, KEYS)
    assert (result.rows, result.max_date) == (0, None)
    assert len(table_rows(spark, tables.weather)) == 3


def test_duplicate_keys_are_rejected(spark, tables, weather_rows):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 3, 1), tables.weather, KEYS)
    twice = weather(weather_rows, date(2024, 1, 1), 1, 2).unionByName(weather(weather_rows, date(2024, 1, 1), 1, 3))
    with pytest.raises(tb.DuplicateKeysError):
        tb.upsert(twice, tables.weather, KEYS)
    assert set(table_rows(spark, tables.weather).values()) == {1.0}


def test_duplicate_keys_are_rejected_by_the_first_upsert_too(spark, tables, weather_rows):
    twice = weather(weather_rows, date(2024, 1, 1), 1, 2).unionByName(weather(weather_rows, date(2024, 1, 1), 1, 3))
    with pytest.raises(tb.DuplicateKeysError):
        tb.upsert(twice, tables.weather, KEYS)
    assert not spark.catalog.tableExists(tables.weather)


def test_recovery_touches_only_its_own_staging(spark, tables, weather_rows):
    rows = weather(weather_rows, date(2024, 1, 1), 2, 1)
    for other in ("__archive", "__batch_mine", "__merged_" + "g" * 32):
        rows.write.saveAsTable(tables.weather + other)
    rows.write.saveAsTable(f"{tables.weather}__batch_{'0' * 32}")
    assert tb.recover(spark, tables.weather) == 0
    for other in ("__archive", "__batch_mine", "__merged_" + "g" * 32):
        assert spark.catalog.tableExists(tables.weather + other)
    assert not spark.catalog.tableExists(f"{tables.weather}__batch_{'0' * 32}")


def test_files_are_ordered_by_waypoint(spark, tables, weather_rows):
    names = ("summit", "chamonix", "vallot")
    rows = weather_rows([(w, d, {}) for d in days(date(2024, 1, 1), 40) for w in names])
    tb.upsert(rows, tables.weather, KEYS)
    tb.upsert(rows.filter("date > '2024-01-20'"), tables.weather, KEYS)
    for path in spark.table(tables.weather).inputFiles():
        read = pq.ParquetFile(urlparse(path).path).read(columns=["waypoint_name", "date"]).to_pylist()
        found = [(r["waypoint_name"], r["date"]) for r in read]
        assert found == sorted(found)


def test_rows_without_a_date_match_nothing_and_are_kept(spark, tables, weather_rows):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 2, 1), tables.weather, KEYS)
    for tmax in (2, 3):
        undated = weather_rows([("summit", None, {"temperature_max_c": tmax})] * 2)
        tb.upsert(undated.unionByName(weather(weather_rows, date(2024, 1, 2), 1, tmax)), tables.weather, KEYS)
    found = sorted((str(r.date), float(r.temperature_max_c)) for r in spark.table(tables.weather).collect())
    assert found == [("2024-01-01", 1.0), ("2024-01-02", 3.0), ("None", 2.0), ("None", 2.0), ("None", 3.0), ("None", 3.0)]


def test_an_interrupted_upsert_is_replayed(spark, tables, weather_rows, monkeypatch):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 40, 1), tables.weather, KEYS)

    def crash(df, table, keys):
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (month = DATE '2024-02-01')")  # half replaced
        raise RuntimeError("executor gone")

    with monkeypatch.context() as patched:
        patched.setattr(tb, "replace_partitions", crash)
        with pytest.raises(RuntimeError):
            tb.upsert(weather(weather_rows, date(2024, 1, 31), 3, 2), tables.weather, KEYS)
    assert tb.recover(spark, tables.weather) == 1
    found = table_rows(spark, tables.weather)
    assert len(found) == 40
    assert [found["summit", d] for d in days(date(2024, 1, 30), 5)] == [1.0, 2.0, 2.0, 2.0, 1.0]
    assert tb.recover(spark, tables.weather) == 0


def test_captured_changes_survive_an_interruption(spark, tables, weather_rows, monkeypatch):
    def run(first, count, tmax):
        tb.upsert(weather(weather_rows, first, count, tmax), tables.weather, KEYS, capture_changes=True)

    run(date(2024, 1, 1), 3, 1)
    assert not spark.catalog.tableExists(f"{tables.weather}_changes")
    run(date(2024, 1, 3), 2, 2)
    apply = tb.replace_partitions
    with monkeypatch.context() as patched:
        patched.setattr(tb, "replace_partitions", lambda *args: (_ for _ in ()).throw(RuntimeError("gone")))
        with pytest.raises(RuntimeError):
            run(date(2024, 1, 4), 1, 3)
    assert tb.replace_partitions is apply
    run(date(2024, 1, 5), 1, 4)
    feed = spark.table(f"{tables.weather}_changes")
    found = sorted((r.date.day, r._change_type, float(r.temperature_max_c)) for r in feed.collect())
    assert found == [
        (3, "update_postimage", 2.0), (3, "update_preimage", 1.0), (4, "insert", 2.0),
        (4, "update_postimage", 3.0), (4, "update_preimage", 2.0), (5, "insert", 4.0),
    ]
    assert feed.select(tb.COMMIT).distinct().count() == 3


def test_partition_mode_is_put_back(spark, tables, weather_rows):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 3, 1), tables.weather, KEYS)
    tb.upsert(weather(weather_rows, date(2024, 1, 2), 3, 2), tables.weather, KEYS)
    assert spark.conf.get(name) == before
    with pytest.raises(KeyError), conf_scope(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        raise KeyError
    assert spark.conf.get(name) == before


def test_shared_folder_is_below_the_cluster_setting(spark):
    first, second = shared_folder(spark), shared_folder(spark)
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


# --- Incremental reads ------------------------------------------------------------------------------------------------


def test_since_prunes_months(spark, tables, weather_rows):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 90, 1), tables.weather, KEYS)
    table = spark.table(tables.weather)
    recent = tb.since(table, date(2024, 3, 10))
    assert recent.count() == 20
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert tb.since(table, None).count() == 90
    assert tb.since(table, date(2024, 3, 10), inclusive=True).count() == 21
    assert tb.table_max_date(spark, tables.weather) == date(2024, 3, 30)


def test_refresh_takes_new_dates_only(spark, tables, weather_rows):
    target = tables.gold("copy")
    tb.refresh_new_dates(weather(weather_rows, date(2024, 1, 1), 10, 1), target, KEYS, lambda df: df)
    tb.refresh_new_dates(weather(weather_rows, date(2024, 1, 5), 10, 2), target, KEYS, lambda df: df)
    found = table_rows(spark, target)
    assert len(found) == 14
    assert found["summit", date(2024, 1, 10)] == 1.0 and found["summit", date(2024, 1, 11)] == 2.0


def test_refresh_follows_each_route(spark, tables, weather_rows):
    def route(number, first, count, tmax):
        return weather(weather_rows, first, count, tmax).withColumn("route_id", F.lit(number).cast("bigint"))

    target = tables.gold("copy")
    keys = ["route_id", *KEYS]
    first = route(1, date(2024, 1, 1), 40, 1).unionByName(route(2, date(2024, 1, 1), 5, 1))
    tb.refresh_new_dates(first, target, keys, lambda df: df)
    # Route 1 has two more days, route 2 caught up, route 3 is new; days already there keep their values.
    second = route(1, date(2024, 1, 1), 42, 2).unionByName(route(2, date(2024, 1, 1), 42, 2)).unionByName(
        route(3, date(2023, 12, 1), 42, 2))
    tb.refresh_new_dates(second, target, keys, lambda df: df)
    found = spark.table(target).groupBy("route_id").agg(
        F.count("*").alias("n"), F.sum((F.col("temperature_max_c") == 1).cast("int")).alias("old")).collect()
    assert {r.route_id: (r.n, r.old) for r in found} == {1: (42, 40), 2: (42, 5), 3: (42, 0)}
    tb.refresh_new_dates(second, target, keys, lambda df: df)
    assert spark.table(target).count() == 126


def test_refresh_of_an_empty_target_is_a_full_run(spark, tables, weather_rows):
    target = tables.gold("copy")
    tb.refresh_new_dates(weather(weather_rows, date(2024, 1, 1), 1, 1).filter("false"), target, KEYS, lambda df: df)
    assert spark.table(target).count() == 0
    tb.refresh_new_dates(weather(weather_rows, date(2024, 1, 1), 5, 1), target, KEYS, lambda df: df)
    assert spark.table(target).count() == 5


# --- Change feed ------------------------------------------------------------------------------------------------------


def test_change_feed(spark):
    schema = "k int, a string, b int"
    before = spark.createDataFrame([(1, "same", None), (2, "old", 1), (3, "gone", 1), (4, None, None)], schema)
    after = spark.createDataFrame([(1, "same", None), (2, "new", 1), (4, None, 7), (5, None, None)], schema)
    found = {tuple(r) for r in tb.change_feed(before, after, ["k"]).collect()}
    assert found == {
        (2, "old", 1, "update_preimage"), (2, "new", 1, "update_postimage"),
        (3, "gone", 1, "delete"),
        (4, None, None, "update_preimage"), (4, None, 7, "update_postimage"),
        (5, None, None, "insert"),
    }


def test_a_new_table_is_written_once(spark, tables, weather_rows, monkeypatch):
    written = []
    append = tb.append
    monkeypatch.setattr(tb, "append", lambda df, table, *more, **how: (written.append(table), append(df, table, *more, **how)))
    seen = tb.upsert(weather(weather_rows, date(2024, 1, 1), 40, 1), tables.weather, KEYS)
    assert (seen.created, seen.rows, seen.min_date, seen.max_date) == (True, 40, date(2024, 1, 1), date(2024, 2, 9))
    assert len(table_rows(spark, tables.weather)) == 40
    assert [x for x in written if "__creating_" not in x] == [tables.weather]


def test_a_new_table_that_is_not_checked_does_not_count(spark, tables, weather_rows, monkeypatch):
    rows = weather(weather_rows, date(2024, 1, 1), 2, 1)
    with pytest.raises(tb.DuplicateKeysError):
        tb.upsert(rows.unionByName(rows), tables.weather, KEYS)
    assert not spark.catalog.listTables(tables.names.database("silver"))
    tb.write_by_month(tb.with_month(rows.unionByName(rows)), tables.weather, KEYS)  # a crash before the check
    tb.append(spark.range(0), f"{tables.weather}__creating_{'0' * 32}")
    assert tb.upsert(rows, tables.weather, KEYS).created
    assert spark.table(tables.weather).count() == 2
    assert [t.name for t in spark.catalog.listTables(tables.names.database("silver"))] == ["weather"]


def test_a_captured_upsert_joins_the_target_once(spark, tables, weather_rows, monkeypatch):
    tb.upsert(weather(weather_rows, date(2024, 1, 1), 3, 1), tables.weather, KEYS, capture_changes=True)
    plans, append = [], tb.append

    def watched(df, table, *more, **how):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        append(df, table, *more, **how)

    monkeypatch.setattr(tb, "append", watched)
    tb.upsert(weather(weather_rows, date(2024, 1, 2), 3, 2), tables.weather, KEYS, capture_changes=True)
    joins = [p for p in plans if "LeftOuter" in p or "LeftAnti" in p or "LeftSemi" in p]
    assert len(joins) == 1
    found = sorted((r.date.day, r._change_type, float(r.temperature_max_c)) for r in spark.table(f"{tables.weather}_changes").collect())
    assert found == [(2, "update_postimage", 2.0), (2, "update_preimage", 1.0), (3, "update_postimage", 2.0),
                     (3, "update_preimage", 1.0), (4, "insert", 2.0)]

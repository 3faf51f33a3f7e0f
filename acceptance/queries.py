"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import fixture as fx
from acceptance import mapping as m
from alpenglow import config as c
from alpenglow.operators import profile as prof
from alpenglow.operators import quality as dq
from alpenglow.operators import tables as tb
from alpenglow.operators.flatten import explode_payloads, latest_fetch, quarantine, transform_silver
from alpenglow.plans import conditions as cond
from alpenglow.plans import medallion as md
from alpenglow.plans import summit as sm
from alpenglow.plans.gradient import elevation_gradient
from alpenglow.plans.upkeep import follow_changes
from alpenglow.schemas import FETCHED, PAYLOAD
from alpenglow.session import shared_folder
from alpenglow.sources.archive import FileTransport, fetch_payloads
from alpenglow.sources.datasource import read_archive
from alpenglow.sources.files import scan_file
from alpenglow.sources.planner import missing_ranges, month_slices, request_manifest, spread, with_load_range
from alpenglow.streaming.silver import stream_silver

KEYS = ["route_id", "waypoint_name", "date"]
CUTOFF, OVERLAP, REVISED = (date.fromisoformat(x) for x in (m.CUTOFF, m.OVERLAP_FROM, m.REVISED_FROM))
RECORD = c.LoadSettings(start=date(1995, 1, 1), fixed_end=date(2001, 11, 30), requests_per_task=4000)


def new_tables(spark: SparkSession) -> tuple[md.Tables, str]:
    """A fresh environment: its own databases below a fresh folder of the shared working folder."""
    names = c.TableNames(f"run_{uuid.uuid4().hex[:12]}")
    folder = shared_folder(spark)
    tb.create_databases(spark, names, folder)
    return md.Tables(names), folder


def shifted_from(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """The weather table as re-delivered: one degree warmer from `day` on."""
    return fx.weather(spark, sf_dir, f"CASE WHEN d >= DATE '{day}' THEN {m.ONE_DEGREE} ELSE 0 END")


# --- Planning and landing ---------------------------------------------------------------------------------------------


def load_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes whose record starts on the first day count as never loaded, the others got some way into it."""
    first, steps = F.min("d"), F.expr("CAST(SUM(k) % 2500 AS INT)")
    marks = fx.cells(spark, sf_dir).groupBy("route_id").agg(first.alias("first"), steps.alias("steps"))
    mark = F.when(F.col("first") > F.lit("1995-01-02").cast("date"), F.date_add("first", F.col("steps")))
    settings = c.LoadSettings(start=date(1995, 1, 1), fixed_end=None, today=date.fromisoformat(m.TODAY))
    return with_load_range(marks, mark, settings).select("route_id", "load_start", "load_end")


def plan_month_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return month_slices(load_range(spark, sf_dir))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_manifest(fx.waypoints(spark, sf_dir).join(load_range(spark, sf_dir), "route_id"))


def stored_archive(spark: SparkSession, sf_dir: str, folder: str) -> FileTransport:
    """Keep the record's payloads where FileTransport finds them: one directory per route, a route's rows possibly in many
    files."""
    slices = month_slices(spread(with_load_range(fx.waypoints(spark, sf_dir), c.NO_WATERMARK, RECORD)))
    stored = fx.archive_slices(fx.clean_raw(spark, sf_dir), slices)
    stored.hint("rebalance", "route_id").write.partitionBy("route_id").parquet(f"{folder}/archive")
    return FileTransport(f"{folder}/archive", by="route_id")


def with_day_count(raw: DataFrame) -> DataFrame:
    days = F.size(F.from_json("response_json", PAYLOAD)["daily"]["time"]).cast("bigint")
    return raw.withColumn("n_days", days)


def _record_manifest(spark: SparkSession, sf_dir: str, settings: c.LoadSettings = RECORD) -> DataFrame:
    return request_manifest(with_load_range(fx.waypoints(spark, sf_dir), c.NO_WATERMARK, settings))


def _payload_counts(rows: DataFrame) -> DataFrame:
    return with_day_count(rows).groupBy("route_id", "waypoint_name", "elevation").agg(
        F.count(F.lit(1)).alias("n_payloads"), F.sum("n_days").alias("n_days")
    )


def archive_source_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    transport = stored_archive(spark, sf_dir, shared_folder(spark))
    return _payload_counts(fetch_payloads(_record_manifest(spark, sf_dir), transport, RECORD.requests_per_task))


def _archive_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    transport = stored_archive(spark, sf_dir, folder)
    return read_archive(spark, _record_manifest(spark, sf_dir), transport, f"{folder}/manifest", RECORD.requests_per_task)


def archive_datasource(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive as a table that a query reads."""
    return _payload_counts(_archive_table(spark, sf_dir))


def archive_datasource_pushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source asks only for what the filter wants."""
    wanted = F.col("waypoint_name").isin(c.GOUTER, c.SUMMIT) & (F.col("period_start") >= F.lit(m.PUSHED_FROM).cast("date"))
    return _payload_counts(_archive_table(spark, sf_dir).filter(wanted))


def archive_mid_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range that begins and ends inside a month: the stored months are clipped to it."""
    transport = stored_archive(spark, sf_dir, shared_folder(spark))
    settings = replace(RECORD, start=date.fromisoformat(m.MID_FROM), fixed_end=date.fromisoformat(m.MID_TO))
    rows = fetch_payloads(_record_manifest(spark, sf_dir, settings), transport, RECORD.requests_per_task)
    return explode_payloads(rows).groupBy("route_id", "waypoint_name").agg(
        F.count(F.lit(1)).alias("n_days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def missing_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to ask for beside the slices that are there."""
    wanted = fx.waypoints(spark, sf_dir).withColumns({
        "load_start": F.lit(m.WANTED_FROM).cast("date"), "load_end": F.lit(m.WANTED_TO).cast("date")})
    return request_manifest(missing_ranges(wanted, fx.held_slices(spark, sf_dir))).select(
        "route_id", "waypoint_name", "period_start", "period_end", "start_date", "end_date")


def slice_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that commits month by month: the raw rows, and how far the watermark went."""
    tables, folder = new_tables(spark)
    transport = stored_archive(spark, sf_dir, folder)
    settings = replace(RECORD, start=date(1996, 1, 10), fixed_end=date(1996, 4, 20), commit="slice")
    md.load_bronze(spark, tables, fx.waypoints(spark, sf_dir), transport, settings)
    mark = tb.read_watermark(spark, tables.watermark, "bronze")
    return _slices(spark.table(tables.raw)).withColumn("watermark", F.lit(mark))


def appended_raw(spark: SparkSession, sf_dir: str) -> md.Tables:
    tables, _ = new_tables(spark)
    raw = fx.clean_raw(spark, sf_dir)
    md.append_raw(raw.filter(F.col("period_end") <= F.lit(CUTOFF)), tables.raw)
    md.append_raw(raw.filter(F.col("period_end") > F.lit(CUTOFF)), tables.raw)
    return tables


def _slices(raw: DataFrame) -> DataFrame:
    return with_day_count(raw).select("route_id", "waypoint_name", "period_start", "period_end", "n_days")


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slices(spark.table(appended_raw(spark, sf_dir).raw))


def incremental_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = appended_raw(spark, sf_dir)
    tb.write_watermark(spark, tables.watermark, "silver", CUTOFF)
    return _slices(md.read_new_raw(spark, tables))


def watermark_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = new_tables(spark)
    days = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.to_date("l_shipdate").alias("date"))
    last = tb.max_date(days)
    first = days.agg(F.min("date")).first()[0]
    for layer, day in (("bronze", first), ("silver", first), ("bronze", last), ("gold", None)):
        tb.write_watermark(spark, tables.watermark, layer, day)
    absent = spark.range(1).select(
        F.lit("gold").alias("layer"),
        F.lit(tb.read_watermark(spark, tables.watermark, "gold")).alias("last_completed_date"),
    )
    return spark.table(tables.watermark).select("layer", "last_completed_date").unionByName(absent)


# --- Silver -----------------------------------------------------------------------------------------------------------


def silver_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform_silver(fx.raw(spark, sf_dir))


def silver_dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = fx.weather(spark, sf_dir).withColumn("period_end", F.last_day("date"))
    again = fx.weather(spark, sf_dir, m.ONE_DEGREE).filter(F.month("date") == 3)
    again = again.withColumn("period_end", F.last_day(F.add_months("date", 1)))
    return latest_fetch(first.unionByName(again))


def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(fx.raw(spark, sf_dir)).select(
        "route_id", "waypoint_name", "period_start", "reason", "missing_variables"
    )


def base_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.weather(spark, sf_dir).filter(F.col("date") <= F.lit(CUTOFF))


def upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = new_tables(spark)
    tb.upsert(base_weather(spark, sf_dir), tables.weather, KEYS)
    batch = fx.weather(spark, sf_dir, m.ONE_DEGREE).filter(F.col("date") >= F.lit(OVERLAP))
    tb.upsert(batch, tables.weather, KEYS)
    return spark.table(tables.weather).drop(tb.MONTH)


def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, _ = new_tables(spark)
    tb.upsert(fx.weather(spark, sf_dir), tables.weather, KEYS)
    return spark.table(tables.weather).drop(tb.MONTH)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    after = upserted(spark, sf_dir).filter(F.col("date") != F.lit(OVERLAP))
    return tb.change_feed(base_weather(spark, sf_dir), after, KEYS)


def captured_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two upserts left in the change table of the weather table."""
    tables, _ = new_tables(spark)
    tb.upsert(base_weather(spark, sf_dir), tables.weather, KEYS, capture_changes=True)
    batch = fx.weather(spark, sf_dir, m.ONE_DEGREE).filter(F.col("date") >= F.lit(OVERLAP))
    tb.upsert(batch, tables.weather, KEYS, capture_changes=True)
    return spark.table(f"{tables.weather}_changes").drop(tb.COMMIT)


def changed_weather(spark: SparkSession, sf_dir: str, between: Callable[[md.Tables], None] = lambda tables: None) -> md.Tables:
    """A weather table with three captured versions: a first part; new and revised days; older months that come again,
    and rows that go. `between` is called after the first."""
    tables, _ = new_tables(spark)
    warm = fx.weather(spark, sf_dir, m.ONE_DEGREE)
    gone = F.expr(m.GONE.replace("w =", f"{m.WAYPOINT} =").replace("(d)", "(date)"))
    tb.upsert(base_weather(spark, sf_dir), tables.weather, KEYS, capture_changes=True)
    between(tables)
    tb.upsert(warm.filter(F.col("date") >= F.lit(OVERLAP)), tables.weather, KEYS, capture_changes=True)
    again = warm.filter((F.month("date") == 3) & (F.col("date") < F.lit(OVERLAP)) & ~gone)
    tb.upsert(again, tables.weather, KEYS, capture_changes=True, gone=warm.filter(gone).select(*KEYS))
    return tables


def weather_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table at each of its versions, from its rows and its changes."""
    table = changed_weather(spark, sf_dir).weather
    states = [tb.as_of(spark, table, KEYS, at).withColumn("version", F.lit(at)) for at in range(3)]
    return states[0].unionByName(states[1]).unionByName(states[2])


def weather_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.validity(spark, changed_weather(spark, sf_dir).weather, KEYS)


def _diverted(spark: SparkSession, sf_dir: str) -> md.Tables:
    tables, _ = new_tables(spark)
    md.append_raw(fx.damaged_raw(spark, sf_dir), tables.raw)
    md.load_silver(spark, tables, divert=True)
    return tables


def load_rejected_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load puts aside of damaged payloads."""
    return spark.table(_diverted(spark, sf_dir).rejected).select(
        "route_id", "waypoint_name", "period_start", "position", "reason", "missing_variables", "time")


def load_good_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the same load keeps."""
    return spark.table(_diverted(spark, sf_dir).weather).drop(tb.MONTH, FETCHED)


def late_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older slices fetched again after silver had passed them, taken in by ingestion day."""
    tables, _ = new_tables(spark)
    raw = fx.clean_raw(spark, sf_dir)
    md.append_raw(raw.filter(F.col("period_end") <= F.lit(CUTOFF)), tables.raw)
    md.load_silver(spark, tables, late_periods=True)
    again = fx.payload_slices(fx.cells(spark, sf_dir).filter(F.col("d") >= F.lit(OVERLAP)), m.ONE_DEGREE)
    later = F.lit("2002-01-31").cast("timestamp")
    md.append_raw(fx.raw_rows(again).withColumn("ingestion_timestamp", later), tables.raw)
    md.load_silver(spark, tables, late_periods=True)
    return spark.table(tables.weather).drop(tb.MONTH, FETCHED)


# --- Gold -------------------------------------------------------------------------------------------------------------


def daily_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"daily_conditions_{uuid.uuid4().hex[:12]}"
    cond.publish_view(cond.daily_conditions(fx.weather(spark, sf_dir)), name)
    return spark.table(name)


def gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elevation_gradient(fx.weather(spark, sf_dir))


def gradient_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive for days already done (here vallot's fifths) stay out, as the date rule has it."""
    tables, _ = new_tables(spark)
    target = tables.gold("elevation_gradient")
    late = (F.col("waypoint_name") == c.VALLOT) & (F.day("date") == 5)
    tb.refresh_new_dates(base_weather(spark, sf_dir).filter(~late), target, KEYS, elevation_gradient)
    tb.refresh_new_dates(fx.weather(spark, sf_dir), target, KEYS, elevation_gradient)
    return spark.table(target).drop(tb.MONTH)


def _weather_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather table, whose cells come in no order, with a route's waypoints of a day together."""
    return tb.gathered(fx.weather(spark, sf_dir), ["route_id", "date"])


def role_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    pivot = sm.route_pivot(_weather_by_day(spark, sf_dir))
    present = " AND ".join(f"has_{role}" for role in sm.ROLE_MEASURES)
    return pivot.filter(present).select("route_id", "date", *sm.RAW_COLUMNS)


def route_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.route_pivot(_weather_by_day(spark, sf_dir)).select(
        "route_id", "date", "route_snow_depth", "route_sunshine", "route_precipitation", "route_snowfall"
    )


def rolling_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.rolling_conditions(sm.route_pivot(_weather_by_day(spark, sf_dir))).select(
        "route_id", "date", "gouter_3d_temp_mean", "gouter_30d_temp_max", "route_3d_snowfall",
        "route_30d_snow_depth", "route_7d_snow_depth_change",
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = sm.complete_days(sm.rolling_conditions(sm.route_pivot(_weather_by_day(spark, sf_dir))))
    return sm.with_sub_scores(days)


def _as_ints(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.select("route_id", "date", *[F.col(n).cast("int").alias(n) for n in names])


def summit_subscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_ints(_scored(spark, sf_dir), sm.SUB_SCORES)


def summit_category_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("wind_score", "temperature_score", "grand_couloir_score", "avalanche_score", "overall_score")
    return _as_ints(sm.with_category_scores(_scored(spark, sf_dir)), names)


def summit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.with_flags(sm.with_category_scores(_scored(spark, sf_dir))).select("route_id", "date", *sm.FLAGS)


def summit_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.summit_window(_weather_by_day(spark, sf_dir))


def summit_window_single_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.summit_window(fx.weather_single_route(spark, sf_dir))


def summit_window_null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.summit_window(fx.blanked_weather(spark, sf_dir))


def summit_window_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run up to the cutoff, then a run on a table whose later days were revised: the last thirty days of the
    target are recomputed, older ones keep their first values."""
    tables, _ = new_tables(spark)
    target = tables.gold("summit_window")
    sm.refresh_summit_window(tb.with_month(base_weather(spark, sf_dir)), target)
    sm.refresh_summit_window(tb.with_month(shifted_from(spark, sf_dir, m.REVISED_FROM)), target)
    return spark.table(target).drop(tb.MONTH)


def monthly_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = tb.with_month(fx.weather(spark, sf_dir))
    return cond.monthly_conditions(tb.gathered(weather, ["route_id", "waypoint_name", tb.MONTH]))


def seasonal_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = fx.weather(spark, sf_dir)
    return cond.seasonal_summary(weather, sm.summit_window(weather))


def seasonal_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads; the second renews the month states it touches and merges the calendar months they fall into."""
    tables, _ = new_tables(spark)
    summit, states, seasonal = (tables.gold(x) for x in ("summit_window", "seasonal_states", "seasonal_summary"))
    months = None
    for rows in (base_weather(spark, sf_dir), fx.weather(spark, sf_dir).filter(F.col("date") > F.lit(CUTOFF))):
        tb.upsert(rows, tables.weather, KEYS)
        weather = spark.table(tables.weather)
        renewed = sm.refresh_summit_window(weather, summit)
        if months is not None:
            months = [x for x in tb.table_months(spark, tables.weather) if x >= renewed.min_date.replace(day=1)]
        cond.refresh_seasonal(weather, spark.table(summit), states, seasonal, months)
        months = []
    return spark.table(seasonal)


def rolling_single_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One long series, rolled in blocks of days."""
    return sm.rolling_conditions(sm.route_pivot(fx.weather_single_route(spark, sf_dir))).select(
        "date", "gouter_3d_temp_mean", "gouter_30d_temp_max", "route_3d_snowfall", "route_30d_snow_depth",
        "route_7d_snow_depth_change",
    )


def followed(models: tuple[str, ...], table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A model kept up from the weather table's changes, after new days, late slices and deletions."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = changed_weather(spark, sf_dir, lambda tables: follow_changes(spark, tables, models))
        follow_changes(spark, tables, models)
        rows = spark.table(tables.gold(table))
        return rows if table in ("monthly_conditions", "seasonal_summary") else rows.drop(tb.MONTH)

    return query


# --- Quality and profiles ---------------------------------------------------------------------------------------------


def suspect_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table with values outside the accepted ranges and names outside the list."""
    day = F.day("date")
    return fx.weather(spark, sf_dir).withColumns({
        "snow_depth_m": (F.col("snow_depth_m") * 10).cast("decimal(10,2)"),
        "pressure_hpa": (F.col("pressure_hpa") - 80).cast("decimal(10,2)"),
        "waypoint_name": F.when(day == 1, F.lit(None)).when(day == 2, F.lit("base_camp")).otherwise(
            F.col("waypoint_name")
        ),
    })


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.not_null(fx.blanked_weather(spark, sf_dir), c.NOT_NULL["weather"])


def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.accepted_values(suspect_weather(spark, sf_dir), "waypoint_name", c.WAYPOINT_NAMES)


def dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.accepted_range(suspect_weather(spark, sf_dir), c.ACCEPTED_RANGES)


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = fx.weather(spark, sf_dir, m.ONE_DEGREE).filter(F.month("date") == 3)
    return dq.duplicate_keys(fx.weather(spark, sf_dir).unionByName(again), KEYS)


def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waypoint months without a single day, out of every slice of the record."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(
        F.to_date(F.min("l_shipdate")).alias("first"), F.to_date(F.max("l_shipdate")).alias("last")
    ).first()
    record = c.LoadSettings(start=lines["first"], fixed_end=lines["last"])
    slices = month_slices(spread(with_load_range(fx.waypoints(spark, sf_dir), c.NO_WATERMARK, record)))
    expected = slices.withColumn("month", F.trunc("period_start", "MM"))
    return dq.missing_members(
        tb.with_month(fx.weather(spark, sf_dir)), expected, ["route_id", "waypoint_name", "month"]
    )


def dq_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of days without a row, of every waypoint."""
    first, last = date(1995, 1, 1), date(2001, 11, 30)
    return dq.gaps(fx.weather(spark, sf_dir), fx.waypoints(spark, sf_dir), ["route_id", "waypoint_name"], first, last)


def dq_populated(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = fx.weather(spark, sf_dir)
    return dq.has_rows({
        "weather": weather,
        "elevation_gradient": elevation_gradient(weather),
        "nothing_yet": weather.filter(F.col("date") > F.lit("2100-01-01").cast("date")),
    })


def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = date.fromisoformat(m.FRESHNESS_TODAY)
    return dq.freshness(fx.weather(spark, sf_dir), today, by=["route_id", "waypoint_name"])


def profile_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.profile(fx.weather(spark, sf_dir), c.MEASURES, "1 day")


def profile_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.profile(fx.blanked_weather(spark, sf_dir), c.MEASURES, "1 month")


def profile_monthly_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.profile_sketches(fx.weather(spark, sf_dir), c.MEASURES, "1 month")


def profile_rollup_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored by day, merged to months, and judged by all rows."""
    tables, _ = new_tables(spark)
    weather, stored = fx.weather(spark, sf_dir), tables.names.table("meta", "weather_sketches")
    tb.write_by_month(tb.with_month(prof.day_sketches(weather, c.MEASURES), "window_start"), stored, [])
    metrics = prof.sketched_metrics(prof.roll_up(spark.table(stored), "1 month"))
    return prof.within_bounds(metrics, weather, c.MEASURES, "1 month")


def drift_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each month's distribution is from the one before it."""
    ranges = {name: ends for name, ends in c.ACCEPTED_RANGES.items() if name != "elevation"}
    return prof.drift_distribution(prof.histograms(fx.weather(spark, sf_dir), ranges, "1 month"))


def drift_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prof.drift(profile_monthly(spark, sf_dir))


# --- Streaming, end to end, files -------------------------------------------------------------------------------------


def stream_silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First fetches land and are streamed, then the refetches land and the stream resumes from its checkpoint."""
    tables, folder = new_tables(spark)
    landing, checkpoint = f"{folder}/landing", f"{folder}/progress"
    schema = fx.faulty_raw(spark, sf_dir).schema
    for delivered in (fx.faulty_raw(spark, sf_dir), fx.refetched_raw(spark, sf_dir)):
        delivered.write.mode("append").parquet(landing)
        stream_silver(spark, landing, schema, tables, checkpoint).awaitTermination()
    return spark.table(tables.weather).drop(tb.MONTH, FETCHED)


LINES_PER_PIECE = 3_000_000


def streamed_in(files_per_batch: int) -> Callable[[SparkSession, str], DataFrame]:
    """The refetches land before the fetches they replace, in several files, so many of one micro-batch each. What is a
    file on small tables is as many pieces of it, in the same micro-batch, as the line items call for."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables, folder = new_tables(spark)
        lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
        pieces = max(1, -(-lines // LINES_PER_PIECE))
        for delivered, files in ((fx.refetched_raw(spark, sf_dir), 1), (fx.faulty_raw(spark, sf_dir), 2)):
            dealt = delivered.repartition(files * pieces, "route_id", "waypoint_name", "period_start")
            dealt.write.mode("append").parquet(f"{folder}/landing")
        schema = fx.faulty_raw(spark, sf_dir).schema
        stream_silver(
            spark, f"{folder}/landing", schema, tables, f"{folder}/progress", files_per_batch * pieces).awaitTermination()
        return spark.table(tables.weather).drop(tb.MONTH, FETCHED)

    return query


def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: the record up to the cutoff, then the rest incrementally."""
    tables, folder = new_tables(spark)
    transport = stored_archive(spark, sf_dir, folder)
    places = fx.waypoints(spark, sf_dir)
    for end in (CUTOFF, RECORD.fixed_end):
        settings = replace(RECORD, fixed_end=end, today=date.fromisoformat(m.FRESHNESS_TODAY))
        md.run_load(spark, tables, places, transport, settings, check_freshness=end != CUTOFF)
    return spark.table(tables.gold("summit_window")).drop(tb.MONTH)


def file_scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/weather.csv"
    fx.weather(spark, sf_dir).write.csv(path, header=True)
    return scan_file(spark, path)


def file_scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/weather.json"
    weather = fx.weather(spark, sf_dir)
    # Compressed files cannot be split, so none is large.
    weather.write.option("maxRecordsPerFile", 500_000).json(path, compression="gzip")
    return scan_file(spark, path, weather.schema)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "load_range": load_range,
        "plan_month_slices": plan_month_slices,
        "request_manifest": manifest,
        "archive_source_payloads": archive_source_payloads,
        "archive_datasource": archive_datasource,
        "archive_datasource_pushed": archive_datasource_pushed,
        "archive_mid_month": archive_mid_month,
        "missing_requests": missing_requests,
        "slice_commits": slice_commits,
        "bronze_append": bronze_append,
        "incremental_scan": incremental_scan,
        "watermark_roundtrip": watermark_roundtrip,
        "silver_transform": silver_transform,
        "silver_dedup_latest": silver_dedup_latest,
        "json_quarantine": json_quarantine,
        "silver_upsert": upserted,
        "create_if_absent": create_if_absent,
        "change_feed": change_feed,
        "captured_changes": captured_changes,
        "weather_as_of": weather_as_of,
        "weather_validity": weather_validity,
        "load_rejected_days": load_rejected_days,
        "load_good_days": load_good_days,
        "late_periods": late_periods,
        "daily_conditions": daily_conditions,
        "elevation_gradient": gradient,
        "elevation_gradient_incremental": gradient_incremental,
        "role_pivot": role_pivot,
        "route_averages": route_averages,
        "rolling_conditions": rolling_conditions,
        "summit_subscores": summit_subscores,
        "summit_category_scores": summit_category_scores,
        "summit_flags": summit_flags,
        "summit_window": summit_window,
        "summit_window_single_route": summit_window_single_route,
        "summit_window_null_rules": summit_window_null_rules,
        "summit_window_incremental": summit_window_incremental,
        "monthly_conditions": monthly_conditions,
        "seasonal_summary": seasonal_summary,
        "seasonal_incremental": seasonal_incremental,
        "rolling_single_route": rolling_single_route,
        "followed_monthly": followed(("monthly",), "monthly_conditions"),
        "followed_gradient": followed(("gradient",), "elevation_gradient"),
        "followed_summit": followed(("summit",), "summit_window"),
        "followed_seasonal": followed(("summit", "seasonal"), "seasonal_summary"),
        "dq_not_null": dq_not_null,
        "dq_accepted_values": dq_accepted_values,
        "dq_accepted_range": dq_accepted_range,
        "dq_unique": dq_unique,
        "dq_completeness": dq_completeness,
        "dq_gaps": dq_gaps,
        "dq_populated": dq_populated,
        "freshness": freshness,
        "profile_daily": profile_daily,
        "profile_monthly": profile_monthly,
        "profile_monthly_sketches": profile_monthly_sketches,
        "profile_rollup_bounds": profile_rollup_bounds,
        "drift_monthly": drift_monthly,
        "drift_distribution": drift_distribution,
        "stream_silver_upsert": stream_silver_upsert,
        "stream_small_batches": streamed_in(1),
        "stream_one_batch": streamed_in(50),
        "medallion_end_to_end": medallion_end_to_end,
        "file_scan_csv": file_scan_csv,
        "file_scan_json": file_scan_json,
    }

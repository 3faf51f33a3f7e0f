"""The load from archive to published models: raw rows, weather table, models, checks, freshness, in that order.

Each stage writes its table first and moves its watermark last, so a stage that dies is simply run again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from alpenglow.config import (
    ACCEPTED_RANGES, NOT_NULL, WAYPOINT_NAMES, LoadSettings, TableNames,
)
from alpenglow.operators import quality
from alpenglow.operators.flatten import good_days, latest_fetch_staged, rejected_days, split_days, transform_silver
from alpenglow.operators.tables import (
    MONTH, UpsertResult, append, drop_held, held, progress, read_watermark, refresh_new_dates, replace_partitions, since,
    table_months, upsert, write_by_month, write_watermark,
)
from alpenglow.plans.conditions import monthly_conditions, publish_table_view, refresh_seasonal
from alpenglow.plans.gradient import elevation_gradient
from alpenglow.plans.summit import refresh_summit_window
from alpenglow.schemas import FETCHED, route_key
from alpenglow.sources.archive import Transport, fetch_payloads
from alpenglow.sources.planner import missing_ranges, month_slices, request_manifest, with_load_range

PERIOD_MONTH = "period_month"


class QualityError(RuntimeError):
    """A declared check found violations, or the data is too old."""


@dataclass(frozen=True)
class Tables:
    """The tables of one environment."""

    names: TableNames

    @property
    def raw(self) -> str:
        return self.names.table("bronze", "weather_raw")

    @property
    def weather(self) -> str:
        return self.names.table("silver", "weather")

    @property
    def watermark(self) -> str:
        return self.names.table("meta", "watermark")

    @property
    def rejected(self) -> str:
        return self.names.table("silver", "rejected_days")

    @property
    def versions(self) -> str:
        return self.names.table("meta", "model_versions")

    def gold(self, model: str) -> str:
        return self.names.table("gold", model)


# --- Bronze -----------------------------------------------------------------------------------------------------------


def append_raw(rows: DataFrame, table: str) -> None:
    append(
        rows.withColumn(PERIOD_MONTH, F.trunc("period_start", "MM")).hint("rebalance", PERIOD_MONTH),
        table,
        partition_by=[PERIOD_MONTH],
    )


def load_bronze(
    spark: SparkSession, tables: Tables, waypoints: DataFrame, transport: Transport, settings: LoadSettings
) -> date | None:
    """Fetch and append every slice after the watermark; returns the new watermark, None when nothing was due.

    By default all slices are one job. With commit="slice" each month is appended and its watermark written before
    the next one starts, so a long first load resumes where it stopped. With resume="gaps" the watermark only ends the
    range: what is asked for are the days of the range, from its start on, that no landed slice of the waypoint holds.
    """
    mark = read_watermark(spark, tables.watermark, "bronze")
    due = with_load_range(spark.range(1), mark, settings)
    start, end = due.select("load_start", "load_end").first()
    if settings.resume == "gaps":
        ranged = waypoints.withColumns({"load_start": F.lit(settings.start), "load_end": F.lit(end)})
        if spark.catalog.tableExists(tables.raw):
            ranged = missing_ranges(ranged, spark.table(tables.raw))
        with held(request_manifest(ranged), tables.raw) as manifest:
            if manifest.isEmpty():
                return None
            append_raw(fetch_payloads(manifest, transport, settings.requests_per_task), tables.raw)
        write_watermark(spark, tables.watermark, "bronze", end)
        return end
    if start > end:
        return None
    if settings.commit == "slice":
        # One entry per calendar month of the range.
        ranges = month_slices(due).orderBy("period_start").select("period_start", "period_end").collect()
    else:
        ranges = [(start, end)]
    for first, last in ranges:
        ranged = waypoints.withColumns({"load_start": F.lit(first), "load_end": F.lit(last)})
        append_raw(fetch_payloads(request_manifest(ranged), transport, settings.requests_per_task), tables.raw)
        write_watermark(spark, tables.watermark, "bronze", last)
    return end


# --- Silver -----------------------------------------------------------------------------------------------------------


def read_new_raw(spark: SparkSession, tables: Tables, late_periods: bool = False) -> DataFrame:
    """Raw rows that silver has not seen: periods that start after its watermark.

    A re-fetched older slice starts before the watermark and is left out. late_periods=True selects by ingestion day
    instead and so takes them in (the last ingestion day is read again, which the upsert makes harmless).
    """
    raw = spark.table(tables.raw)
    if late_periods:
        seen = read_watermark(spark, tables.watermark, "silver_ingestion")
        return raw.filter(F.col("ingestion_timestamp") >= F.lit(seen)).drop(PERIOD_MONTH)
    mark = read_watermark(spark, tables.watermark, "silver")
    return raw.filter(
        (F.col("period_start") > F.lit(mark)) & (F.col(PERIOD_MONTH) >= F.lit(mark.replace(day=1)))
    ).drop(PERIOD_MONTH)


def weather_keys(df: DataFrame) -> list[str]:
    return [*route_key(df), "waypoint_name", "date"]


def load_silver(
    spark: SparkSession, tables: Tables, late_periods: bool = False, capture_changes: bool = False,
    divert: bool = False,
) -> UpsertResult:
    """Flatten and upsert the new raw rows; the latest date comes from the write itself.

    Rows keep the fetch they stem from. With late_periods, where older slices come again, only a newer fetch replaces a
    row. With divert the days that cannot be used are written to the table of rejected days, with the reason, instead
    of being padded or failing the load; payloads are read once for both.
    """
    drop_held(spark, tables.weather)
    raw = read_new_raw(spark, tables, late_periods)
    ingested = None
    if late_periods:
        ingested = raw.agg(F.max(F.to_date("ingestion_timestamp"))).first()[0]
    how = {"capture_changes": capture_changes, "newer_by": FETCHED if late_periods else None, "progress_by": route_key(raw)}
    if divert:
        seen = Observation()
        rejected = F.count_if(F.col("reason").isNotNull()).alias("rejected")
        with held(split_days(raw).observe(seen, rejected), tables.weather) as days:
            if seen.get["rejected"]:
                reject_days(days, tables.rejected)
            weather = latest_fetch_staged(good_days(days), keep_fetch=True)
            result = upsert(weather, tables.weather, weather_keys(weather), **how)
    else:
        weather = transform_silver(raw, keep_fetch=True)
        result = upsert(weather, tables.weather, weather_keys(weather), **how)
    last = result.max_date
    if late_periods and last is not None:
        last = max(last, read_watermark(spark, tables.watermark, "silver"))
    write_watermark(spark, tables.watermark, "silver", last)
    write_watermark(spark, tables.watermark, "silver_ingestion", ingested)
    return result


def reject_days(days: DataFrame, table: str) -> int:
    """Keep the rejected days of a split, once each however often the load runs; returns how many there are."""
    keys = [*route_key(days), "waypoint_name", "period_end", "ingestion_timestamp", "payload_hash", "position"]
    return upsert(rejected_days(days), table, keys, day="period_start").rows


# --- Gold -------------------------------------------------------------------------------------------------------------


def build_gold(spark: SparkSession, tables: Tables, changed_from: date | None = None) -> None:
    """Refresh the models. Monthly rows are recomputed from the first changed month on, the others by their own
    incremental rule; seasonal statistics are merged from month states, of which those that changed are renewed."""
    weather = spark.table(tables.weather)
    routes = route_key(weather)
    ends = progress(spark, tables.weather, routes) if routes else None
    publish_table_view(tables.weather, tables.gold("daily_conditions"), weather)
    refresh_new_dates(weather, tables.gold("elevation_gradient"), weather_keys(weather), elevation_gradient, ends)
    renewed = refresh_summit_window(weather, tables.gold("summit_window"), ends=ends)
    monthly, monthly_keys = tables.gold("monthly_conditions"), [*routes, "waypoint_name", "elevation"]
    if not spark.catalog.tableExists(monthly):
        write_by_month(monthly_conditions(weather), monthly, monthly_keys)
    elif changed_from is not None:
        changed = since(weather, changed_from.replace(day=1), inclusive=True)
        replace_partitions(monthly_conditions(changed).hint("rebalance", MONTH), monthly, monthly_keys)
    first = min((day.replace(day=1) for day in (changed_from, renewed.min_date) if day is not None), default=None)
    months = [] if first is None else [month for month in table_months(spark, tables.weather) if month >= first]
    refresh_seasonal(weather, spark.table(tables.gold("summit_window")), tables.gold("seasonal_states"),
                     tables.gold("seasonal_summary"), months)


# --- Checks -----------------------------------------------------------------------------------------------------------


def declared_checks(spark: SparkSession, tables: Tables) -> DataFrame:
    """(table_name, check_name, column_name, violations) of every declared check."""
    weather = spark.table(tables.weather)
    daily = spark.table(tables.gold("daily_conditions"))
    gradient = spark.table(tables.gold("elevation_gradient"))
    summit = spark.table(tables.gold("summit_window"))
    checks = [
        ("weather", quality.column_checks(
            weather,
            *quality.null_checks(NOT_NULL["weather"]),
            *quality.value_checks("waypoint_name", WAYPOINT_NAMES),
            *quality.range_checks(ACCEPTED_RANGES),
        )),
        ("daily_conditions", quality.not_null(daily, NOT_NULL["daily_conditions"])),
        ("elevation_gradient", quality.not_null(gradient, NOT_NULL["elevation_gradient"])),
        ("elevation_gradient", quality.unique(gradient, weather_keys(gradient))),
        ("summit_window", quality.not_null(summit, NOT_NULL["summit_window"])),
        ("summit_window", quality.unique(summit, [*route_key(summit), "date"])),
    ]
    named = [rows.select(F.lit(table).alias("table_name"), "*") for table, rows in checks]
    result = named[0]
    for rows in named[1:]:
        result = result.unionByName(rows)
    return result


def require_quality(spark: SparkSession, tables: Tables) -> None:
    failed = declared_checks(spark, tables).filter("violations > 0").collect()  # at most one row per declared column
    if failed:
        raise QualityError("; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.violations}" for r in failed))


def require_fresh(spark: SparkSession, tables: Tables, settings: LoadSettings) -> str:
    """'pass' or 'warn'; raises when the weather table is older than allowed."""
    state = quality.freshness(
        spark.table(tables.weather), settings.today,
        warn_after=settings.warn_after_days, fail_after=settings.fail_after_days,
    ).first()
    if state.status == "fail":
        raise QualityError(f"latest date {state.latest_date} is {state.age_days} days old")
    return state.status


# --- All together -----------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class RunReport:
    loaded_to: date | None
    silver: UpsertResult
    freshness: str | None


def run_load(
    spark: SparkSession,
    tables: Tables,
    waypoints: DataFrame,
    transport: Transport,
    settings: LoadSettings,
    check_freshness: bool = True,
) -> RunReport:
    """One full run. Backfills of a closed period have no meaningful age: pass check_freshness=False for them."""
    loaded_to = load_bronze(spark, tables, waypoints, transport, settings)
    silver = load_silver(
        spark, tables, settings.late_periods, settings.capture_changes or settings.follow_changes, settings.divert)
    if settings.follow_changes:
        from alpenglow.plans.upkeep import follow_changes

        follow_changes(spark, tables)
    else:
        build_gold(spark, tables, silver.min_date)
    require_quality(spark, tables)
    fresh = require_fresh(spark, tables, settings) if check_freshness else None
    return RunReport(loaded_to, silver, fresh)

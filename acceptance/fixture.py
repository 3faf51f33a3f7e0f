"""The weather inputs as DataFrames derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import mapping as m
from alpenglow.config import TIME_FIELD, VARIABLES
from alpenglow.functions.units import air_density
from alpenglow.schemas import WEATHER_COLUMNS, WEATHER_RAW

_PAYLOAD_FIELD = {column: source for source, column, _ in VARIABLES}


def cells(spark: SparkSession, sf_dir: str, single: bool = False) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.expr("l_suppkey div 5").alias("route_id"),
        F.expr("CAST(l_suppkey % 5 AS INT)").alias("w"),
        F.to_date("l_shipdate").alias("d"),
        F.col("l_partkey").alias("p"),
        F.col("l_quantity").cast("bigint").alias("n"),
    )
    keys = ["w", "d"] if single else ["route_id", "w", "d"]
    return lines.groupBy(*keys).agg(F.sum("p").alias("k"), F.sum("n").alias("q"))


def _units(grid: DataFrame, shift: str) -> DataFrame:
    """Cells with the whole-number form of each measure under its weather column name."""
    staged = grid.withColumns({name: F.expr(sql) for name, sql in m.CALENDAR.items()}).withColumns(
        {"g": F.expr(m.GUST), "shift": F.expr(shift)}
    )
    return staged.withColumns({name: F.expr(sql.format(div="div")) for name, sql, _, _ in m.MEASURES})


def weather_of(grid: DataFrame, shift: str = m.NO_SHIFT) -> DataFrame:
    routes = [name for name in ("route_id",) if name in grid.columns]
    typed = [F.expr(f"CAST({name} / {per} AS DECIMAL(10,2))").alias(name) for name, _, per, _ in m.MEASURES]
    return (
        _units(grid, shift)
        .select(
            *routes,
            F.expr(m.NAME).alias("waypoint_name"),
            F.expr(m.ELEVATION).alias("elevation"),
            F.col("d").alias("date"),
            *typed,
        )
        .withColumn("air_density_kgm3", air_density(F.col("pressure_hpa"), F.col("temperature_min_c")))
        .select(*routes, *WEATHER_COLUMNS)
    )


def weather(spark: SparkSession, sf_dir: str, shift: str = m.NO_SHIFT) -> DataFrame:
    """The weather table over all routes."""
    return weather_of(cells(spark, sf_dir), shift)


def weather_single_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather table of one route, without route_id."""
    return weather_of(cells(spark, sf_dir, single=True))


def blanked_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The single-route table with some measures missing."""
    df = weather_single_route(spark, sf_dir)
    for name, condition in m.BLANKS:
        df = df.withColumn(name, F.when(~F.expr(condition), F.col(name)))
    return df


def waypoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One waypoint per supplier."""
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.expr("s_suppkey div 5").alias("route_id"), F.expr("CAST(s_suppkey % 5 AS INT)").alias("w")
    ).select(
        "route_id",
        F.expr(m.NAME).alias("waypoint_name"),
        F.expr(f"CAST({m.LAT} AS DOUBLE)").alias("lat"),
        F.expr(f"CAST({m.LON} AS DOUBLE)").alias("lon"),
        F.expr(m.ELEVATION).alias("elevation"),
    )


def payload_slices(grid: DataFrame, shift: str = m.NO_SHIFT) -> DataFrame:
    """One payload text per waypoint and month (at most 31 days each).

    The cells of a month are brought together as they are; their measures, five times as wide, are made behind that
    shuffle, and what joins the payloads by waypoint and month finds them in place.
    """
    keys = ["route_id", "w", "waypoint_name", "period_start"]
    raw = [F.expr(f"CAST({name} AS DOUBLE) {op}D").alias(_PAYLOAD_FIELD[name]) for name, _, _, op in m.MEASURES]
    named = grid.withColumns({"waypoint_name": F.expr(m.NAME), "period_start": F.trunc("d", "MM")})
    days = _units(named.repartition("route_id", "waypoint_name", "period_start"), shift).select(
        *keys, F.struct(F.date_format("d", "yyyy-MM-dd").alias(TIME_FIELD), *raw).alias("day")
    )
    month = days.groupBy(*keys).agg(F.sort_array(F.collect_list("day")).alias("days"))
    fields = [TIME_FIELD, *(_PAYLOAD_FIELD[name] for name, *_ in m.MEASURES)]
    daily = F.struct(*[F.col(f"days.{name}").alias(name) for name in fields])
    return month.select(
        *keys, F.last_day("period_start").alias("period_end"), F.to_json(F.struct(daily.alias("daily"))).alias("response_json")
    )


def raw_rows(slices: DataFrame) -> DataFrame:
    return slices.withColumns({
        "elevation": F.expr(m.ELEVATION),
        "ingestion_timestamp": F.date_add("period_end", 8).cast("timestamp"),
    }).select("route_id", *WEATHER_RAW.fieldNames())


def clean_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows without faults or repeats."""
    return raw_rows(payload_slices(cells(spark, sf_dir)))


def refetched_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second fetch of the March slices: a month later, one degree warmer."""
    grid = cells(spark, sf_dir).filter(m.REFETCHED)
    later = F.last_day(F.add_months("period_start", 1))
    return raw_rows(payload_slices(grid, m.ONE_DEGREE).withColumn("period_end", later))


def faulty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First fetches, some of them without snow depth and some cut off in the middle of the text."""
    base = payload_slices(cells(spark, sf_dir)).withColumn("d", F.col("period_start"))
    without_depth = F.regexp_replace("response_json", r'"snow_depth_max":\[[^\]]*\],', "")
    cut = F.expr("substring(response_json, 1, length(response_json) div 2)")
    return raw_rows(
        base.withColumn(
            "response_json",
            F.when(F.expr(m.MISSING_VARIABLE), without_depth)
            .when(F.expr(m.MALFORMED), cut)
            .otherwise(F.col("response_json")),
        )
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything the archive delivered: first fetches with faults, and refetches."""
    return faulty_raw(spark, sf_dir).unionByName(refetched_raw(spark, sf_dir))


def archive_slices(raw: DataFrame, slices: DataFrame) -> DataFrame:
    """The payload of every planned slice; a month without days is an empty payload, not a missing one."""
    keys = ["route_id", "waypoint_name", "period_start"]
    nothing = F.to_json(F.struct(F.struct(*[
        F.array().cast("array<string>").alias(name) for name in (TIME_FIELD, *_PAYLOAD_FIELD.values())
    ]).alias("daily")))
    given = raw.select(*keys, "response_json")
    return slices.select(*keys).join(given, keys, "left").withColumn(
        "response_json", F.coalesce("response_json", nothing))


def damaged_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty first fetches, some more of them with an array that ends early or a day that is no date."""
    rows = faulty_raw(spark, sf_dir).withColumns({
        "d": F.col("period_start"), "w": F.expr(f"CAST({m.WAYPOINT} AS INT)")})
    shorter = F.regexp_replace("response_json", r'("snow_depth_max":\[[^\]]*),[^,\]]*\]', "$1]")
    undated = F.regexp_replace("response_json", r'"time":\["(\d{4})-\d\d-', '"time":["$1-13-')
    damaged = F.when(F.expr(m.RAGGED), shorter).when(F.expr(m.BAD_DATE), undated).otherwise(F.col("response_json"))
    return rows.withColumn("response_json", damaged).drop("d", "w")


def held_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices that an earlier load has left, with holes and overlaps."""
    slices = payload_slices(cells(spark, sf_dir)).filter(m.HELD)
    return slices.withColumns({
        "period_end": F.expr(m.HELD_END.format(ten_later="date_add(period_end, 10)")),
    }).withColumn("period_start", F.expr(m.HELD_START.format(nine_later="date_add(period_start, 9)")))

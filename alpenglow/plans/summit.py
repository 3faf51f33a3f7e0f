"""Route conditions per day: one pivot over the weather table, rolling windows, scores and day flags.

The table is scanned once. All waypoints of a route-day meet in a single aggregate (partial before the shuffle), which
replaces one filtered copy of the table per role and the joins between them. It is exact because a waypoint has one
row per day.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from alpenglow import config as c
from alpenglow.functions.scores import at_least_zero, at_most_hundred, falling, plateau, risk, weighted
from alpenglow.operators.tables import (
    MONTH, UpsertResult, held, latest_by_route, progress, route_ends, since, table_max_date, upsert,
)
from alpenglow.schemas import route_key

# What the model reads of each waypoint with a role of its own.
ROLE_MEASURES = {
    c.SUMMIT: (
        "temperature_min_c", "temperature_max_c", "windgusts_max_ms", "cloudcover_pct", "air_density_kgm3",
        "daylight_hours",
    ),
    c.GOUTER: ("temperature_min_c", "temperature_max_c", "windgusts_max_ms"),
    c.VALLOT: ("windgusts_max_ms",),
}

# Output columns, in table order.
RAW_COLUMNS = tuple(f"{role}_{measure}" for role, measures in ROLE_MEASURES.items() for measure in measures)
ROUTE_COLUMNS = (  # (output, source, scale)
    ("route_precipitation_mm", "route_precipitation", 2),
    ("route_snowfall_cm", "route_snowfall", 2),
    ("route_3d_snowfall_cm", "route_3d_snowfall", 2),
    ("route_snow_depth_m", "route_snow_depth", 3),
    ("route_30d_snow_depth_m", "route_30d_snow_depth", 3),
    ("route_7d_snow_depth_change_m", "route_7d_snow_depth_change", 3),
    ("route_sunshine_hours", "route_sunshine", 2),
    ("gouter_3d_temp_mean_c", "gouter_3d_temp_mean", 2),
    ("gouter_30d_temp_max_c", "gouter_30d_temp_max", 2),
)
SUB_SCORES = (
    "wind_score_summit", "wind_score_gouter", "wind_score_vallot", "temperature_score_cold", "temperature_score_heat",
    "visibility_score", "grand_couloir_score_freeze", "grand_couloir_score_thaw", "avalanche_risk_thermal",
    "avalanche_risk_solar", "avalanche_risk_dry_slab", "avalanche_risk_wet_slab", "avalanche_risk_wind_slab",
)
SCORE_COLUMNS = (
    "wind_score", "wind_score_summit", "wind_score_gouter", "wind_score_vallot", "temperature_score",
    "temperature_score_cold", "temperature_score_heat", "visibility_score", "grand_couloir_score",
    "grand_couloir_score_freeze", "grand_couloir_score_thaw", "avalanche_score", "avalanche_risk_thermal",
    "avalanche_risk_solar", "avalanche_risk_dry_slab", "avalanche_risk_wet_slab", "avalanche_risk_wind_slab",
    "overall_score",
)
CATEGORY_SCORES = tuple(name for name, _ in c.OVERALL_WEIGHTS)
FLAGS = ("is_viable", "is_recommended", "is_ideal")


def _is(*roles: str) -> Column:
    return F.col("waypoint_name").isin(*roles)


def route_pivot(weather: DataFrame) -> DataFrame:
    """One row per route and day: the role waypoints' measures side by side, the route averages, and which roles are
    present.

    Snow depth and sunshine are averaged over the snowpack waypoints, precipitation and snowfall over all of them.
    """
    by_role = [
        F.max(F.when(_is(role), F.col(measure))).alias(f"{role}_{measure}")
        for role, measures in ROLE_MEASURES.items()
        for measure in measures
    ]
    snowpack = _is(*c.SNOWPACK)
    return weather.groupBy(*route_key(weather), "date").agg(
        *by_role,
        F.avg(F.when(snowpack, F.col("snow_depth_m"))).alias("route_snow_depth"),
        F.avg(F.when(snowpack, F.col("sunshine_hours"))).alias("route_sunshine"),
        F.avg("precipitation_mm").alias("route_precipitation"),
        F.avg("snowfall_cm").alias("route_snowfall"),
        *[F.bool_or(_is(role)).alias(f"has_{role}") for role in ROLE_MEASURES],
    )


#: Days of a block of one long series.
BLOCK_DAYS = 512


def rolling_conditions(pivot: DataFrame) -> DataFrame:
    """Rolling means and sums over the days that have a gouter row, whether or not the other roles are present.

    Frames count rows, not days, so a gap stretches them. A route has one row per calendar day here, so the group a
    window task holds is bounded by the length of the record (about 365 rows a year) however large the table is. A table
    of one route is cut into blocks of days, each with the rows before it that its frames reach.
    """
    gouter = pivot.filter(f"has_{c.GOUTER}")
    if route_key(pivot):
        return _rolled(gouter, Window.partitionBy(*route_key(pivot)).orderBy("date"))
    blocks = with_halo(gouter, c.LONG_FRAME - 1)
    rolled = _rolled(blocks, Window.partitionBy("__block").orderBy("date"))
    return rolled.filter("NOT __halo").drop("__block", "__halo")


def with_halo(series: DataFrame, reach: int, block_days: int = BLOCK_DAYS) -> DataFrame:
    """A series (one row a date) in blocks of days: __block, and __halo for the copies of the `reach` rows before it.

    How many rows a block has decides whose last rows a later block needs; these numbers, one row a block, are what all
    blocks share. Copies are at most `reach` for each block. Rows without a date stand before all others, as in a window.
    """
    placed = series.withColumn("__block", F.coalesce(
        F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / block_days), F.lit(-(2**40))).cast("bigint"))
    sizes = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("__n"))
    in_order = Window.orderBy("__block")  # a row a block
    so_far = F.sum("__n").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sizes = sizes.withColumn("__until", so_far).withColumn("__later", F.collect_list(F.struct(
        F.col("__block").alias("to"), (F.col("__until") - F.col("__n")).alias("before"))).over(in_order.rowsBetween(1, reach)))
    from_end = Window.partitionBy("__block").orderBy(F.col("date").desc())
    ranked = placed.withColumn("__last", F.row_number().over(from_end)).filter(F.col("__last") <= reach)
    # A later block needs the row if it is among the last `reach` before that block begins.
    needed = F.filter("__later", lambda x: x["before"] - F.col("__until") + F.col("__last") <= reach)
    halo = ranked.join(sizes.select("__block", "__until", "__later"), "__block").select(
        *series.columns, F.explode(F.transform(needed, lambda x: x["to"])).alias("__to"))
    halo = halo.select(*series.columns, F.col("__to").alias("__block"), F.lit(True).alias("__halo"))
    return placed.withColumn("__halo", F.lit(False)).unionByName(halo)


def _rolled(gouter: DataFrame, days: WindowSpec) -> DataFrame:
    short = days.rowsBetween(1 - c.SHORT_FRAME, Window.currentRow)
    long = days.rowsBetween(1 - c.LONG_FRAME, Window.currentRow)
    depth = F.col("route_snow_depth")
    return gouter.withColumns({
        "gouter_3d_temp_mean": F.avg((F.col("gouter_temperature_max_c") + F.col("gouter_temperature_min_c")) / 2).over(
            short
        ),
        "gouter_30d_temp_max": F.avg("gouter_temperature_max_c").over(long),
        "route_3d_snowfall": F.sum("route_snowfall").over(short),
        "route_30d_snow_depth": F.avg("route_snow_depth").over(long),
        "route_7d_snow_depth_change": depth - F.lag(depth, c.DEPTH_CHANGE_LAG).over(days),
    })


def complete_days(rolling: DataFrame) -> DataFrame:
    """Days on which every role is present. Only after the windows: they count all gouter days."""
    return rolling.filter(f"has_{c.SUMMIT} AND has_{c.VALLOT}").drop(*[f"has_{role}" for role in ROLE_MEASURES])


def with_sub_scores(days: DataFrame) -> DataFrame:
    """Single-cause scores and avalanche risks, as whole decimals."""
    tmax, couloir = F.col("summit_temperature_max_c"), F.col("gouter_temperature_max_c")
    scored = days.withColumns({
        **{name: falling(F.col(x), zero_at, width) for name, x, zero_at, width in c.FALLING_RAMPS},
        "temperature_score_cold": plateau(tmax >= c.COLD_FULL_FROM, tmax - c.COLD_ZERO_AT, c.COLD_WIDTH),
        "temperature_score_heat": plateau(tmax <= c.HEAT_FULL_TO, c.HEAT_ZERO_AT - tmax, c.HEAT_WIDTH),
        "grand_couloir_score_freeze": plateau(
            couloir <= c.FREEZE_FULL_TO, c.FREEZE_ZERO_AT - couloir, c.FREEZE_WIDTH
        ),
        "avalanche_risk_thermal": risk(
            100 * (F.col("gouter_30d_temp_max") - c.THERMAL_ZERO_AT) / F.lit(c.THERMAL_WIDTH)
        ),
        "avalanche_risk_solar": risk(
            F.col("route_sunshine") / F.lit(c.SOLAR_FULL_SUN_HOURS)
            * at_least_zero((couloir - c.SOLAR_ZERO_AT) / F.lit(c.SOLAR_WIDTH))
            * 100
        ),
        "avalanche_risk_wind_slab": risk(
            _share("route_3d_snowfall", c.WIND_SLAB_FULL_SNOWFALL_CM)
            * _share("gouter_windgusts_max_ms", c.WIND_SLAB_FULL_GUST_MS)
            * 100
        ),
    })
    # The slab risks build on the rounded thermal and solar risks.
    snow = F.when(F.col("route_snow_depth") >= F.lit(c.DRY_SLAB_MIN_DEPTH_M), _decimal("1.0")).otherwise(F.lit(0))
    bare = at_least_zero(_decimal("1.0") - F.col("route_30d_snow_depth") / F.lit(c.DRY_SLAB_COVER_M))
    return scored.withColumns({
        "avalanche_risk_dry_slab": risk(F.col("avalanche_risk_thermal") * snow * bare),
        "avalanche_risk_wet_slab": risk(
            F.col("avalanche_risk_solar") * _share("route_snow_depth", c.WET_SLAB_FULL_DEPTH_M)
        ),
    })


def _decimal(text: str) -> Column:
    return F.lit(c.Decimal(text))


def _share(name: str, full: c.Decimal) -> Column:
    """The measure as a share of its full effect, at most 1."""
    return F.least(_decimal("1.0"), F.col(name) / F.lit(full))


def with_category_scores(scored: DataFrame) -> DataFrame:
    """Combined scores per category, and the overall score."""
    slab = F.greatest("avalanche_risk_dry_slab", "avalanche_risk_wet_slab")
    return scored.withColumns({
        "wind_score": weighted(c.WIND_WEIGHTS),
        "temperature_score": F.least("temperature_score_cold", "temperature_score_heat"),
        "grand_couloir_score": weighted(c.COULOIR_WEIGHTS),
        "avalanche_score": at_least_zero(F.round(100 - at_most_hundred(F.col("avalanche_risk_wind_slab") + slab))),
    }).withColumn("overall_score", weighted(c.OVERALL_WEIGHTS))


def _gate(gates: c.Gates) -> Column:
    conditions = [
        F.col("summit_windgusts_max_ms") <= gates.summit_gust,
        F.col("summit_temperature_max_c").between(gates.summit_coldest, gates.summit_warmest),
        F.col("summit_cloudcover_pct") <= gates.summit_cloud,
        F.col("gouter_temperature_min_c") < 0,
        F.col("gouter_windgusts_max_ms") <= gates.lower_gust,
        F.col("vallot_windgusts_max_ms") <= gates.lower_gust,
        F.col("route_precipitation") == 0,
        F.col("route_snowfall") == 0,
        F.col("route_3d_snowfall") <= gates.snowfall_3d,
    ]
    if gates.mean_temp_below is not None:
        conditions.append(F.col("gouter_3d_temp_mean") < gates.mean_temp_below)
    return reduce(and_, conditions)


def with_flags(scored: DataFrame) -> DataFrame:
    """Viable, recommended and ideal days; a missing measure makes a flag unknown unless another gate fails."""
    ideal = reduce(and_, [F.col(name) >= c.IDEAL_MIN_SCORE for name in CATEGORY_SCORES])
    return scored.withColumns({"is_viable": _gate(c.VIABLE), "is_recommended": _gate(c.RECOMMENDED)}).withColumn(
        "is_ideal", F.col("is_recommended") & ideal
    )


def summit_window(weather: DataFrame) -> DataFrame:
    """Route conditions, scores and flags of every day on which summit, gouter and vallot have a row."""
    days = complete_days(rolling_conditions(route_pivot(weather)))
    scored = with_flags(with_category_scores(with_sub_scores(days)))
    return scored.select(
        *route_key(weather),
        "date",
        *RAW_COLUMNS,
        *[F.col(x).cast(f"decimal(10,{scale})").alias(name) for name, x, scale in ROUTE_COLUMNS],
        *[F.col(name).cast("int").alias(name) for name in SCORE_COLUMNS],
        *FLAGS,
    )


# --- Incremental refresh ----------------------------------------------------------------------------------------------


#: Days before a cutoff in which its 29 gouter days are looked for first.
NEAR_DAYS = 62


def _days_needed(weather: DataFrame, until: Column) -> DataFrame:
    """The 29 latest gouter days of each route up to its cutoff, which the first frames after it reach back to."""
    newest_first = Window.partitionBy(*route_key(weather)).orderBy(F.col("date").desc())
    return (
        weather.filter(_is(c.GOUTER) & (F.col("date") <= until))
        .select(*route_key(weather), "date")
        .withColumn("nth", F.row_number().over(newest_first))
        .filter(F.col("nth") < c.LONG_FRAME)
    )


def history_for_windows(weather: DataFrame, cutoff: date) -> DataFrame:
    """The part of the weather table of a single route that the rows after `cutoff` depend on.

    A row frame of 30 reaches back 29 gouter days, however long ago they were. Those days are found on the key columns
    of the gouter rows alone, first in the months before the cutoff; the earliest of them is a literal that prunes months.
    """
    found = None
    for near in (since(weather, cutoff - timedelta(days=NEAR_DAYS), inclusive=True), weather):
        found = _days_needed(near, F.lit(cutoff)).agg(F.min("date"), F.count("date")).first()
        if found[1] == c.LONG_FRAME - 1:
            break
    return since(weather, found[0] if found[0] is not None else cutoff, inclusive=found[0] is not None)


def routes_to_refresh(weather: DataFrame, target: DataFrame, last: date, lookback_days: int,
                      ends: DataFrame | None = None, latest: DataFrame | None = None) -> DataFrame:
    """route_id, cutoff (null: the target lacks the route), first_day of the routes to refresh.

    Routes within the look-back of the target's latest day share one cutoff, that day minus the look-back. A route that
    lags further has its own latest day minus the look-back, if it has newer days at all. `ends` (first_day, last_day)
    and `latest` (latest) of the routes are aggregated from the two tables' keys where they are not given.
    """
    routes = route_key(weather)
    shared = last - timedelta(days=lookback_days)
    ends = route_ends(weather, routes) if ends is None else ends
    latest = latest_by_route(target, routes) if latest is None else latest
    near = F.col("latest") >= F.lit(shared)
    return (
        ends.join(latest, routes, "left")
        .filter(F.col("latest").isNull() | near | (F.col("last_day") > F.col("latest")))
        .select(*routes, F.when(near, F.lit(shared)).otherwise(F.date_sub("latest", lookback_days)).alias("cutoff"),
                "first_day")
    )


def _first_needed(weather: DataFrame, stale: DataFrame) -> DataFrame:
    """For each route with a cutoff, the earliest day its frames reach back to.

    The months before the earliest cutoff usually hold all 29 days; only routes with fewer are looked up in the rest.
    """
    routes = route_key(weather)
    earliest = stale.agg(F.min("cutoff")).first()[0]
    if earliest is None:
        return stale.limit(0).select(*routes, F.col("cutoff").alias("first_needed"))

    def first_days(days: DataFrame) -> DataFrame:
        return _days_needed(days, F.col("cutoff")).groupBy(*routes).agg(
            F.min("date").alias("first_needed"), F.count("date").alias("n"))

    near = since(weather, earliest - timedelta(days=NEAR_DAYS), inclusive=True)
    found = first_days(near.join(stale, routes))
    full = F.col("n") == c.LONG_FRAME - 1
    short = stale.filter(F.col("cutoff").isNotNull()).join(found.filter(full), routes, "left_anti")
    complete = found.filter(full).drop("n")
    return complete if short.isEmpty() else complete.unionByName(first_days(weather.join(short, routes)).drop("n"))


def history_by_route(weather: DataFrame, stale: DataFrame) -> DataFrame:
    """What the rows after each route's cutoff depend on, with the column cutoff; rows of other routes are left out.

    As `history_for_windows`, with a start for each route. Routes that are not refreshed do not hold back the pruning.
    """
    routes = route_key(weather)
    starts = stale.join(_first_needed(weather, stale), routes, "left").select(
        *routes, "cutoff", F.coalesce("first_needed", F.date_add("cutoff", 1), "first_day").alias("start"))
    earliest = starts.agg(F.min("start")).first()[0]
    read = weather.limit(0) if earliest is None else since(weather, earliest, inclusive=True)
    return read.join(starts, routes).filter(F.col("date") >= F.col("start")).drop("start")


def refresh_summit_window(weather: DataFrame, table: str, lookback_days: int = c.LOOKBACK_DAYS,
                          ends: DataFrame | None = None) -> UpsertResult:
    """Recompute each route's days after its cutoff (see `routes_to_refresh`) and upsert them.

    A missing or empty target means a full run, and so does a route that the target lacks. The routes to refresh are
    told by progress notes: the target's own, and the weather table's if `ends` are passed.
    """
    spark = weather.sparkSession
    routes = route_key(weather)
    keys = [*routes, "date"]
    last = table_max_date(spark, table) if spark.catalog.tableExists(table) else None
    if last is None:
        return upsert(summit_window(weather), table, keys, progress_by=routes)
    if not routes:
        cutoff = last - timedelta(days=lookback_days)
        fresh = summit_window(history_for_windows(weather, cutoff)).filter(F.col("date") > F.lit(cutoff))
        return upsert(fresh, table, keys)
    latest = progress(spark, table, routes).select(*routes, F.col("last_day").alias("latest"))
    with held(routes_to_refresh(weather, spark.table(table), last, lookback_days, ends, latest), table) as stale:
        fresh = summit_window(history_by_route(weather, stale).drop("cutoff"))
        fresh = fresh.join(stale.select(*routes, "cutoff"), routes).filter(
            F.col("cutoff").isNull() | (F.col("date") > F.col("cutoff"))).drop("cutoff")
        return upsert(fresh, table, keys, progress_by=routes)


# --- Refresh from changes ---------------------------------------------------------------------------------------------


def days_affected(weather: DataFrame, changed: DataFrame) -> DataFrame:
    """The days (of each route) whose rows can differ once the weather of the `changed` days does: these days, and as many
    gouter days after each as the longest frame reaches. Read on the keys of gouter rows from the first change on."""
    routes = route_key(weather)
    first = changed.agg(F.min("date")).first()[0]
    if first is None:
        return changed
    gouter = since(weather, first, inclusive=True).filter(_is(c.GOUTER)).select(*routes, "date")
    if routes:
        gouter = gouter.join(changed.select(*routes).distinct(), routes, "left_semi")
    days = (
        gouter.withColumns({"is_gouter": F.lit(1), "is_changed": F.lit(0)})
        .unionByName(changed.select(*routes, "date").withColumns({"is_gouter": F.lit(0), "is_changed": F.lit(1)}))
        .groupBy(*routes, "date")
        .agg(F.max("is_gouter").alias("is_gouter"), F.max("is_changed").alias("is_changed"))
    )
    so_far = Window.partitionBy(*routes).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = days.withColumn("nth", F.sum("is_gouter").over(so_far))
    since_change = F.col("nth") - F.max(F.when(F.col("is_changed") == 1, F.col("nth") - F.col("is_gouter"))).over(so_far)
    return days.withColumn("distance", since_change).filter(
        (F.col("is_changed") == 1) | (F.col("distance") <= c.LONG_FRAME)).select(*routes, "date")


def recompute_days(weather: DataFrame, affected: DataFrame) -> DataFrame:
    """The model's rows of the affected days, from no more weather than they depend on."""
    routes = route_key(weather)
    last = affected.agg(F.max("date"), F.min("date")).first()
    if last[0] is None:
        return summit_window(weather.limit(0))
    until = weather.filter(F.col("date") <= F.lit(last[0]))
    if MONTH in weather.columns:
        until = until.filter(F.col(MONTH) <= F.lit(last[0].replace(day=1)))
    if not routes:
        rows = summit_window(history_for_windows(until, last[1] - timedelta(days=1)))
    else:
        ends = affected.groupBy(*routes).agg(
            F.date_sub(F.min("date"), 1).alias("cutoff"), F.min("date").alias("first_day"), F.max("date").alias("until"))
        needed = history_by_route(until, ends.drop("until")).drop("cutoff")
        rows = summit_window(needed.join(ends.select(*routes, "until"), routes).filter("date <= until").drop("until"))
    return rows.join(affected, [*routes, "date"], "left_semi")

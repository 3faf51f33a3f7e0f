"""Table state on plain Parquet tables: appends, the progress watermark, keyed upserts, incremental models, change
feeds.

Dated tables are partitioned by calendar month, so an upsert rewrites only the months its batch touches and a read
behind a date literal prunes to the months it needs.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from alpenglow.config import NO_WATERMARK, TableNames
from alpenglow.functions.dates import month_of
from alpenglow.schemas import FETCHED, WATERMARK
from alpenglow.session import conf_scope

MONTH = "month"


def create_databases(spark: SparkSession, names: TableNames, folder: str | None = None) -> None:
    """The layer databases, below `folder` if given, else in the session's warehouse."""
    for layer in names.layers:
        where = f" LOCATION '{folder}/{layer}'" if folder else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {names.database(layer)}{where}")


def append(df: DataFrame, table: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Append (or write in the given mode) to a table, creating it on first use."""
    writer = df.write.format("parquet").option("compression", "zstd").mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def with_month(df: DataFrame, day: str = "date") -> DataFrame:
    return df.withColumn(MONTH, month_of(F.col(day)))


def gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with those of a group beside each other, for an aggregate over rows in no order: there nearly every group
    has a row in every task, and each task would hold and send a state of all of them. Rebalancing is by a hash that the
    aggregate does not know, so a group of many rows is still cut and its parts are summed first."""
    return df.withColumn("__group", F.xxhash64(*keys)).hint("rebalance", "__group").drop("__group")


def since(df: DataFrame, day: date | None, inclusive: bool = False) -> DataFrame:
    """Rows after (or from) a date; the literal also prunes month partitions."""
    if day is None:
        return df
    kept = df.filter(F.col("date") >= F.lit(day) if inclusive else F.col("date") > F.lit(day))
    return kept.filter(F.col(MONTH) >= F.lit(day.replace(day=1))) if MONTH in df.columns else kept


def max_date(df: DataFrame, column: str = "date") -> date | None:
    """The latest date, None for an empty frame; nulls are ignored."""
    return df.agg(F.max(column)).first()[0]


def table_max_date(spark: SparkSession, table: str) -> date | None:
    """The latest date of a month-partitioned table, read from its last month alone (the catalog knows which)."""
    months = [month for month in _partition_months(spark, table) if month is not None]
    return max_date(spark.table(table).filter(F.col(MONTH) == F.lit(max(months)))) if months else None


def latest_by_route(df: DataFrame, routes: Sequence[str], name: str = "latest") -> DataFrame:
    """One row a route: its latest date."""
    return df.groupBy(*routes).agg(F.max("date").alias(name)).filter(F.col(name).isNotNull())


def after_each(source: DataFrame, cutoffs: DataFrame, routes: Sequence[str], name: str = "latest") -> DataFrame:
    """The source rows after their own route's cutoff; a route without one counts in full."""
    joined = source.join(cutoffs, list(routes), "left")
    return joined.filter(F.col(name).isNull() | (F.col("date") > F.col(name))).drop(name)


def route_ends(source: DataFrame, routes: Sequence[str]) -> DataFrame:
    """One row a route: its first and last day."""
    return source.groupBy(*routes).agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def behind(ends: DataFrame, cutoffs: DataFrame, routes: Sequence[str], name: str = "latest") -> DataFrame:
    """One row for each route that ends after its cutoff: the route, its cutoff (null: not in the target) and its first
    day. Both sides have a row a route."""
    return ends.join(cutoffs, list(routes), "left").filter(
        F.col(name).isNull() | (F.col("last_day") > F.col(name))).drop("last_day")


# --- Progress watermark -----------------------------------------------------------------------------------------------


def read_watermark(spark: SparkSession, table: str, layer: str) -> date:
    """The layer's last completed date, or the 1900-01-01 sentinel when the table or the layer is not there yet.
    Any other error surfaces: taking it for "nothing loaded" would start a full reload."""
    if not spark.catalog.tableExists(table):
        return NO_WATERMARK
    last = F.coalesce(F.max("last_completed_date"), F.lit(NO_WATERMARK))
    return spark.table(table).filter(F.col("layer") == layer).agg(last).first()[0]


def write_watermark(spark: SparkSession, table: str, layer: str, completed: date | None) -> None:
    """Replace this layer's row and no other; nothing happens without a date."""
    if completed is None:
        return
    row = spark.createDataFrame([(layer, completed)], WATERMARK)
    if spark.catalog.tableExists(table):
        replace_partitions(row, table)
    else:
        append(row, table, partition_by=["layer"])


# --- Upsert -----------------------------------------------------------------------------------------------------------


class DuplicateKeysError(ValueError):
    """An upsert batch holds several rows for one key, so which one wins would be arbitrary."""


@dataclass(frozen=True)
class UpsertResult:
    created: bool
    rows: int
    min_date: date | None
    max_date: date | None


def upsert(
    batch: DataFrame, table: str, keys: Sequence[str], day: str = "date", capture_changes: bool = False,
    newer_by: str | None = None, gone: DataFrame | None = None, progress_by: Sequence[str] = (),
) -> UpsertResult:
    """Update the rows of `table` that match the batch on `keys`, insert the others; create the table on first use.

    1. The batch is written once to a staging table (its lineage ends there; row count and date range are observed on
       the way), so nothing upstream is evaluated twice. A new table is written at once in its final form; its keys are
       checked there, and until then a marker says that it does not count.
    2. The months it touches are read from the target, minus the keys of the batch, and written together with the
       batch to a merged table. Months that are new to the target skip this and the next step and are written as is.
    3. The merged months replace those of the target.

    A crash in step 3 can leave months half replaced; the merged table is still there then and `recover` replays it,
    which the next upsert of the table does first. A new table whose marker is still there is dropped. Every step can be
    repeated with the same result.

    With capture_changes the row changes of each later upsert (the first one is the table itself) are kept in
    `<table>_changes`, one partition per upsert, numbered in their order. The merged rows are then staged together with
    those that go, so the target is joined to the batch once for both.

    newer_by names a column that orders the states of a row: a batch row then replaces only a row whose value is smaller
    or unknown. gone holds keys whose rows are deleted (those of the batch come back with the batch). progress_by names
    the groups whose first and last day of this batch are noted, for `progress`.
    """
    spark = batch.sparkSession
    recover(spark, table, keys)
    seen = Observation()
    batch = with_month(batch, day).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.min(day).alias("min_date"), F.max(day).alias("max_date")
    )
    staging = _Staging(table, _new_commit(spark, table, capture_changes))
    created = not spark.catalog.tableExists(table)
    if created:
        _create(batch, staging, table, keys)
    else:
        append(batch, staging.batch)
    staged = spark.table(table if created else staging.batch)
    try:
        if not created:
            months = _checked_months(staged, keys)
            if newer_by is not None and newer_by not in spark.table(table).columns:
                raise ValueError(f"{table} has no column {newer_by} to tell newer rows by")
            there = _partition_months(spark, table)
            lost = None
            if gone is not None and there:
                lost_keys = with_month(gone.select(*dict.fromkeys([*keys, day])).filter(F.col(day).isNotNull()), day)
                append(lost_keys.filter(_in_months(there)), staging.gone)  # other months have nothing to lose
                lost = spark.table(staging.gone)
                months |= {row[MONTH] for row in lost.select(MONTH).distinct().collect()}
            # Months the target does not have yet lose nothing if a write breaks off, so they need no merged copy. With
            # change capture they take the same way as the others, which ties the changes to the write.
            present = months if capture_changes else months & there
            absent = months - present
            if absent:
                replace_partitions(staged.filter(_in_months(absent)).hint("rebalance", MONTH), table, keys)
            if present:
                rows = staged.filter(_in_months(present))
                if newer_by is not None:
                    rows = _only_newer(rows, spark.table(table).filter(_in_months(present)), keys, newer_by, staging)
                _merge_months(rows, present, staging, table, keys, capture_changes, lost)
            spark.sql(f"DROP TABLE IF EXISTS {staging.gone}")
        if progress_by:
            noted = created or spark.catalog.tableExists(progress_table(table))
            note_progress(staged if noted else spark.table(table), table, progress_by, day)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging.batch}")
        spark.sql(f"DROP TABLE IF EXISTS {staging.newer}")
    return UpsertResult(created=created, **seen.get)


COMMIT = "_commit"
# What a row of the sides is: of the target and stays, of the target and goes, of the batch.
STATE, KEPT, OLD, NEW = "_state", "kept", "old", "new"


@dataclass(frozen=True)
class _Staging:
    """Names of the tables one upsert works with. The sides and the changes are complete before the merged table appears;
    with change capture that is a mark alone, and what is merged stands in the sides."""

    table: str
    commit: str

    @property
    def batch(self) -> str:
        return f"{self.table}__batch_{self.commit}"

    @property
    def creating(self) -> str:
        return f"{self.table}__creating_{self.commit}"

    @property
    def newer(self) -> str:
        return f"{self.table}__newer_{self.commit}"

    @property
    def gone(self) -> str:
        return f"{self.table}__gone_{self.commit}"

    @property
    def changes(self) -> str:
        return f"{self.table}__changes_{self.commit}"

    @property
    def sides(self) -> str:
        return f"{self.table}__sides_{self.commit}"

    @property
    def merged(self) -> str:
        return f"{self.table}__merged_{self.commit}"


def _new_commit(spark: SparkSession, table: str, captured: bool) -> str:
    """32 hex digits: the number of a captured upsert (from 1, in their order), then chance."""
    done = commits(spark, table) if captured else []
    return f"{version_of(done[-1]) + 1 if done else int(captured):012x}{uuid.uuid4().hex[:20]}"


def _create(batch: DataFrame, staging: _Staging, table: str, keys: Sequence[str]) -> None:
    """Write the new table. Its marker goes when its keys are known to be unique, else the table goes as well."""
    spark = batch.sparkSession
    append(spark.range(0), staging.creating)
    try:
        write_by_month(batch, table, keys)
        _checked_months(spark.table(table), keys)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging.creating}")


def _only_newer(
    rows: DataFrame, target: DataFrame, keys: Sequence[str], newer_by: str, staging: _Staging
) -> DataFrame:
    """The rows that are newer than the target's row of their key, staged since they are read several times."""
    held = target.select(MONTH, *keys, F.col(newer_by).alias("__held"))
    newer = F.col("__held").isNull() | (F.col(newer_by) > F.col("__held"))
    append(rows.join(held, [MONTH, *keys], "left").filter(newer).drop("__held"), staging.newer)
    return rows.sparkSession.table(staging.newer)


def _merge_months(
    staged: DataFrame, months: set[date], staging: _Staging, table: str, keys: Sequence[str], capture_changes: bool,
    gone: DataFrame | None = None,
) -> None:
    spark = staged.sparkSession
    target = spark.table(table).filter(_in_months(months))
    replaced = staged.select(MONTH, *keys)
    if gone is not None:
        replaced = replaced.unionByName(gone.select(MONTH, *keys)).distinct()
    if capture_changes:
        goes = F.when(F.col("__replaced"), F.lit(OLD)).otherwise(F.lit(KEPT))
        there = target.join(replaced.withColumn("__replaced", F.lit(True)), [MONTH, *keys], "left")
        sides = there.withColumn(STATE, goes).drop("__replaced").unionByName(staged.withColumn(STATE, F.lit(NEW)))
        append(sides.hint("rebalance", MONTH), staging.sides, partition_by=[MONTH, STATE])
        sides = spark.table(staging.sides)
        columns = [name for name in target.columns if name not in (MONTH, FETCHED)]
        old, new = (sides.filter(F.col(STATE) == state).select(*columns) for state in (OLD, NEW))
        append(change_feed(old, new, keys).withColumn(COMMIT, F.lit(staging.commit)), staging.changes)
        append(spark.range(0), staging.merged)
    else:
        kept = target.join(replaced, [MONTH, *keys], "left_anti")
        append(kept.unionByName(staged).hint("rebalance", MONTH), staging.merged, partition_by=[MONTH])
    _apply(spark, staging, table, keys)


def _apply(spark: SparkSession, staging: _Staging, table: str, keys: Sequence[str]) -> None:
    if spark.catalog.tableExists(staging.sides):
        rows = spark.table(staging.sides).filter(F.col(STATE) != OLD).drop(STATE)
    else:
        rows = spark.table(staging.merged)
    replace_partitions(rows, table, keys)
    if spark.catalog.tableExists(staging.gone):
        # A month that lost all its rows is in no merged partition, so nothing has replaced it.
        touched = {row[MONTH] for row in spark.table(staging.gone).select(MONTH).distinct().collect()}
        left = {row[MONTH] for row in rows.select(MONTH).distinct().collect()}
        for month in sorted((touched - left) & _partition_months(spark, table)):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = DATE'{month}')")
    if spark.catalog.tableExists(staging.changes):
        changes, feed = spark.table(staging.changes), changes_table(table)
        if spark.catalog.tableExists(feed):
            replace_partitions(changes, feed)
        else:
            append(changes, feed, partition_by=[COMMIT])
    # The merged table goes after what it needs no more: as long as it exists the upsert counts as unfinished.
    spark.sql(f"DROP TABLE IF EXISTS {staging.changes}")
    spark.sql(f"DROP TABLE IF EXISTS {staging.gone}")
    spark.sql(f"DROP TABLE IF EXISTS {staging.merged}")
    spark.sql(f"DROP TABLE IF EXISTS {staging.sides}")


def recover(spark: SparkSession, table: str, keys: Sequence[str] = ()) -> int:
    """Finish upserts that were interrupted after their merged months were complete and drop the staging of the
    others; returns how many were finished. One writer at a time: staging of an upsert that still runs goes as well."""
    database, name = table.rsplit(".", 1)
    # Only names that upserts of this table make; the catalog may have put them in lower case.
    own = re.compile(rf"{re.escape(name)}__(batch|creating|newer|gone|changes|sides|merged)_([0-9a-f]{{32}})", re.IGNORECASE)
    listed = (found.name for found in spark.catalog.listTables(database) if not found.isTemporary)
    left = {found: kind for found in listed if (kind := own.fullmatch(found))}
    finished = [_Staging(table, kind[2]) for kind in left.values() if kind[1].lower() == "merged"]
    if any(kind[1].lower() == "creating" for kind in left.values()):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    for staging in finished:
        _apply(spark, staging, table, keys)
    for found in left:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{found}")
    return len(finished)


@contextmanager
def held(df: DataFrame, table: str) -> Iterator[DataFrame]:
    """A frame that several reads share, kept beside `table` for as long; a crash leaves it to `drop_held`."""
    name = f"{table}__held_{uuid.uuid4().hex}"
    append(df, name)
    try:
        yield df.sparkSession.table(name)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def drop_held(spark: SparkSession, table: str) -> None:
    """Drop what a run that broke off has left beside a table; not while another holds something there."""
    database, name = table.rsplit(".", 1)
    own = re.compile(rf"{re.escape(name)}__held_[0-9a-f]{{32}}", re.IGNORECASE)
    for found in spark.catalog.listTables(database):
        if not found.isTemporary and own.fullmatch(found.name):
            spark.sql(f"DROP TABLE IF EXISTS {database}.{found.name}")


def write_by_month(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Create a month-partitioned table. Rebalancing gives each month few large files and lets AQE split a month that
    is larger than the others."""
    append(_clustered(df.hint("rebalance", MONTH), [MONTH], keys), table, partition_by=[MONTH])


def replace_partitions(df: DataFrame, table: str, keys: Sequence[str] = ()) -> None:
    """Overwrite exactly the partitions the rows fall into."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    with conf_scope(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        _clustered(df.select(*columns), partitions, keys).write.insertInto(table, overwrite=True)


def _clustered(df: DataFrame, partitions: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows ordered by waypoint within each file, so that scans of one role skip the row groups of the others."""
    if not keys:
        return df
    order = sorted(keys, key=lambda name: name != "waypoint_name")
    return df.sortWithinPartitions(*partitions, *order)


def _checked_months(staged: DataFrame, keys: Sequence[str]) -> set[date | None]:
    """The calendar months of a batch (a handful of values, whatever the batch holds); raises if a key repeats.

    A row with a NULL in its key matches nothing, so it is always inserted and never a duplicate.
    """
    complete = reduce(and_, [F.col(name).isNotNull() for name in keys])
    per_key = staged.groupBy(MONTH, *keys).agg(F.count_if(complete).alias("n"))
    per_month = per_key.groupBy(MONTH).agg(F.max("n").alias("n")).collect()
    if any(row.n > 1 for row in per_month):
        raise DuplicateKeysError(f"several rows per key {tuple(keys)} in one batch")
    return {row[MONTH] for row in per_month}


def _in_months(months: set[date | None]) -> Column:
    """Rows of these months; None stands for rows without a date."""
    dated = F.col(MONTH).isin([month for month in months if month is not None])
    return dated | F.col(MONTH).isNull() if None in months else dated


def _partition_months(spark: SparkSession, table: str) -> set[date | None]:
    values = (row.partition.removeprefix(f"{MONTH}=") for row in spark.sql(f"SHOW PARTITIONS {table}").collect())
    return {None if value in ("null", "__HIVE_DEFAULT_PARTITION__") else date.fromisoformat(value) for value in values}


# --- Progress by group ------------------------------------------------------------------------------------------------


def progress_table(table: str) -> str:
    return f"{table}_progress"


def note_progress(rows: DataFrame, table: str, groups: Sequence[str], day: str = "date") -> None:
    """Note the first and last day that these rows add to each group. Notes are only appended, so a run that is repeated
    after a crash adds the same ones again and nothing is ever half replaced."""
    ends = rows.filter(F.col(day).isNotNull()).groupBy(*groups).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    append(ends.coalesce(1), progress_table(table))


def progress(spark: SparkSession, table: str, groups: Sequence[str], day: str = "date") -> DataFrame:
    """One row a group: the first and last day its rows have reached, without reading the table. A table that was never
    noted is scanned once."""
    if not spark.catalog.tableExists(progress_table(table)):
        note_progress(spark.table(table), table, groups, day)
    return spark.table(progress_table(table)).groupBy(*groups).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def table_months(spark: SparkSession, table: str) -> list[date]:
    """The months a table has rows of, as the catalog knows them."""
    return sorted(month for month in _partition_months(spark, table) if month is not None)


# --- Incremental models -----------------------------------------------------------------------------------------------


def refresh_new_dates(
    source: DataFrame, table: str, keys: Sequence[str], model: Callable[[DataFrame], DataFrame],
    ends: DataFrame | None = None,
) -> UpsertResult:
    """Run a per-day model over the source days after the target's latest day and upsert the result.

    Each route has its own latest day: a route that the target lacks runs in full, one that lags from where it stopped. The
    earliest day needed by a route that has new days prunes the read. A missing or empty target means a full run.

    The target's latest days come from its progress notes. `ends` are those of the source (first_day and last_day a
    route); without them its key columns are aggregated.
    """
    spark = source.sparkSession
    routes = [name for name in ("route_id",) if name in source.columns]
    if not spark.catalog.tableExists(table):
        return upsert(model(source), table, keys, progress_by=routes)
    if not routes:
        return upsert(model(since(source, table_max_date(spark, table))), table, keys)
    cutoffs = progress(spark, table, routes).select(*routes, F.col("last_day").alias("latest"))
    open_routes = behind(route_ends(source, routes) if ends is None else ends, cutoffs, routes)
    earliest = open_routes.agg(F.min(F.coalesce("latest", "first_day"))).first()[0]
    if earliest is None:
        return upsert(model(source.limit(0)), table, keys)
    fresh = after_each(since(source, earliest, inclusive=True), cutoffs, routes)
    return upsert(model(fresh), table, keys, progress_by=routes)


# --- Change feed ------------------------------------------------------------------------------------------------------


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes between two states of a keyed table, with _change_type insert, delete, update_preimage or
    update_postimage. Unchanged rows give nothing.

    Keys are unique on both sides, so the join shuffles each row once and no group is large.
    """
    columns = before.columns
    values = [name for name in columns if name not in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*[F.col(c) for c in values]).alias(name))

    pairs = side(before, "old").join(side(after, "new"), list(keys), "full_outer")
    # Two spellings of "no row": the struct is NULL only where the side had no row, whatever its values are.
    gone, fresh = F.col("new").isNull(), F.col("old").isNull()

    def change(kind: str, image: Column) -> Column:
        return F.struct(F.lit(kind).alias("_change_type"), image.alias("image"))

    old, new = F.col("old"), F.col("new")
    changes = (
        F.when(fresh, F.array(change("insert", new)))
        .when(gone, F.array(change("delete", old)))
        .otherwise(F.array(change("update_preimage", old), change("update_postimage", new)))
    )
    return (
        pairs.filter(~old.eqNullSafe(new))
        .select(*keys, F.inline(changes))
        .select(*[F.col(c) if c in keys else F.col(f"image.{c}") for c in columns], "_change_type")
    )


# --- The kept changes of a table --------------------------------------------------------------------------------------


def changes_table(table: str) -> str:
    return f"{table}_changes"


def version_of(commit: str) -> int:
    """The number of a captured upsert, which its name begins with."""
    return int(commit[:12], 16)


def commits(spark: SparkSession, table: str) -> list[str]:
    """The captured upserts of a table in their order; the catalog knows them, no rows are read."""
    if not spark.catalog.tableExists(changes_table(table)):
        return []
    parts = spark.sql(f"SHOW PARTITIONS {changes_table(table)}").collect()
    return sorted(row.partition.removeprefix(f"{COMMIT}=") for row in parts)


def version(spark: SparkSession, table: str) -> int:
    """How many captured upserts have followed the first one."""
    done = commits(spark, table)
    return version_of(done[-1]) if done else 0


def changes_between(spark: SparkSession, table: str, after: int, until: int | None = None) -> DataFrame:
    """Row changes of the versions after `after` up to `until`, with the column `version`. Only the partitions of these
    upserts are read."""
    chosen = [x for x in commits(spark, table) if after < version_of(x) and (until is None or version_of(x) <= until)]
    changes = spark.table(changes_table(table)).filter(F.col(COMMIT).isin(chosen))
    return changes.withColumn("version", F.conv(F.substring(COMMIT, 1, 12), 16, 10).cast("bigint")).drop(COMMIT)


def net_changes(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What several versions add up to: of each key the image before its first change and the one after its last. Images
    that came and went in between are left out."""
    of_key = Window.partitionBy(*keys)
    ends = changes.withColumns({"__first": F.min("version").over(of_key), "__last": F.max("version").over(of_key)})
    old, new = (F.col("_change_type").isin(*kinds) for kinds in (("delete", "update_preimage"), ("insert", "update_postimage")))
    return ends.filter((old & (F.col("version") == F.col("__first"))) | (new & (F.col("version") == F.col("__last")))).drop(
        "__first", "__last")


def as_of(spark: SparkSession, table: str, keys: Sequence[str], at: int) -> DataFrame:
    """The rows of a table as they were at a version (0: after the first upsert), from its rows and its kept changes.

    The first change of a key after that version says what was there: nothing before an insert, the old image before an
    update or a deletion. Only the changes since then are read and ranked (one row a key after the limit), and the
    table is read once. Rows with a NULL in their key have no changes of their own and count as they are now.
    """
    current = spark.table(table).drop(MONTH, FETCHED)
    if at >= version(spark, table):
        return current
    old = changes_between(spark, table, at).filter(F.col("_change_type") != "update_postimage")
    first = Window.partitionBy(*keys).orderBy("version")
    old = old.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") == 1)
    restored = old.filter(F.col("_change_type") != "insert").select(*current.columns)
    return current.join(old.select(*keys), list(keys), "left_anti").unionByName(restored)


def validity(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Every state every row has had, with valid_from (the version that brought it; null: the first upsert) and valid_to
    (the version that ended it; null: it still holds). A key's group is as large as it has had changes."""
    current = spark.table(table).drop(MONTH, FETCHED)
    columns = current.columns
    if not commits(spark, table):
        return current.withColumns({name: F.lit(None).cast("bigint") for name in ("valid_from", "valid_to")})
    changes = changes_between(spark, table, 0)
    begins = F.col("_change_type").isin("insert", "update_postimage")
    events = changes.select(
        *columns, F.when(begins, F.col("version")).alias("begun"), (~begins).alias("is_state"), "version"
    ).unionByName(current.withColumns({
        "begun": F.lit(None).cast("bigint"), "is_state": F.lit(True), "version": F.lit(None).cast("bigint")}))
    # Within a version the old image ends before the new one begins; what holds now ends last.
    before = Window.partitionBy(*keys).orderBy(F.col("version").asc_nulls_last(), F.col("is_state").desc()).rowsBetween(
        Window.unboundedPreceding, -1)
    states = events.withColumn("valid_from", F.last("begun", ignorenulls=True).over(before)).filter("is_state")
    return states.select(*columns, "valid_from", F.col("version").alias("valid_to"))

"""Time-series profiles of a table and their drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRANULARITIES = {"1 day": "DD", "1 month": "MM"}
QUARTILES = (0.25, 0.5, 0.75)
# Rounding of the floating-point metrics; the nudge keeps exact ties from depending on the last bit.
DIGITS, NUDGE = 4, 1e-9


def _rounded(x: Column) -> Column:
    return F.round(x + F.signum(x) * NUDGE, DIGITS)


def _window_start(column: str, granularity: str) -> Column:
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {tuple(GRANULARITIES)}, not {granularity!r}")
    day = F.col(column).cast("date")
    return (day if granularity == "1 day" else F.trunc(day, GRANULARITIES[granularity])).alias("window_start")


def _unpivot(wide: DataFrame, columns: Sequence[str], metrics: Sequence[str], granularity: str) -> DataFrame:
    rows = F.array(*[
        F.struct(F.lit(name).alias("column_name"), *[F.col(f"{name}__{m}").alias(m) for m in metrics])
        for name in columns
    ])
    return wide.select("window_start", F.lit(granularity).alias("granularity"), F.inline(rows))


def profile(df: DataFrame, columns: Sequence[str], granularity: str, time_column: str = "date") -> DataFrame:
    """Per time window and column: row count, nulls, minimum, maximum, mean, standard deviation.

    All columns are profiled in one aggregate whose partial sums are built before the shuffle, so a window that holds
    a large share of the rows sends one row per map task.
    """
    aggregates = []
    for name in columns:
        x = F.col(name).cast("double")
        aggregates += [
            F.count(F.lit(1)).alias(f"{name}__n_rows"),
            F.count_if(F.col(name).isNull()).alias(f"{name}__n_nulls"),
            F.min(x).alias(f"{name}__minimum"),
            F.max(x).alias(f"{name}__maximum"),
            _rounded(F.avg(x)).alias(f"{name}__mean"),
            _rounded(F.stddev_samp(x)).alias(f"{name}__stddev"),
        ]
    wide = df.groupBy(_window_start(time_column, granularity)).agg(*aggregates)
    metrics = ("n_rows", "n_nulls", "minimum", "maximum", "mean", "stddev")
    return _unpivot(wide, columns, metrics, granularity)


def profile_sketches(df: DataFrame, columns: Sequence[str], granularity: str, time_column: str = "date") -> DataFrame:
    """Per time window and column: approximate distinct count and quartiles, from mergeable sketches."""
    aggregates = []
    for name in columns:
        aggregates += [
            F.approx_count_distinct(name).alias(f"{name}__approx_distinct"),
            F.percentile_approx(F.col(name).cast("double"), list(QUARTILES)).alias(f"{name}__quartiles"),
        ]
    wide = df.groupBy(_window_start(time_column, granularity)).agg(*aggregates)
    return _unpivot(wide, columns, ("approx_distinct", "quartiles"), granularity)


def drift(profiles: DataFrame, metrics: Sequence[str] = ("n_rows", "n_nulls", "mean", "stddev")) -> DataFrame:
    """Change of each metric against the previous window of the same column; NULL for the first window.

    The input has one row per window and column, so a group is bounded by the length of the record.
    """
    previous = Window.partitionBy("granularity", "column_name").orderBy("window_start")
    changes = [(F.col(m) - F.lag(m).over(previous)) for m in metrics]
    named = [
        (_rounded(x) if m in ("mean", "stddev") else x).alias(f"{m}_change")
        for m, x in zip(metrics, changes, strict=True)
    ]
    return profiles.select("granularity", "column_name", "window_start", *named)


# --- Stored sketches --------------------------------------------------------------------------------------------------

# KLL keeps about 3 k values a sketch; a rank read from it is off by at most 2.296 / k^0.9021 of the rows in 99 of 100
# sketches (the published fit). Three times that is held as the bound here. A theta sketch of 2^n values is exact up to
# that many distinct values and has a relative standard error of 1 / sqrt(2^n - 1) beyond; its bound here is four of them.
KLL_K = 1024
THETA_LOG = 12
RANK_ERROR = 3 * 2.296 / KLL_K**0.9021
DISTINCT_ERROR = 4 / (2**THETA_LOG - 1) ** 0.5


def day_sketches(df: DataFrame, columns: Sequence[str], time_column: str = "date") -> DataFrame:
    """window_start (a day), column_name, n_rows, n_nulls, quantiles (KLL sketch), distinct (theta sketch): what is stored,
    so that coarser windows are merged from it without another look at the rows."""
    aggregates = []
    for name in columns:
        x = F.col(name).cast("double")
        aggregates += [
            F.count(F.lit(1)).alias(f"{name}__n_rows"),
            F.count_if(F.col(name).isNull()).alias(f"{name}__n_nulls"),
            F.kll_sketch_agg_double(x, KLL_K).alias(f"{name}__quantiles"),
            F.theta_sketch_agg(x, THETA_LOG).alias(f"{name}__distinct"),
        ]
    wide = df.groupBy(_window_start(time_column, "1 day")).agg(*aggregates)
    return _unpivot(wide, columns, ("n_rows", "n_nulls", "quantiles", "distinct"), "1 day").drop("granularity")


def roll_up(sketches: DataFrame, granularity: str) -> DataFrame:
    """Stored sketches merged to coarser windows: partial merges before the shuffle, a row a day and column at most."""
    return sketches.groupBy(_window_start("window_start", granularity), "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("quantiles"), F.theta_union_agg("distinct", THETA_LOG).alias("distinct"),
    ).withColumn("granularity", F.lit(granularity))


def sketched_metrics(sketches: DataFrame) -> DataFrame:
    """quartiles and approx_distinct of stored or merged sketches (null where all values are)."""
    some = F.col("n_rows") > F.col("n_nulls")
    quartiles = F.array(*[F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(q))) for q in QUARTILES])
    return sketches.withColumns({
        "quartiles": F.when(some, quartiles), "approx_distinct": F.theta_sketch_estimate("distinct"),
    }).drop("quantiles", "distinct")


def within_bounds(metrics: DataFrame, df: DataFrame, columns: Sequence[str], granularity: str,
                  time_column: str = "date") -> DataFrame:
    """Whether sketched metrics are inside their bounds, judged by all rows: window_start, column_name, n_distinct,
    distinct_ok, quartiles_ok. A quartile's true rank runs from the share of smaller values to that of values not larger.
    """
    values = df.select(_window_start(time_column, granularity), F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast("double").alias("value")) for name in columns])))
    keys = ["window_start", "column_name"]
    counted = values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n")).join(
        metrics.select(*keys, "quartiles", "approx_distinct"), keys)
    ranks = [F.sum(F.when(F.col("value") < F.col("quartiles")[k], F.col("n")).otherwise(0)).alias(f"below_{k}")
             for k in range(len(QUARTILES))]
    ranks += [F.sum(F.when(F.col("value") <= F.col("quartiles")[k], F.col("n")).otherwise(0)).alias(f"upto_{k}")
              for k in range(len(QUARTILES))]
    judged = counted.groupBy(*keys).agg(
        F.count("value").alias("n_distinct"), F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n"),
        F.first("approx_distinct").alias("approx_distinct"), *ranks)
    ok = F.lit(True)
    for k, q in enumerate(QUARTILES):
        ok = ok & (F.col(f"below_{k}") <= (q + RANK_ERROR) * F.col("n")) & (F.col(f"upto_{k}") >= (q - RANK_ERROR) * F.col("n"))
    off = F.abs(F.col("approx_distinct") - F.col("n_distinct"))
    return judged.select(*keys, "n_distinct", (off <= DISTINCT_ERROR * F.col("n_distinct")).alias("distinct_ok"),
                         ok.alias("quartiles_ok"))


# --- Drift of distributions -------------------------------------------------------------------------------------------

BINS = 20


def histograms(df: DataFrame, ranges: Mapping[str, tuple], granularity: str, time_column: str = "date",
               bins: int = BINS) -> DataFrame:
    """Counts per window, column and bin. The bins of a column are the same in all windows: equal parts of its range, 0 for
    values below and bins + 1 for those above; NULL has none. Whole-number arithmetic on hundredths decides the bin.

    Each value becomes hundredths once and a row of its own; the bin is one expression on these rows, not one a column, so
    that the code stays small enough to be compiled.
    """
    names = list(ranges)
    lows, highs = ([int(ranges[name][k] * 100) for name in names] for k in (0, 1))

    def of_place(values: Sequence, kind: str) -> Column:
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("place") + 1)

    cents = F.array(*[(F.col(name) * 100).cast("bigint") for name in names])
    rows = df.select(_window_start(time_column, granularity), F.posexplode(cents).alias("place", "cents"))
    rows = rows.filter(F.col("cents").isNotNull()).withColumns({
        "low": of_place(lows, "bigint"), "high": of_place(highs, "bigint")})
    inner = F.least(F.expr(f"((cents - low) * {bins}) div (high - low)"), F.lit(bins - 1)) + 1
    place = F.when(F.col("cents") < F.col("low"), F.lit(0)).when(F.col("cents") > F.col("high"), F.lit(bins + 1)).otherwise(inner)
    counts = rows.groupBy("window_start", "place", place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("window_start", of_place(names, "string").alias("column_name"), "bin", "n")


def drift_distribution(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """Distance of each window's histogram to the one before it: population stability index (shares smoothed by half a
    value a bin) and the Kolmogorov-Smirnov distance of the binned distributions; NULL for the first window.

    Histograms are bounded by the bins, so windows carry one row each; a group has a row a window of a column.
    """
    size = bins + 2
    held = counts.groupBy("window_start", "column_name").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("held"), F.sum("n").alias("n"))
    dense = held.withColumn("counts", F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)), lambda b: F.coalesce(F.element_at("held", b), F.lit(0)))).drop("held")
    previous = Window.partitionBy("column_name").orderBy("window_start")
    pairs = dense.withColumns({"old": F.lag("counts").over(previous), "old_n": F.lag("n").over(previous)})

    def share(count: Column, n: Column) -> Column:
        return (count + 0.5) / (n + 0.5 * size)

    both = F.arrays_zip(F.col("counts").alias("new"), F.col("old").alias("old"))
    steps = F.transform(both, lambda x: (share(x["new"], F.col("n")) - share(x["old"], F.col("old_n"))) * F.log(
        share(x["new"], F.col("n")) / share(x["old"], F.col("old_n"))))
    # The running totals of both; their largest distance is looked at bin by bin.
    start = F.struct(F.lit(0).cast("bigint").alias("new"), F.lit(0).cast("bigint").alias("old"), F.lit(0.0).alias("most"))
    walked = F.aggregate(both, start, lambda at, x: F.struct(
        (at["new"] + x["new"]).alias("new"), (at["old"] + x["old"]).alias("old"),
        F.greatest(at["most"], F.abs((at["new"] + x["new"]) / F.col("n") - (at["old"] + x["old"]) / F.col("old_n"))).alias("most")))
    known = F.col("old_n").isNotNull()
    return pairs.select(
        "column_name", "window_start", "n",
        F.when(known, _rounded(F.aggregate(steps, F.lit(0.0), lambda total, x: total + x))).alias("psi"),
        F.when(known, _rounded(walked["most"])).alias("ks"))

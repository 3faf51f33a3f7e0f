"""Mixing sources to target weights by Poisson replication.

The rate of a source is its share of the target volume over its own volume. A document's number of copies is drawn by
inverting the Poisson distribution of its source's rate at a number in (0, 1) hashed from seed and id, so it depends on
nothing but the two and a rerun gives the same copies. Rates over `PART` are drawn as the sum of equal parts with a hash
each (exp(-rate) would vanish otherwise). Copies are put in the order of a hash of seed, id and copy number.

A null source is a source of its own; rows of one id get as many copies each; a null id counts as the empty text; null
texts have no volume. Without volume in a source (or in all) its rate is 0. Other columns stay; those of the operator
(`copy`, `copies`, `order_key`) replace columns so named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpenglow.llm.common import partitions, written

#: Largest mean that one inversion draws.
PART = 16.0
#: Terms of the distribution behind its mean; what is left is below 1e-17.
TAIL = 80
#: Sources whose rates every task is given.
SOURCES = 10_000


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of the MD5 of seed and parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *parts)
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") + 0.5) / F.lit(float(2**52))


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, source: str = "source",
          text: str = "text") -> DataFrame:
    """source, rate: mean copies of a document of the source, for `epochs` times the corpus' characters in all.

    `weights` are relative shares by source (missing: 0); without them all sources weigh the same.
    """
    sizes = written(docs.groupBy(source).agg(F.sum(F.coalesce(F.char_length(text), F.lit(0))).alias("__size")))
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col(source).eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("__weight", F.when(F.col("__size") > 0, weight).otherwise(F.lit(0.0)))
    total = sizes.agg(F.sum("__size").alias("size"), F.sum("__weight").alias("weight")).first()  # two numbers
    if not total["weight"]:
        return sizes.select(source, F.lit(0.0).alias("__rate"))
    share = F.col("__weight") / F.lit(float(total["weight"]))
    volume = F.lit(float(epochs)) * F.lit(float(total["size"]))
    return sizes.select(source, F.when(F.col("__size") > 0, share * volume / F.col("__size")).otherwise(0.0).alias("__rate"))


def cumulative(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, ..., TAIL terms past the mean."""
    terms = F.sequence(F.lit(1), F.ceil(rate).cast("int") + TAIL)
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("all"))

    def add(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), (state["sum"] + p).alias("sum"), F.concat(state["all"], F.array(state["sum"] + p)).alias("all"))

    return F.aggregate(terms, start, add, lambda state: state["all"])


def replicate(docs: DataFrame, weights: dict[str | None, float] | None = None, epochs: float = 1.0, seed: int = 0,
              doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Each document as often as drawn (columns copy from 1, copies, order_key), ordered by order_key within and across partitions."""
    docs = docs.drop("copy", "copies", "order_key")
    mean = rates(docs, weights, epochs, source, text)
    parts = F.greatest(F.ceil(F.col("__rate") / PART).cast("int"), F.lit(1))
    mean = mean.select(F.col(source).alias("__source"), parts.alias("__parts"), cumulative(F.col("__rate") / parts).alias("__cdf"))
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("__parts")), F.lit(0),
        lambda total, k: total + F.size(F.filter("__cdf", lambda c: c < uniform(seed, key, k.cast("string")))),
    )
    if mean.count() <= SOURCES:
        mean = F.broadcast(mean)  # a row of at most SOURCES rates; with more, the join shuffles
    out = docs.join(mean, F.col(source).eqNullSafe(F.col("__source"))).withColumn("copies", drawn)
    out = out.drop("__source", "__parts", "__cdf").filter("copies > 0")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    order = F.md5(F.concat_ws(":", F.lit(f"order{seed}"), key, F.col("copy").cast("string")).cast("binary"))
    # The keys are uniform, so equal parts of their range are equal parts of the rows and need no sampling.
    n = partitions(docs.sparkSession)
    part = F.floor(F.conv(F.substring("order_key", 1, 8), 16, 10).cast("bigint") * n / 2**32).cast("int")
    return out.withColumn("order_key", order).repartitionById(n, part).sortWithinPartitions("order_key")

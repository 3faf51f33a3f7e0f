"""Exact top-k inner products by pivot tables.

Vectors are lengthened by one coordinate that makes all of one length, and queries by a zero, so that the largest inner
product is the smallest distance. Every vector has its distances to PIVOTS pivots; the triangle inequality bounds a
query's distance to a vector from below by the largest difference of their pivot distances, hence the inner product from
above. Vectors are stored in cells by nearest pivot, cut into parts of PART rows, and a part keeps the least and largest
of each pivot distance, so the same bound first serves for the part as a whole. These ranges are a table as well; queries
are routed by RANGES parts at a time, so neither the driver nor a task ever holds the ranges of all parts.

Round 1 sends each query to the FIRST parts of the best bounds, which gives a k-th score to beat. Round 2 sends it to
every other part whose bound does not fall short of that score. Inside a part a block of queries meets the vectors in the
order of their bounds, STEP at a time: pairs whose bound falls short of the query's k-th best score so far are out, the
others are one matrix product, and the block ends where no bound left reaches any of its queries. Nothing else is left out,
so the result is exact whatever the pivots are (they are a sample of PIVOTS vectors by the hash of their ids).

Every row whose id is divisible is a query of its own, and every other row a candidate, so repeated ids and repeated rows
count each as they stand; ties go to the smaller id. Vectors that are null or hold null or non-finite components take no
part; vectors of different length never meet; a null id is never a query and is no candidate. Scores are long integers:
products that could pass 2**53 are taken with Python integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alpenglow.llm.common import partitions, written

PIVOTS = 32
PART = 4096
FIRST = 2
STEP = 512
#: Queries that meet a part's vectors at once, and those of one group of a shuffle.
BLOCK, GROUP = 128, 16_384
#: Parts whose ranges a routing step holds.
RANGES = 8192
SCALE = 64
#: Slack of the bounds against rounding (of single precision), as a share of the squared length.
SLACK = 1e-6
NONE = np.iinfo(np.int64).min


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, v: floor(SCALE * x) of each component, of usable vectors."""
    frame = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e")).filter("vec_id IS NOT NULL AND e IS NOT NULL")
    frame = frame.filter(F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    return frame.select("vec_id", F.transform("e", lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def _matrix(lists) -> np.ndarray:
    return np.array(lists.tolist(), dtype=np.int64).reshape(len(lists), -1)


def _column(rows) -> pd.Series:
    return pd.Series(list(rows), dtype=object)


def _pivot_distances(x: np.ndarray, pivots: np.ndarray, pivot_tail: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Distances of lengthened vectors to lengthened pivots."""
    own, theirs = (x * x).sum(axis=1) + tail**2, (pivots * pivots).sum(axis=1) + pivot_tail**2
    return np.sqrt(np.maximum(own[:, None] + theirs - 2 * (x @ pivots.T + np.outer(tail, pivot_tail)), 0))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, x.shape[-1])
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return np.array((q.astype(object) @ x.astype(object).T).tolist(), dtype=np.int64).reshape(len(q), len(x))


def _largest_gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The largest difference of pivot distances of each pair, in tiles that stay in the cache."""
    a, b = a.astype(np.float32), np.ascontiguousarray(b.T, np.float32)
    out = np.zeros((len(a), b.shape[1]), np.float32)
    for at in range(0, b.shape[1], 256):
        tile = out[:, at : at + 256]
        for j in range(len(b)):
            np.maximum(tile, np.abs(a[:, j, None] - b[j, at : at + 256]), out=tile)
    return out


def _best(q_rows, q, q_dist, floor, x_rows, x_ids, x, x_dist, top, k) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places (query, vector) and scores of each query's k best in a part, and how many products it took."""
    found, taken = [(np.zeros(0, np.int64),) * 3], 0
    norms = (q.astype(float) ** 2).sum(axis=1)
    for start in range(0, len(q), BLOCK):
        some = slice(start, start + BLOCK)
        gap = _largest_gaps(q_dist[some], x_dist)
        bound = (norms[some, None] + top - gap.astype(np.float64) ** 2) / 2 + SLACK * (top + norms[some, None]) + 1e-3
        beat = floor[some].copy()
        best = bound.max(axis=0)
        order = np.argsort(-best, kind="stable")
        own, place, score = (np.zeros(0, np.int64) for _ in range(3))
        for at in range(0, len(order), STEP):
            chosen = order[at : at + STEP]
            if best[chosen[0]] < beat.min():
                break  # in order: nothing that follows reaches any query
            open_pairs = bound[:, chosen] >= beat[:, None]
            rows = np.flatnonzero(open_pairs.any(axis=1))
            product = _products(q[some][rows], x[chosen])
            taken += product.size
            good = open_pairs[rows] & (product >= beat[rows, None]) & (x_rows[chosen] != q_rows[some][rows, None])
            a, b = np.nonzero(good)
            own, place, score = np.append(own, rows[a]), np.append(place, chosen[b]), np.append(score, product[a, b])
            keep = np.lexsort((x_rows[place], x_ids[place], -score, own))
            first = np.searchsorted(own[keep], np.arange(len(beat)))
            keep = keep[np.arange(len(keep)) - first[own[keep]] < k]
            own, place, score = own[keep], place[keep], score[keep]
            count = np.bincount(own, minlength=len(beat))
            full = np.flatnonzero(count == k)
            last = np.cumsum(count) - 1
            beat[full] = np.maximum(beat[full], score[last[full]])
        found.append((own + start, place, score))
    return (*(np.concatenate([x[j] for x in found]) for j in range(3)), taken)


def search(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score for the quantised vectors whose id is divisible by `every`, against all other rows."""
    base = written(vectors.withColumns({"dim": F.size("v"), "row": F.monotonically_increasing_id()}))  # rows keep their numbers
    results = None
    for dim in sorted(r["dim"] for r in base.select("dim").distinct().collect()):  # one space for each length
        found = _search_space(base.filter(F.col("dim") == dim).drop("dim"), k, every)
        results = found if results is None else results.unionByName(found)
    if results is None:
        return base.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return results


def _range_blocks(ranges: DataFrame) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Names, least and largest pivot distances of RANGES parts at a time."""
    held: list = []
    for row in ranges.toLocalIterator():
        held.append(row)
        if len(held) == RANGES:
            yield [r["part"] for r in held], *(np.array([r[x] for r in held]) for x in ("low", "high"))
            held = []
    if held:
        yield [r["part"] for r in held], *(np.array([r[x] for r in held]) for x in ("low", "high"))


def _search_space(base: DataFrame, k: int, every: int) -> DataFrame:
    n = partitions(base.sparkSession)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    top = float(base.agg(F.max(square)).first()[0] or 0.0)
    sample = base.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(PIVOTS).collect()
    pivots = np.array([r["v"] for r in sample], dtype=np.float64).reshape(len(sample), -1)
    pivot_tail = np.sqrt(np.maximum(top - (pivots**2).sum(axis=1), 0))

    def placed(batches):
        for batch in batches:
            for at in range(0, len(batch), PART):
                some = batch.iloc[at : at + PART]
                x = _matrix(some["v"]).astype(np.float64)
                d = _pivot_distances(x, pivots, pivot_tail, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0)))
                yield pd.DataFrame({"row": some["row"].to_numpy(), "vec_id": some["vec_id"].to_numpy(), "v": _column(some["v"]),
                                    "d": _column(d), "cell": d.argmin(axis=1)})

    cells = written(base.repartition(n).mapInPandas(placed, "row bigint, vec_id bigint, v array<bigint>, d array<double>, cell int"))
    sizes = {r["cell"]: r["count"] for r in cells.groupBy("cell").count().collect()}  # a row for each pivot at most
    parts_of = F.coalesce(*(F.when(F.col("cell") == c, F.lit(-(-s // PART))) for c, s in sizes.items()))
    parts = cells.withColumn("part", F.concat_ws("-", "cell", F.pmod(F.xxhash64("row", F.lit(7)), parts_of)))
    parts = written(parts.drop("cell"))
    ranges = written(parts.groupBy("part").agg(*(
        F.array(*(f(F.col("d")[j]) for j in range(len(sample)))).alias(name) for name, f in (("low", F.min), ("high", F.max)))))

    def route(names: list[str], low: np.ndarray, high: np.ndarray, second: bool):
        def bounds(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Upper bounds of a query's products with each part's vectors, and its pivot distances."""
            d = _pivot_distances(v, pivots, pivot_tail, np.zeros(len(v)))
            gap = np.zeros((len(v), len(names)))
            for j in range(len(sample)):
                np.maximum(gap, np.maximum(low[:, j] - d[:, j, None], d[:, j, None] - high[:, j]), out=gap)
            norms = (v * v).sum(axis=1)[:, None]
            return (norms + top - gap**2) / 2 + SLACK * (top + norms) + 1e-3, d

        def run(batches):
            for batch in batches:
                for at in range(0, len(batch), 500):
                    some = batch.iloc[at : at + 500].reset_index(drop=True)
                    bound, d = bounds(_matrix(some["v"]).astype(np.float64))
                    if second:
                        wanted = bound >= some["floor"].to_numpy(dtype=float)[:, None]
                        beat = some["floor"].to_numpy(np.int64)
                    else:
                        beat, wanted = np.full(len(some), NONE), np.zeros(bound.shape, bool)
                        np.put_along_axis(wanted, np.argsort(-bound, axis=1, kind="stable")[:, :FIRST], True, axis=1)
                    q, place = np.nonzero(wanted)
                    yield pd.DataFrame({"part": _column(names[x] for x in place), "query": some["row"].to_numpy()[q],
                                        "query_id": some["query_id"].to_numpy()[q], "v": _column(some["v"].to_numpy()[q]), "d": _column(d[q]),
                                        "floor": beat[q], "bound": bound[q, place]})
        return run

    def evaluate(_, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({x: [] for x in ("query", "query_id", "row", "vec_id", "score")}).astype("int64")
        ids, own = rows["vec_id"].to_numpy(), rows["row"].to_numpy()
        a, b, score, _ = _best(queries["query"].to_numpy(), _matrix(queries["v"]), np.array(queries["d"].tolist()), queries["floor"].to_numpy(np.int64),
                               own, ids, _matrix(rows["v"]), np.array(rows["d"].tolist()), top, k)
        return pd.DataFrame({"query": queries["query"].to_numpy()[a], "query_id": queries["query_id"].to_numpy()[a], "row": own[b], "vec_id": ids[b],
                             "score": score})

    routed = "part string, query bigint, query_id bigint, v array<bigint>, d array<double>, floor bigint, bound double"
    result = "query bigint, query_id bigint, row bigint, vec_id bigint, score bigint"
    queries = base.filter(F.col("vec_id") % every == 0).select("row", F.col("vec_id").alias("query_id"), "v")
    blocks = max(1, -(-queries.count() // GROUP))

    def sent(frame: DataFrame, second: bool) -> DataFrame:
        found = None
        for names, low, high in _range_blocks(ranges):
            more = frame.mapInPandas(route(names, low, high, second), routed)
            found = more if found is None else found.unionByName(more)
        return found

    def met(to_parts: DataFrame) -> DataFrame:
        """A part's vectors meet the queries sent to it, in groups of bounded size."""
        to_parts = to_parts.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
        rows = parts.withColumn("block", F.lit(0))
        if blocks > 1:
            rows = parts.join(to_parts.select(*(F.col(x).alias(x) for x in ("part", "block"))).distinct(), "part")
        return to_parts.groupBy("part", "block").cogroup(rows.groupBy("part", "block")).applyInPandas(evaluate, result)

    by_bound = Window.partitionBy("query").orderBy(F.desc("bound"), "part")
    start = sent(queries, False).withColumn("__n", F.row_number().over(by_bound)).filter(F.col("__n") <= FIRST).drop("__n")
    start = written(start)
    first = written(met(start))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    kth = first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("floor"))
    open_queries = queries.join(kth, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(NONE)))
    rest = sent(open_queries, True).join(start.select("query", "part"), ["query", "part"], "left_anti")
    ranked = first.unionByName(met(rest)).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

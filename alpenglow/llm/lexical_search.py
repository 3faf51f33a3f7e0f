"""Ranked lexical search over an index whose documents are grouped by equal length normaliser.

1. Items (the stated query set) become their distinct terms. They are taken in blocks of at most BLOCK_TERMS terms (or one
   item), read one after the other, so what a task is given is bounded; every block meets all documents.
2. Index. Every block of about INDEX_BYTES of text becomes one row: for each term of the items its postings, ordered by the
   documents' lengths, with the number of documents and terms. The rows are written to the shared folder.
3. Statistics are sums over the rows: documents and terms of the corpus, and in how many documents each term is.
4. Search. With the statistics every document has its normaliser m; documents of one m are a stratum. Postings of a term are
   lists by stratum and, within it, by tf, so that an impact is computed once for each (term, stratum, tf). A stratum's bound
   for an item is the sum of the impacts at its terms' greatest tf. Strata are visited in descending order of their bounds,
   until the bound is below the k-th best score; the rest cannot reach it.
5. Each block's best k of each item meet in one shuffle, limited to k before and after.

A block of documents is a slice of the input whatever their lengths or sources are, so no stratum, term or source gathers in
one task. All numbers are 64-bit integers, but for the terms' weights.

Null and empty texts, and those without a term, are in no result and not counted. Documents without an id rank after those of
the same score with one. Repeated documents are documents of their own, and repeated items items of their own. An item
without terms, or none of whose terms occurs, has no row; nor has any in an empty corpus. Other columns take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alpenglow.llm.common import chunks, encoded, packed, unpacked, written
from alpenglow.llm.words import ranges, word_codes, words

#: Distinct (item, term) pairs of a block of items.
BLOCK_TERMS = 200_000
#: Text of a block of documents.
INDEX_BYTES = 16_000_000
#: Share of the normaliser that grows with the length, in hundredths.
SLOPE = 50


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, terms: each item's distinct terms."""
    items = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch):
                terms = pa.array([sorted(set(words(x))) for x in encoded(piece.column(1))], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([piece.column(0), terms], names=["item_id", "terms"])

    return items.mapInArrow(run, f"item_id {items.schema['item_id'].dataType.simpleString()}, terms array<binary>")


def item_blocks(items: DataFrame, size: int = BLOCK_TERMS) -> Iterator[list[tuple]]:
    """Items with terms, as lists of (item_id, terms) with at most `size` terms (or one item) at a time."""
    held, count = [], 0
    for row in items.filter(F.size("terms") > 0).toLocalIterator():
        if held and count + len(row["terms"]) > size:
            yield held
            held, count = [], 0
        held.append((row["item_id"], [bytes(x) for x in row["terms"]]))
        count += len(row["terms"])
    if held:
        yield held


def index(docs: DataFrame, terms: list[bytes], doc_id: str = "doc_id", text: str = "text", size: int = INDEX_BYTES) -> DataFrame:
    """One row for each block of documents: n_docs, n_terms; held, df: numbers of the terms (from 1) that occur and in how many
    documents; doc_id: documents that hold one; postings (packed): length of each document, and document and tf of each
    posting, ordered by term and length."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = {x: k for k, x in enumerate(terms, 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in chunks(batch, limit=size):
                found = [word_codes(encoded(piece.column(1)), known) for piece in chunks(block)]
                code, n = (np.concatenate([x[k] for x in found]) for k in (0, 1))
                doc = np.repeat(np.arange(len(n)), n)[code > 0]
                order = np.argsort(n, kind="stable")  # documents numbered by length, so that one sort orders the postings
                place = np.empty(len(n), np.int64)
                place[order] = np.arange(len(n))
                key, tf = np.unique(code[code > 0].astype(np.int64) * len(n) + place[doc], return_counts=True)
                term, doc = key // len(n), key % len(n)
                held, df = np.unique(term, return_counts=True)
                used, doc = np.unique(doc, return_inverse=True)
                kept = order[used]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int((n > 0).sum())]), pa.array([int(n.sum())]), pa.array([held.astype(np.int32)]), pa.array([df]),
                     pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), block.column(0).take(pa.array(kept))),
                     pa.array([packed(n[kept].astype(np.int64), doc.astype(np.int32), tf.astype(np.int32))], pa.binary())],
                    names=["n_docs", "n_terms", "held", "df", "doc_id", "postings"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"n_docs bigint, n_terms bigint, held array<int>, df array<bigint>, doc_id array<{kind}>, postings binary")


def weights(indexed: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, their terms with repeats, and each term's weight by its number: as many rows as a block of items has terms."""
    total = indexed.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, length = total[0] or 0, total[1] or 0
    counts = indexed.select(F.explode(F.arrays_zip("held", "df")).alias("x")).groupBy("x.held").agg(F.sum("x.df").alias("df")).collect()
    weight = np.zeros(n_terms + 1, np.int64)
    for row in counts:
        weight[row["held"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * row["df"] + 1)))
    return n, length, weight


class Strata:
    """The postings of one block of documents by term, stratum and tf, with each list's impact."""

    def __init__(self, length: np.ndarray, held: np.ndarray, df: np.ndarray, doc: np.ndarray, tf: np.ndarray, n: int, total: int, weight: np.ndarray):
        normaliser = 100 - SLOPE + (SLOPE * length * n) // total
        values, stratum = np.unique(normaliser, return_inverse=True)
        term = np.repeat(held, df).astype(np.int64)
        tf = tf.astype(np.int64)
        order = np.lexsort((-tf, term * len(values) + stratum[doc]))  # greatest tf first
        self.doc, tf, term = doc[order], tf[order], term[order]
        here = stratum[self.doc]
        group = term * len(values) + here
        listed = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(tf, prepend=-1) != 0))
        impact = weight[term[listed]] * ((10**9 * tf[listed]) // (1000 * tf[listed] + 20 * values[here[listed]]))
        self.impact = np.repeat(impact, np.diff(listed, append=len(tf)))
        self.begin = np.flatnonzero(np.diff(group, prepend=-1))  # one list of lists a term and stratum
        self.size = np.diff(self.begin, append=len(tf))
        self.stratum, self.bound = here[self.begin], self.impact[self.begin]
        self.n_strata, self.score = len(values), np.zeros(len(length), np.int64)
        terms = term[self.begin]
        self.first, self.last = np.searchsorted(terms, held, "left"), np.searchsorted(terms, held, "right")
        self.at = dict(zip(held.tolist(), range(len(held)), strict=True))

    def best(self, item: list[int], k: int, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best; `tie`: places of the documents in the order of ids."""
        here = [self.at[x] for x in item if x in self.at]
        lists = ranges(self.first[here], self.last[here] - self.first[here])
        bounds = np.zeros(self.n_strata, np.int64)
        np.add.at(bounds, self.stratum[lists], self.bound[lists])
        visit = np.argsort(-bounds, kind="stable")
        visit = visit[bounds[visit] > 0]
        turn = np.full(self.n_strata, len(visit))
        turn[visit] = np.arange(len(visit))
        lists = lists[np.argsort(turn[self.stratum[lists]], kind="stable")]
        turns = turn[self.stratum[lists]]
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, 8
        while at < len(visit) and (len(docs) < k or bounds[visit[at]] >= scores[-1]):
            some = lists[np.searchsorted(turns, at) : np.searchsorted(turns, at + step)]
            places = ranges(self.begin[some], self.size[some])
            met = self.doc[places]
            np.add.at(self.score, met, self.impact[places])
            met = np.unique(met)
            found = self.score[met]
            self.score[met] = 0
            good = found >= (scores[-1] if len(docs) == k else 1)
            docs, scores = np.append(docs, met[good]), np.append(scores, found[good])
            top = np.lexsort((tie[docs], -scores))[:k]
            docs, scores = docs[top], scores[top]
            at, step = at + step, step * 2  # a document is in one stratum, so its score is whole when that has been visited
        return docs, scores


def _ranked(indexed: DataFrame, block: list[tuple], numbers: dict[bytes, int], k: int) -> DataFrame:
    """item (number), item_id, doc_id, score: the best k of each block of documents."""
    n, total, weight = weights(indexed, len(numbers))
    asked = [[numbers[x] for x in terms] for _, terms in block]
    kind = indexed.schema["doc_id"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                ids = row.column("doc_id").flatten()
                length, doc, tf = unpacked(row.column("postings")[0].as_py(), "<i8", "<i4", "<i4")
                held, df = (np.asarray(row.column(x).flatten(), dtype=np.int64) for x in ("held", "df"))
                if not len(held):
                    continue
                strata = Strata(length, held, df, doc.astype(np.int64), tf, n, total, weight)
                tie = np.empty(len(ids), np.int64)
                tie[np.asarray(pc.sort_indices(ids))] = np.arange(len(ids))  # null ids come last
                found = [strata.best(x, k, tie) for x in asked]
                docs = np.concatenate([x[0] for x in found]).astype(np.int64)
                item = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item.astype(np.int32)), ids.take(pa.array(docs)), pa.array(np.concatenate([x[1] for x in found]))], names=["item", "doc_id", "score"])

    return indexed.mapInArrow(run, f"item int, doc_id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k documents with the highest scores above 0, ties by ascending id."""
    spark = docs.sparkSession
    terms = item_terms(items, item_id, item_text)
    results = []
    for block in item_blocks(terms):
        numbers = {x: at for at, x in enumerate(sorted({x for _, own in block for x in own}), 1)}
        found = _ranked(written(index(docs, list(numbers), doc_id, text)), block, numbers, k)
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        ids = spark.createDataFrame([(at, own) for at, (own, _) in enumerate(block)], f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}")
        results.append(found.join(ids, "item").select("item_id", "rank", F.col("doc_id"), "score"))
    if not results:
        kinds = terms.schema["item_id"].dataType.simpleString(), docs.schema[doc_id].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    return reduce(DataFrame.unionByName, results)

"""Language-model scores from a hierarchical Pitman-Yor model of words, learned and applied as Spark shuffles.

The model: a restaurant for each previous word (and the text's start), all sharing one parent, the restaurant of words
without context, whose own base is uniform over the V known words and one for all unknown. Customers of a context are its
following words; each table a context opens for a word is a customer of the parent. Seatings are sampled by Gibbs: a move
draws the tables of every (context, word), so of all its customers, from their conditional given the restaurant's total and
the parent's probability of the word. Predictive probabilities are averaged over the samples after the first BURN moves.

Distribution: a text's words become (previous, word) pairs. Every block of documents sends its pairs, sorted and packed,
to the bucket of their context. Buckets send the tables of each word, at first one a pair, to the word's shard. Shards add
them up, seat the parent, and answer every bucket that has the word, with the shard's totals. Buckets then seat their
restaurants under the parent's probabilities and send tables again, ROUNDS times; under the last parent they take averaged
samples and add up the log probabilities of each document's words, learned or held out; a last shuffle brings these sums
together by block. The pairs' shuffle is written once and read by all passes where Spark reuses the exchange. Contexts are
seated in parallel given the parent of the pass before, never gathered or broadcast; what moves are the corpus' pairs.

A context with more than its share of all words (1 / HOT_SHARE of a bucket) is cut by the hash of the following word into
parts, each sent to a bucket of its own. A part is seated with the tables that the other buckets had in the pass before; its
averaged tables are added up over all buckets (one number a hot context) before scoring, so that the context's probabilities sum to 1 as those of others
do. The list of such contexts is bounded by HOT_SHARE times the number of buckets.

Words are A-Z lower-cased runs without white space, then one end of text; null and empty texts are an end alone. Null ids
are held out or learned like the empty id; repeated rows are texts of their own. With nothing learned every word has the
uniform probability. Samples are drawn bucket by bucket, so scores depend on spark.sql.shuffle.partitions as on a seed (with
8 against 32 up to 1.5 % in a document, 0.01 % in their sum). Ids are returned as long; ids of other types must be numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpenglow.llm.common import chunks, encoded, joined, partitions, worker_cache, written

#: Discount and strength of the parent, and of the contexts.
PARENT, CONTEXT = (0.65, 10.0), (0.85, 2.0)
#: Gibbs moves, each of all customers, in the first passes and the last; those before BURN are not averaged.
MOVES, BURN = (4, 8), 3
#: Hot contexts are cut into parts of about a HOT_SHARE-th of a bucket.
HOT_SHARE = 4
#: Moves at most before the counted ones, until the number of tables grows by less than a 200th.
SETTLE = 40
#: Passes over the contexts, each followed by one over the parent.
ROUNDS = 2
#: Customers of one dish up to which the Stirling numbers are a table; beyond, they are integrated to about 4e-5 in their
#: logarithms, at so many points; from DIRECT tables on they are interpolated at so many nodes over ranges that grow by this factor.
EXACT = 512
CONTOUR, NODES, PIECE, DIRECT = 100, 24, 1.5, 64
#: Customers of one dish up to which its tables are drawn from plain powers of the rate, which no double overflows.
POWERS = 16
#: Numbers looked at at once while tables are drawn.
DRAWN = 250_000
#: Text of one block of documents.
BLOCK_BYTES = 6_000_000
SEED = 11
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
START, END = np.uint64(1), np.uint64(2)
#: Text hashed at once (one text at least).
TOKEN_BYTES = 1_000_000
_KIND = np.array([0 if c == 32 or 9 <= c <= 13 else c + 33 if 65 <= c <= 90 else c + 1 for c in range(256)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * _MIX


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, each text's followed by END; and how many each text has."""
    sizes = np.cumsum([len(x) + 1 for x in texts])
    found, at = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOKEN_BYTES, side="right")))
        found.append(_tokens(texts[at:stop]))
        at = stop
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _BASE from 1 on and of its inverse from 0 on, modulo 2**64; those of usual lengths are kept."""
    held = worker_cache()
    if n > len(held.get("powers", ((),))[0]):
        size = max(n, TOKEN_BYTES + 1)
        up = np.multiply.accumulate(np.full(size, np.uint64(_BASE)))
        down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, np.uint64(pow(_BASE, -1, 2**64)))])
        if size > 4 * TOKEN_BYTES:
            return up, down
        held["powers"] = up, down
    return tuple(x[:n] for x in held["powers"])


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = joined([x + b" " for x in texts])
    kind = _KIND[data]  # 0: white space, else the letter in lower case, plus 1
    word = kind > 0
    edge = np.flatnonzero(np.diff(word, prepend=False))  # a space is last, so words begin and end in turn
    begins, ends = edge[::2], edge[1::2]
    up, down = _powers(len(data))
    total = np.cumsum(kind * up)
    before = np.where(begins > 0, total[np.maximum(begins - 1, 0)], np.uint64(0))
    hashes = mixed((total[ends - 1] - before) * down[begins] + (ends - begins).astype(np.uint64))
    owner = np.searchsorted(bounds, begins, side="right") - 1
    counts = np.bincount(owner, minlength=len(texts)) + 1
    out = np.full(int(counts.sum()), END)
    out[np.arange(len(hashes)) + owner] = hashes  # one END for each text before
    return out, counts


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(arrays), *(x.nbytes for x in arrays)], np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(x.tobytes() for x in arrays))


def _unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    sizes = np.frombuffer(raw, np.int64, 1 + len(kinds))[1:]
    ends = 8 * (1 + len(kinds)) + np.cumsum(sizes)
    return [np.frombuffer(raw[e - s : e], k) for k, s, e in zip(kinds, sizes.tolist(), ends.tolist(), strict=True)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from chunks(batch, limit=BLOCK_BYTES)


def hot_contexts(docs: DataFrame, buckets: int) -> dict[int, int]:
    """Parts of each word that is a context too often for one bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _blocks(batches):
            words, counts = tokens(encoded(piece.column("text")))
            code, values = pd.factorize(words)
            n = np.bincount(code)
            values, n = np.append(values[values != END], START), np.append(n[values != END], len(counts))
            some = n * 2 * HOT_SHARE * buckets > len(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(values[some], np.uint64(0)).view(np.int64)), pa.array(np.append(n[some], len(words)))], names=["word", "n"])

    rows = written(docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")))
    total = rows.filter("word = 0").agg(F.max("n")).first()[0] or 0  # word 0 counts all
    least = total / (HOT_SHARE * buckets)
    hot = rows.filter((F.col("word") != 0) & (F.col("n") > F.lit(least))).collect()
    return {r["word"]: -int(-r["n"] // max(least, 1)) for r in hot}


def _place(context: np.ndarray, word: np.ndarray, hot: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """The context, or of a hot one the part that the word belongs to."""
    if not len(hot):
        return context
    at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
    is_hot = hot[at] == context
    part = (mixed(word) >> np.uint64(8)) % np.where(is_hot, parts[at], 1).astype(np.uint64)
    return np.where(is_hot, mixed(context + (part + np.uint64(1)) * _MIX), context)


def _send(batches: Iterator[pa.RecordBatch], buckets: int, hot: np.ndarray, parts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of a block, by bucket: contexts, pairs of each, words, occurrences of each, documents of the occurrences."""
    task, number = TaskContext.get().partitionId(), 0
    for piece in _blocks(batches):
        words, counts = tokens(encoded(piece.column("text")))
        doc = np.repeat(np.arange(len(counts), dtype=np.uint32), counts)
        firsts = np.cumsum(counts) - counts
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[firsts] = START
        bucket = (mixed(_place(before, words, hot, parts)) >> np.uint64(3)) % np.uint64(buckets)
        # One number to sort by: the bucket, then bits of both hashes, so that equal pairs lie together. Where these bits agree by
        # chance a context or a pair comes in two pieces, which the bucket joins.
        rest = 64 - int(buckets).bit_length()
        key = bucket << np.uint64(rest) | mixed(before) >> np.uint64(64 - rest // 2) << np.uint64(rest - rest // 2) | mixed(words) >> np.uint64(64 - rest + rest // 2)
        order = np.argsort(key)
        bucket, before, words, doc = bucket[order], before[order], words[order], doc[order]
        ends = np.cumsum(np.bincount(bucket.astype(np.int64), minlength=buckets)).tolist()
        ids = piece.column("doc_id")
        learn = np.asarray(piece.column("learn").cast(pa.uint8()))
        about = _pack(np.asarray(ids.fill_null(0), dtype=np.int64), np.asarray(ids.is_null().cast(pa.uint8())), counts.astype(np.int64))
        block = task << 24 | number
        rows = []
        for b, (a, z) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if z == a and b != block % buckets:
                continue
            context, word = before[a:z], words[a:z]
            new_c = np.r_[True, context[1:] != context[:-1]][: z - a]
            pair = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][: z - a] | new_c)
            data = _pack(context[new_c], np.diff(np.r_[np.flatnonzero(new_c[pair]), len(pair)]).astype(np.uint32), word[pair],
                         np.diff(np.r_[pair, z - a]).astype(np.uint32), doc[a:z].astype(np.uint16 if len(counts) < 65536 else np.uint32), learn)
            rows.append((b, block, data, about if b == block % buckets else None))
        number += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary()),
             pa.array([r[3] for r in rows], pa.binary())], names=["bucket", "block", "pairs", "about"])


def grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, where each comes first, and the place of every value among them; only the distinct are sorted."""
    code, distinct = pd.factorize(values)
    first = np.empty(len(distinct), np.int64)
    first[code[::-1]] = np.arange(len(values))[::-1]
    order = np.argsort(distinct)
    place = np.empty(len(distinct), np.int64)
    place[order] = np.arange(len(distinct))
    return distinct[order], first[order], place[code]


class _Bucket:
    """The pairs of one bucket: distinct ones with learned counts, and each block's occurrences as places in them."""

    def __init__(self, table: pa.Table, hot: np.ndarray):
        self.blocks, keys, self.totals = [], [], np.zeros((0, 5))
        for block, data, about in zip(*(table.column(x).to_pylist() for x in ("block", "pairs", "about")), strict=True):
            context, per, word, times, doc, learn = _unpack(data, "<u8", "<u4", "<u8", "<u4", "u1", "u1")
            doc = doc.view("<u2" if len(learn) < 65536 else "<u4")
            context, times = np.repeat(context, per), times.astype(np.int64)
            keys.append((context, word))
            self.blocks.append((block, times, doc, learn, about))
        context = np.concatenate([x for x, _ in keys]) if keys else np.zeros(0, np.uint64)
        word = np.concatenate([x for _, x in keys]) if keys else np.zeros(0, np.uint64)
        _, first, self.place = grouped(mixed(context) + word)
        self.context, self.word = context[first], word[first]
        learned = [np.add.reduceat(learn[doc].astype(np.int64), np.cumsum(times) - times) if len(times) else np.zeros(0, np.int64)
                   for _, times, doc, learn, _ in self.blocks]
        self.count = np.bincount(self.place, np.concatenate(learned) if learned else None, minlength=len(first)).astype(np.int64)
        self.owners, _, self.owner = grouped(self.context)
        self.words, _, self.word_at = grouped(self.word)
        at = np.minimum(np.searchsorted(hot, self.context), max(len(hot) - 1, 0))
        is_hot = hot[at] == self.context if len(hot) else np.zeros(len(first), bool)
        self.hot_at = np.where(is_hot, at, -1)

    def heard(self, answers: pa.Table, hot: np.ndarray) -> None:
        """Takes in what the parent answers: its probability of each pair's word, and the totals of the hot contexts."""
        got = [_unpack(x, "<i8", "<f4", "<i8", "<u8", "<i8", "<f8", "<f8") for x in answers.column("parent").to_pylist()]
        got.sort(key=lambda x: x[6][4])  # by shard; the words of a shard are in their order
        order = np.argsort(_shards(self.words, len(got)), kind="stable")
        customers, tables, learned = (np.empty(len(self.words), kind) for kind in (np.int64, np.float64, np.int64))
        customers[order], tables[order] = (np.concatenate([x[k] for x in got]) for k in (0, 1))
        if any(len(x[2]) for x in got):
            learned[order] = np.concatenate([x[2] for x in got])
        self.learned = learned
        self.totals = np.array([x[6] for x in got])
        all_customers, all_tables, self.known, self.n_tokens = self.totals[:, :4].sum(axis=0)
        discount, strength = PARENT
        parent = (customers - discount * tables + (strength + discount * all_tables) / (self.known + 1)) / (strength + all_customers)
        self.base = parent[self.word_at]
        self.others, self.hot_count = np.zeros(len(self.owners)), np.zeros(len(hot))
        for x in got:
            self.others[np.searchsorted(self.owners, x[3])] = x[5]
            self.hot_count[np.searchsorted(hot, x[3])] = x[4]

    def seated(self, some: np.ndarray, moves: int, burn: int, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
        return seat(self.count[some], self.base[some], self.owner[some], np.ones(len(self.owners)), *CONTEXT, moves, burn, seed, self.others)

    def by_hot(self, values: np.ndarray, hot: np.ndarray) -> np.ndarray:
        heavy = self.hot_at >= 0
        return np.bincount(self.hot_at[heavy], values[heavy], minlength=len(hot))


def _stirling(discount: float) -> list[np.ndarray]:
    """Logarithms of the generalised Stirling numbers: row c, for 1 to c tables, up to EXACT customers."""
    held, key = worker_cache(), f"stirling {discount}"
    if key not in held:
        rows = [np.zeros(0), np.zeros(1)]
        for c in range(1, EXACT):
            with np.errstate(divide="ignore"):
                stay = np.append(rows[c] + np.log(c - discount * np.arange(1, c + 1)), -np.inf)
            rows.append(np.logaddexp(np.append(-np.inf, rows[c]), stay))
        held[key] = rows
    return held[key]


def _stirling_table(discount: float) -> np.ndarray:
    """_stirling as one table, -inf beyond a row's end."""
    held, key = worker_cache(), f"stirling table {discount}"
    if key not in held:
        table = np.full((EXACT + 1, EXACT), -np.inf)
        for c, row in enumerate(_stirling(discount)):
            table[c, :c] = row[:c]
        held[key] = table
    return held[key]


def _bisected(value, target: np.ndarray) -> np.ndarray:
    """y in (0, 1) where value(y), which falls with y, meets the target, to seven digits."""
    low, high = np.full(len(target), -400.0), np.zeros(len(target))
    for _ in range(32):
        middle = (low + high) / 2
        more = value(np.exp(middle)) > target
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    return np.exp((low + high) / 2)


def _coefficient(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """Logarithms of the coefficients of x^c in (1 - (1 - x)^d)^t, for real t from 1 to below c.

    Cauchy's integral over z = log x, on a parabola through the saddle point whose focus is the branch point at z = 0: the
    power x^-c falls along it, so CONTOUR points give four digits and more whatever t is.
    """
    out, step = np.empty(len(t)), max(1, DRAWN // CONTOUR)
    for k in range(0, len(t), step):
        out[k : k + step] = _integrated(c[k : k + step].astype(float), t[k : k + step].astype(float), d)
    return out


def _integrated(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    y = _bisected(lambda y: d * (1 - y) * y ** (d - 1) / -np.expm1(d * np.log(y)), c / t)  # the saddle is at 1 - y
    r, f, distance = 1 - y, -np.expm1(d * np.log(y)), -np.log1p(-y)
    mean = r * d * y ** (d - 1) / f
    spread = np.maximum(mean + r * r * d * (1 - d) * y ** (d - 2) / f - mean**2, 1e-12)
    width = (t * spread) ** -0.5
    step = np.minimum(14.0, np.pi / width) / CONTOUR
    u = np.arange(CONTOUR + 1) * step[:, None]
    # z = re + im i. In real numbers, which numpy computes several times faster; scaled by y, whose square may underflow.
    im = width[:, None] * u
    re = im**2 / (4 * distance[:, None])
    with np.errstate(all="ignore"):
        left = 1 - (r / y)[:, None] * (np.expm1(re) * np.cos(im) - 2 * np.sin(im / 2) ** 2)  # (1 - x) / y
        up = -(r / y)[:, None] * np.exp(re) * np.sin(im)
        size, turn = np.exp(d * (np.log(left**2 + up**2) / 2 + np.log(y)[:, None])), d * np.arctan2(up, left)
        left, up = 1 - size * np.cos(turn), -size * np.sin(turn)  # 1 - (1 - x)^d
        height = t[:, None] * (np.log(left**2 + up**2) / 2 - np.log(f)[:, None]) - c[:, None] * re
        turn = np.where(height > -700, t[:, None] * np.arctan2(up, left) - c[:, None] * im, 0)
        height = np.exp(np.where(height > -700, height, -700))
        value = height * (width[:, None] * np.cos(turn) + (width[:, None] ** 2 * u / (2 * distance[:, None])) * np.sin(turn))
    value[:, 0] /= 2
    return np.log(np.maximum(value.sum(axis=1) * step / np.pi, 1e-300)) + t * np.log(f) - c * np.log1p(-y)


def _fits(wanted: list[tuple[int, int]], d: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each (c, piece): Chebyshev coefficients of _coefficient over the piece-th range of t, each half as long again as the
    one before; the range's begin and length. Those not made before are made at once."""
    held = worker_cache().setdefault("stirling fits", {})
    if len(held) > 100_000:
        held.clear()
    new = [x for x in dict.fromkeys(wanted) if (*x, d) not in held]
    if new:
        c = np.array([x for x, _ in new])
        low, high = (np.array([min(PIECE ** (piece + k), size - 1) for size, piece in new]) for k in (0, 1))
        nodes = np.cos(np.pi * (np.arange(NODES) + 0.5) / NODES)
        at = low[:, None] + (nodes + 1) / 2 * (high - low)[:, None]
        values = _coefficient(np.repeat(c, NODES), at.ravel(), d).reshape(at.shape)
        angles = np.pi * np.arange(NODES)[:, None] * (np.arange(NODES) + 0.5) / NODES
        made = values @ (2 / NODES * np.cos(angles)).T
        made[:, 0] /= 2
        held.update(zip(((*x, d) for x in new), zip(made, low, np.maximum(high - low, 1e-9), strict=True), strict=True))
    fit, low, size = zip(*(held[*x, d] for x in wanted), strict=True)
    return np.array(fit), np.array(low), np.array(size)


def _large_ranges(asked: list[tuple[int, int, int]], d: float) -> list[np.ndarray]:
    """Of each (c, a, z), as _stirling for more than EXACT customers, without the terms of c alone, and a to z tables. All that
    is integrated for them is integrated at once."""
    direct, fitted = [], []  # customers or place among the fits, t, and where the result goes
    wanted, ends = [], np.cumsum([z - a + 1 for _, a, z in asked]).tolist()
    for (c, a, z), begin in zip(asked, [0, *ends], strict=False):
        few, many, end = (min(max(math.ceil(x) - a, 0), z - a + 1) for x in (DIRECT, max(0.7 * c, DIRECT), c))
        some = np.r_[0:few, many:end]  # where a fit takes more points than there are, or is no polynomial: near one customer a table
        some = some[some < end]
        direct.append((np.full(len(some), c), a + some, begin + some))
        if few < many:
            first, last = (int(math.log(x) / math.log(PIECE) + 1e-9) for x in (a + few, a + many - 1))
            for piece in range(first, last + 1):
                x, y = (min(max(math.ceil(PIECE**k) - a, few), many) for k in (piece, piece + 1))
                if y > x:
                    fitted.append((np.full(y - x, len(wanted)), np.arange(a + x, a + y), np.arange(begin + x, begin + y)))
                    wanted.append((c, piece))
    out = np.zeros(ends[-1] if ends else 0)
    if direct:
        c, t, to = (np.concatenate(x) for x in zip(*direct, strict=True))
        out[to] = _coefficient(c, t, d)
    if fitted:
        fits, low, size = _fits(wanted, d)
        which, t, to = (np.concatenate(x) for x in zip(*fitted, strict=True))
        for k in range(0, len(t), DRAWN // NODES):
            some = which[k : k + DRAWN // NODES]
            x = np.clip(2 * (t[k : k + len(some)] - low[some]) / size[some] - 1, -1, 1)
            out[to[k : k + len(some)]] = np.polynomial.chebyshev.chebval(x, fits[some].T, tensor=False)
    found = []
    for (c, a, z), begin in zip(asked, [0, *ends], strict=False):
        t, values = np.arange(a, z + 1), out[begin : begin + z - a + 1]
        values = np.where(t == c, c * math.log(d), values)
        found.append(values - math.lgamma(a + 1) - np.append(0.0, np.cumsum(np.log(t[1:]))) - t * math.log(d))
    return found


def _large(c: int, t: np.ndarray, d: float) -> np.ndarray:
    """_large_ranges of one range t."""
    return _large_ranges([(c, int(t[0]), int(t[-1]))], d)[0]


def _ranges(c: list[int], low: list[int], high: list[int], d: float) -> list[np.ndarray]:
    """_large of low to high tables of each dish; the range asked for last is kept with some margin, since moves draw from about
    the same one."""
    held = worker_cache().setdefault("stirling ranges", {"size": 0})
    if held["size"] > 20_000_000:
        held.clear()
        held["size"] = 0
    new, source = {}, []
    for size, a, z in zip(c, low, high, strict=True):
        begin, values = held.get((size, d), (0, ()))
        if begin <= a and z < begin + len(values):
            source.append((begin, values))
            continue
        own = next((x for x in new.get(size, ()) if x[0] <= a and z <= x[1]), None)
        if own is None:
            margin = (z - a) // 4 + 8
            own = (max(1, a - margin), min(size, z + margin))
            new.setdefault(size, []).append(own)
        source.append((size, *own))
    asked = [(size, *x) for size, some in new.items() for x in some]
    made = dict(zip(asked, _large_ranges(asked, d), strict=True))
    for (size, begin, _), values in made.items():
        held[size, d] = begin, values
        held["size"] += len(values)
    source = [x if len(x) == 2 else (x[1], made[x]) for x in source]
    return [values[a - begin : z - begin + 1] for (begin, values), a, z in zip(source, low, high, strict=True)]


def _draw(c: np.ndarray, rate: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables t of dishes with c customers, with a chance in proportion to Stirling(c, t) * (discount * rate) ** t. c is sorted."""
    t = np.ones(len(c), np.int64)
    few, large = (int(np.searchsorted(c, x, side="right")) for x in (POWERS, EXACT))
    rows, weight = _stirling(discount), np.log(np.maximum(discount * rate, 1e-300))
    values, begins = np.unique(c[:few], return_index=True)
    for value, a, z in zip(values.tolist(), begins.tolist(), [*begins.tolist(), few][1:], strict=True):
        chance = rng.random(z - a)
        x = np.clip(discount * rate[a:z], 1e-300, 1e18)  # beyond, all customers sit alone as far as a double can tell
        sums, power = [np.ones(z - a)], x
        for one in np.exp(rows[value][1:] - rows[value][0]).tolist():
            sums.append(sums[-1] + one * power)
            power = power * x
        chance *= sums[-1]
        for one in sums[:-1]:
            t[a:z] += one < chance
    if few < large:
        # More tables than the rate by far have no chance worth a double; most rates are small.
        size = c[few:large]
        width = 32 << np.minimum(np.maximum(np.ceil(np.log2(np.maximum(rate[few:large], 1) / 4)), 0), 30).astype(int)
        width = np.where(size > 64, np.minimum(width, size), size)
        order, chance = np.lexsort((width, size)), np.empty(large - few)
        chance[order] = rng.random(large - few)
        columns = 32 << np.ceil(np.log2(np.maximum(width, 32) / 32)).astype(int)
        table = _stirling_table(discount)
        for n in np.unique(columns).tolist():
            place, tables = few + np.flatnonzero(columns == n), np.arange(1, min(n, EXACT) + 1)
            for k in range(0, len(place), max(1, DRAWN // n)):
                some = place[k : k + max(1, DRAWN // n)]
                sums = table[c[some], : len(tables)] + weight[some, None] * tables
                sums = np.cumsum(np.exp(sums - sums.max(axis=1, keepdims=True)), axis=1)
                t[some] = 1 + (sums < chance[some - few, None] * sums[:, -1:]).sum(axis=1)
    if large < len(c):
        n, lam, d = c[large:].astype(float), np.maximum(rate[large:], 1e-300), discount
        y = _bisected(lambda y: d * (1 - y) * y ** (d - 1), n / lam)
        r, mean = 1 - y, lam * -np.expm1(d * np.log(y))
        spread = np.maximum(mean - n**2 / (lam * (r * d * y ** (d - 1) + r * r * d * (1 - d) * y ** (d - 2))), 0) ** 0.5
        low, high = np.maximum(np.floor(mean - 8 * spread - 20), 1), np.minimum(np.ceil(mean + 8 * spread + 30), n)
        low, high = low.astype(int).tolist(), high.astype(int).tolist()
        found = zip(_ranges(c[large:].tolist(), low, high, discount), low, high, rng.random(len(low)).tolist(), strict=True)
        for k, (values, a, z, drawn) in enumerate(found, large):
            chance = values + np.arange(a, z + 1) * weight[k]
            chance = np.cumsum(np.exp(chance - chance.max()))
            t[k] = a + np.searchsorted(chance, drawn * chance[-1])
    return t


def seat(count: np.ndarray, base: np.ndarray, owner: np.ndarray, scale: np.ndarray, discount: float, strength: float, moves: int,
         burn: int, seed: list[int], others: np.ndarray | float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each (restaurant, dish): the last sample, and the mean of the samples after `burn` moves.

    A move samples all customers of every dish anew. The seatings' probability has the restaurant's total in it through one
    gamma function; given a gamma variable of that shape the dishes are independent, so that each draws its tables from its
    conditional, exact whatever the number of its customers.
    count: customers; base: the dish's probability in the parent; owner: the restaurant; scale, others: factor of its tables,
    and tables of it that are elsewhere.
    """
    rng = np.random.default_rng(seed)
    tables = (count > 0).astype(np.int64)
    several = np.flatnonzero(count > 1)
    if not len(several):
        return tables, tables.astype(float)
    several = several[np.argsort(count[several], kind="stable")]
    c, p, u = count[several], base[several], owner[several]
    alone = np.bincount(owner[count == 1], minlength=len(scale)).astype(float)
    t, total, samples = np.ones(len(c), np.int64), np.zeros(len(c)), 0

    def moved() -> np.ndarray:
        shape = strength / discount + others + scale * (alone + np.bincount(u, t, minlength=len(scale)))
        return _draw(c, rng.gamma(shape)[u] * p, discount, rng)

    for _ in range(SETTLE):  # from one table a dish to where the number of tables stays
        before, t = t.sum(), moved()
        if t.sum() - before < 0.005 * before:
            break
    for move in range(moves):
        t = moved()
        if move >= burn or move == moves - 1:
            total += t
            samples += 1
    tables[several] = t
    mean = tables.astype(float)
    mean[several] = total / samples
    return tables, mean


def _shards(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(words) >> np.uint64(17)) % np.uint64(buckets)


def _told(pairs: _Bucket, number: int, tables: np.ndarray, buckets: int, hot: np.ndarray, last: bool) -> pa.Table:
    """Of each word of the bucket, by shard: its tables over the bucket's contexts and, the last time, its learned occurrences;
    of hot contexts their customers and tables here; and what the shard said last: the parent's tables in other shards, and
    all known words."""
    per_word = np.bincount(pairs.word_at, tables, minlength=len(pairs.words)).astype(np.int64)
    learned = np.bincount(pairs.word_at, pairs.count, minlength=len(pairs.words)).astype(np.int64)
    shard = _shards(pairs.words, buckets)
    hot_tables, hot_count = pairs.by_hot(tables, hot), pairs.by_hot(pairs.count, hot).astype(np.int64)
    here = np.unique(pairs.hot_at[pairs.hot_at >= 0])
    said = {int(x[4]): (pairs.totals[:, 1].sum() - x[1], pairs.known) for x in pairs.totals}
    rows = []
    for s in range(buckets):
        some = shard == s
        mine = here[(hot[here] % np.uint64(buckets)) == s] if len(here) else here
        rows.append((s, number, _pack(pairs.words[some], per_word[some], learned[some] if last else learned[:0],
                                      hot[mine] if len(hot) else np.zeros(0, np.uint64), hot_count[mine], hot_tables[mine].astype(float),
                                      np.array(said.get(s, (-1.0, -1.0))))))
    return pa.table({"shard": pa.array([r[0] for r in rows], pa.int32()), "bucket": pa.array([r[1] for r in rows], pa.int32()),
                     "tables": pa.array([r[2] for r in rows], pa.binary())})


def _first_pass(table: pa.Table, buckets: int, hot: np.ndarray) -> pa.Table:
    """Every pair with one table, for a first parent that all buckets share."""
    pairs = _Bucket(table, hot)
    return _told(pairs, table.column("bucket")[0].as_py(), (pairs.count > 0).astype(np.int64), buckets, hot, last=not ROUNDS)


def _context_pass(table: pa.Table, answers: pa.Table, buckets: int, hot: np.ndarray, turn: int) -> pa.Table:
    """Seats the contexts under the parent that the pass before has left."""
    number, pairs = table.column("bucket")[0].as_py(), _Bucket(table, hot)
    pairs.heard(answers, hot)
    tables, _ = pairs.seated(np.arange(len(pairs.count)), MOVES[0], 0, [SEED, 1, number, turn])
    return _told(pairs, number, tables, buckets, hot, last=turn == ROUNDS - 1)


def _parent(table: pa.Table, buckets: int, turn: int) -> pa.Table:
    """Seats a shard of the parent and answers each bucket: customers, tables and (at the end) learned occurrences of its
    words, in the order they were told, the customers of its hot contexts and their tables in other buckets, and the shard's totals (customers, tables, words,
    occurrences) and number."""
    shard = table.column("shard")[0].as_py()
    froms = table.column("bucket").to_pylist()
    asked = [_unpack(x, "<u8", "<i8", "<i8", "<u8", "<i8", "<f8", "<f8") for x in table.column("tables").to_pylist()]
    words, _, place = grouped(np.concatenate([x[0] for x in asked]))
    customers = np.bincount(place, np.concatenate([x[1] for x in asked]), minlength=len(words)).astype(np.int64)
    told = np.concatenate([x[2] for x in asked])
    learned = np.bincount(place, told, minlength=len(words)).astype(np.int64) if len(told) else np.zeros(0, np.int64)
    known = int((customers > 0).sum())
    others, all_known = max(x[6].tolist() for x in asked)
    first = all_known < 0  # no totals yet: the other shards are taken to be like this one
    base = np.full(len(words), 1 / ((known * buckets if first else all_known) + 1))
    _, tables = seat(customers, base, np.zeros(len(words), np.int64), np.array([float(buckets if first else 1)]), *PARENT, MOVES[1], BURN,
                     [SEED, 2, shard, turn], 0.0 if first else others)
    tables = tables.astype(np.float32)  # as they are sent, so that the totals are theirs
    hot, at = np.unique(np.concatenate([x[3] for x in asked]), return_inverse=True)
    hot_count = np.bincount(at, np.concatenate([x[4] for x in asked]), minlength=len(hot)).astype(np.int64)
    hot_tables = np.bincount(at, np.concatenate([x[5] for x in asked]), minlength=len(hot))
    totals = np.array([customers.sum(), tables.sum(dtype=float), known, learned.sum(), shard], float)
    rows, start, start_hot = [], 0, 0
    for bucket, own in zip(froms, asked, strict=True):
        mine, mine_hot = place[start : start + len(own[0])], at[start_hot : start_hot + len(own[3])]
        start, start_hot = start + len(own[0]), start_hot + len(own[3])
        rows.append((bucket, _pack(customers[mine], tables[mine], learned[mine] if len(learned) else learned, own[3],
                                   hot_count[mine_hot], hot_tables[mine_hot] - own[5], totals)))
    return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()), "parent": pa.array([r[1] for r in rows], pa.binary())})


def _hot_pass(table: pa.Table, answers: pa.Table, buckets: int, hot: np.ndarray) -> pa.Table:
    """The averaged tables of hot contexts in this bucket; the last pass draws the same samples again."""
    number, pairs = table.column("bucket")[0].as_py(), _Bucket(table, hot)
    pairs.heard(answers, hot)
    heavy = np.flatnonzero(pairs.hot_at >= 0)
    mean = np.zeros(len(pairs.count))
    mean[heavy] = pairs.seated(heavy, MOVES[1], BURN, [SEED, 4, number])[1]
    here, sums = np.unique(pairs.hot_at[heavy]), pairs.by_hot(mean, hot)
    return pa.table({"context": pa.array(hot[here].view(np.int64), pa.int64()), "bucket": pa.array([number] * len(here), pa.int32()),
                     "tables": pa.array(sums[here], pa.float64())})


def _hot_totals(table: pa.Table) -> pa.Table:
    """The tables of a hot context over all of its buckets, for each of them."""
    data = _pack(np.array([table.column("context")[0].as_py()], np.int64).view(np.uint64), np.array([math.fsum(table.column("tables").to_pylist())]))
    return pa.table({"bucket": table.column("bucket"), "parent": pa.nulls(len(table), pa.binary()), "hot": pa.array([data] * len(table), pa.binary())})


def _valued(table: pa.Table, answers: pa.Table, hot: np.ndarray) -> tuple[_Bucket, np.ndarray]:
    """The bucket's pairs and their predictive probabilities."""
    number = table.column("bucket")[0].as_py()
    pairs = _Bucket(table, hot)
    pairs.heard(answers.filter(answers.column("parent").is_valid()), hot)
    heavy, mean = pairs.hot_at >= 0, np.zeros(len(pairs.count))
    mean[heavy] = pairs.seated(np.flatnonzero(heavy), MOVES[1], BURN, [SEED, 4, number])[1]
    mean[~heavy] = pairs.seated(np.flatnonzero(~heavy), MOVES[1], BURN, [SEED, 3, number])[1]
    context_count = np.bincount(pairs.owner, pairs.count, minlength=len(pairs.owners)).astype(float)[pairs.owner]
    context_tables = np.bincount(pairs.owner, mean, minlength=len(pairs.owners))[pairs.owner]
    if heavy.any():
        hot_tables = np.zeros(len(hot))
        for data in answers.column("hot").drop_null().to_pylist():
            context, tables = _unpack(data, "<u8", "<f8")
            hot_tables[np.searchsorted(hot, context)] = tables
        context_count[heavy], context_tables[heavy] = pairs.hot_count[pairs.hot_at[heavy]], hot_tables[pairs.hot_at[heavy]]
    discount, strength = CONTEXT
    value = (np.maximum(pairs.count - discount * mean, 0) + (strength + discount * context_tables) * pairs.base) / (strength + context_count)
    return pairs, value


def _second_pass(table: pa.Table, answers: pa.Table, hot: np.ndarray) -> pa.Table:
    """Of each block: the documents met in this bucket, and the sums over their words here."""
    pairs, value = _valued(table, answers, hot)
    value, plain = np.log10(value), np.log10(pairs.learned + 0.5)[pairs.word_at]
    is_known = (pairs.learned > 0)[pairs.word_at]
    known, n_tokens = pairs.known, pairs.n_tokens
    rows, start = [], 0
    for block, times, doc, learn, about in pairs.blocks:
        at = np.repeat(pairs.place[start : start + len(times)], times)
        start += len(times)
        met = np.unique(doc)
        sums = [np.bincount(doc, x[at], minlength=len(learn))[met] for x in (value, plain, is_known)]
        rows.append((block, _pack(met.astype(np.uint32), *sums), about))
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "sums": pa.array([r[1] for r in rows], pa.binary()),
                     "about": pa.array([r[2] for r in rows], pa.binary()), "known": pa.array([float(known)] * len(rows)),
                     "n": pa.array([float(n_tokens)] * len(rows))})


def _documents(table: pa.Table) -> pa.Table:
    about = next(x for x in table.column("about").to_pylist() if x is not None)
    ids, empty, counts = _unpack(about, "<i8", "u1", "<i8")
    score, plain, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids))
    for data in table.column("sums").to_pylist():
        met, a, b, c = _unpack(data, "<u4", "<f8", "<f8", "<f8")
        score[met] += a
        plain[met] += b
        known[met] += c
    n, v = table.column("n")[0].as_py(), table.column("known")[0].as_py()
    return pa.table({"doc_id": pa.array(ids, mask=empty.astype(bool)), "n_tokens": counts, "n_known": known.astype(np.int64),
                     "train_tokens": np.full(len(ids), int(n)), "base_score": plain - counts * np.log10(n + 0.5 * (v + 1)), "score": score})


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score (log10) of every text, learned from the rows where `learn`
    is true. base_score: add-half unigram probabilities over the same words."""
    buckets = partitions(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    split = hot_contexts(rows, buckets)
    hot = np.array(sorted(x & (2**64 - 1) for x in split), np.uint64)
    parts = np.array([split[int(x)] for x in hot.view(np.int64)], np.int64)
    sent = rows.mapInArrow(lambda x: _send(x, buckets, hot, parts), "bucket int, block bigint, pairs binary, about binary")

    def parent(turn: int) -> Callable[[pa.Table], pa.Table]:
        return lambda x: _parent(x, buckets, turn)

    def contexts(turn: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        return lambda a, b: _context_pass(a, b, buckets, hot, turn)

    told = sent.groupBy("bucket").applyInArrow(lambda x: _first_pass(x, buckets, hot), "shard int, bucket int, tables binary")
    for turn in range(ROUNDS + 1):
        answers = told.groupBy("shard").applyInArrow(parent(turn), "bucket int, parent binary")
        if turn < ROUNDS:
            told = sent.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
                contexts(turn), "shard int, bucket int, tables binary")
    heard = answers.withColumn("hot", F.lit(None).cast("binary"))
    if len(hot):
        tables = sent.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(
            lambda a, b: _hot_pass(a, b, buckets, hot), "context bigint, bucket int, tables double")
        heard = heard.unionByName(tables.groupBy("context").applyInArrow(_hot_totals, "bucket int, parent binary, hot binary"))
    sums = sent.groupBy("bucket").cogroup(heard.groupBy("bucket")).applyInArrow(
        lambda a, b: _second_pass(a, b, hot), "block bigint, sums binary, about binary, known double, n double")
    return sums.groupBy("block").applyInArrow(
        _documents, "doc_id bigint, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")

"""Languages of documents as mixtures: each word is drawn from one of the document's languages.

Learning counts hashed byte n-grams (N bytes inside a word with its edges, A-Z and beyond in lower case) for each
language over all learned documents; the model holds languages x BUCKETS log likelihoods and nothing that grows with the
text. A document's words are its units: the likelihood of a word in a language is the mean over its n-grams times
their number, held to EVIDENCE n-grams so that long words don't decide alone. Expectation-maximisation over the words
estimates the proportions of a language set, until they settle. Every language alone and, nested by the proportions of the
full set, every larger set is fitted; that one is chosen whose log likelihood less PENALTY * log(words + 1) for each language
is largest. The prediction is the largest proportion in
that set (ties: the first language by name), its score that proportion.

Null texts and texts without a letter are `und` with score 0; so is everything if nothing was learned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alpenglow.llm.common import chunks, joined

N = 3
BUCKETS = 1 << 14
SMOOTHING = 0.5
EVIDENCE = 12.0
#: Rounds end where no proportion of a text moves by so much; or, far beyond what texts need, after so many.
TOLERANCE, MOST_ROUNDS = 1e-3, 500
PENALTY = 1.0
NO_LANGUAGE = "und"
_LETTER = regex.compile(r"\p{L}")
#: Bytes that words consist of: letters and every byte of a character beyond ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(97, 123), *range(128, 256)]] = True


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and word of each n-gram, and the text of each word."""
    data, bounds = joined([b" " + x.lower().encode() + b" " for x in texts])
    if len(data) < N:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = _IN_WORD[data]
    letters = np.where(inside, data, 32).astype(np.uint32)
    starts = inside & ~np.r_[False, inside[:-1]]
    word = np.cumsum(starts) - 1
    value = (letters[:-2] * np.uint32(0x9E3779B1)) ^ (letters[1:-1] * np.uint32(0x85EBCA77)) ^ (letters[2:] * np.uint32(0xC2B2AE3D))
    value ^= value >> np.uint32(15)
    bucket = (value * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 14)
    used = np.flatnonzero(inside[1:-1])  # n-grams around a letter: the first begins with the space before the word
    text_of_word = np.searchsorted(bounds, np.flatnonzero(starts), side="right") - 1
    return bucket[used].astype(np.int64), word[1:-1][used], text_of_word


def _mixture(share: np.ndarray, likely: np.ndarray, place: np.ndarray, firsts: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of each text's languages by expectation-maximisation from `share` (languages at 0 stay out), and the log
    likelihood. Rounds go on until no proportion moves by TOLERANCE; texts that have settled take no further part."""
    share, fit = share.copy(), np.zeros(len(share))
    active, units, at, begin = np.arange(len(share)), likely, place, firsts
    for _ in range(MOST_ROUNDS):
        if not len(active):
            break
        part = units * share[active][at]
        whole = part.sum(axis=1, keepdims=True)
        new = np.add.reduceat(part / whole, begin, axis=0) / count[active, None]
        moved = np.abs(new - share[active]).max(axis=1) >= TOLERANCE
        share[active] = new
        if not moved.all():
            kept = moved[at]
            active, units = active[moved], units[kept]
            at = (np.cumsum(moved) - 1)[at[kept]]
            begin = np.searchsorted(at, np.arange(len(active)))
    fit = np.add.reduceat(np.log((likely * share[place]).sum(axis=1)), firsts)
    return share, fit


@dataclass
class Model:
    languages: list[str]
    log_likelihood: np.ndarray  # buckets x languages

    def mixtures(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the chosen language set of each text (0 outside it), and the number of words."""
        bucket, word, owner = grams(texts)
        n, languages = len(texts), len(self.languages)
        words = np.bincount(owner, minlength=n)
        if not len(owner):
            return np.zeros((n, languages)), words
        begins = np.searchsorted(word, np.arange(len(owner)))
        total = np.add.reduceat(self.log_likelihood[bucket], begins, axis=0)
        size = np.diff(np.r_[begins, len(word)])
        total *= np.minimum(1.0, EVIDENCE / size)[:, None]
        peak = total.max(axis=1)
        likely = np.maximum(np.exp(total - peak[:, None]), 1e-300)
        some = np.flatnonzero(words)
        place = np.searchsorted(some, owner)
        firsts = np.searchsorted(owner, some)
        peaks = np.add.reduceat(peak, firsts)

        count = words[some].astype(float)
        full, value = _mixture(np.full((len(some), languages), 1 / languages), likely, place, firsts, count)
        order = np.argsort(-full, axis=1, kind="stable")
        cost = PENALTY * np.log(count + 1)
        best, best_value = full.copy(), value + peaks - languages * cost
        single = np.add.reduceat(total, firsts, axis=0)
        for k in range(1, languages):
            share = np.zeros_like(full)
            if k == 1:  # the likeliest language alone, whatever its place in the mixture
                own = single.argmax(axis=1)
                share[np.arange(len(some)), own] = 1.0
                found, fit = share, single[np.arange(len(some)), own]
            else:
                np.put_along_axis(share, order[:, :k], 1 / k, axis=1)
                found, fit = _mixture(share, likely, place, firsts, count)
                fit = fit + peaks
            new = fit - k * cost
            grew = new > best_value
            best[grew], best_value[grew] = found[grew], new[grew]
        out = np.zeros((n, languages))
        out[some] = best
        return out, words


def fit(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Learns from all rows with a language and a text; the driver gets languages x BUCKETS counts."""
    docs = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in chunks(batch):
                names, texts = piece.column("lang").to_pylist(), piece.column("text").to_pylist()
                bucket, word, owner = grams(texts)
                levels = sorted(set(names))
                level = np.array([levels.index(x) for x in names])
                both = np.bincount(level[owner[word]] * BUCKETS + bucket, minlength=len(levels) * BUCKETS).reshape(-1, BUCKETS)
                for name, row in zip(levels, both, strict=True):
                    counts[name] = counts.get(name, 0) + row
        for name, row in counts.items():
            seen = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seen)), pa.array(seen.astype(np.int32)), pa.array(row[seen])], names=["lang", "bucket", "n"])

    rows = docs.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(rows["lang"]))
    table = np.zeros((BUCKETS, len(languages)))
    table[rows["bucket"].to_numpy(dtype=int), [languages.index(x) for x in rows["lang"]]] = rows["n"].to_numpy(dtype=float)
    table += SMOOTHING
    return Model(languages, np.log(table / table.sum(axis=0)) if languages else table)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with lang_pred, score and `languages` (the chosen set with its proportions); columns so named are replaced."""
    added = [T.StructField("lang_pred", T.StringType(), False), T.StructField("score", T.DoubleType(), False),
             T.StructField("languages", T.MapType(T.StringType(), T.DoubleType(), False), False)]
    kept = [x for x in docs.schema.fields if x.name not in {a.name for a in added}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, text):
                texts = [x or "" for x in piece.column(text).to_pylist()]
                share, words = model.mixtures(texts) if model.languages else (np.zeros((len(texts), 1)), np.zeros(len(texts)))
                lettered = np.array([bool(_LETTER.search(x)) for x in texts], bool) & bool(model.languages)
                top = share.argmax(axis=1)
                names = [model.languages[k] if ok else NO_LANGUAGE for k, ok in zip(top.tolist(), lettered.tolist(), strict=True)]
                score = np.where(lettered, np.clip(share[np.arange(len(texts)), top], 0, 1), 0.0)
                maps = [[(model.languages[j], float(row[j])) for j in np.flatnonzero(row > 0)] for row in share]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(x.name) for x in kept), pa.array(names, pa.string()), pa.array(score),
                     pa.array(maps, pa.map_(pa.string(), pa.float64()))], names=[*(x.name for x in kept), *(x.name for x in added)])

    return docs.mapInArrow(run, T.StructType([*kept, *added]))

"""A training corpus from raw documents, in five stages.

Each stage takes the session, the documents its predecessor kept and the data folder, and returns documents with the same
columns (the last: token ids). Toxic documents go, one document of each near-duplicate group stays, passages that repeat
anywhere are cut from the texts, sources are mixed to equal weights, and texts become token ids.

Every stage takes nulls, empty and very long texts, repeated rows, empty tables and further columns as its operator defines
them (stated at the head of its module): null and empty texts are not toxic unless empty ones are as a rule, count as one
group of near-duplicates, keep their text, and give no tokens; a null source is a source; further columns pass through the
first four stages unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alpenglow.llm import byte_bpe, poisson_mix, simhash_ball, suffix_dedup, toxicity
from alpenglow.llm.common import id_remainder, table, written

#: Documents whose score reaches this are rejected.
TOXIC = 0.5
SEED = 20
#: Bytes of a repeated passage that is cut: shorter than the 400 of the operator's own query, since passages of fifty words
#: have about 250 to 350.
PASSAGE = 200
BPE_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, learned on the labelled documents of the folder, rejects."""
    labels = table(spark, sf_dir, "labels").filter(id_remainder("doc_id", 5) != 0)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model, out="__toxicity").filter(F.col("__toxicity") < TOXIC).drop("__toxicity")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-equal fingerprints: that of the smallest id."""
    return simhash_ball.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of passages that repeat; n_chars follows the text."""
    cut = suffix_dedup.remove(docs, length=PASSAGE)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))
    return cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn for equal shares of all sources, in the order of a hash."""
    return poisson_mix.replicate(docs, seed=SEED).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, round_trip: whether the ids decode to the text."""
    def digest(data: Column) -> Column:
        return F.sha2(data, 256)

    # Texts are compared by digest, so that they need not go to the tasks' Python a second time beside their ids.
    texts = docs.select("doc_id", "lang", "source", "text", digest(F.coalesce("text", F.lit("")).cast("binary")).alias("given"))
    encoded = byte_bpe.encode(texts, BPE_PATH, public_tokenizers.PATTERN)
    both = byte_bpe.decode(encoded.drop("text"), BPE_PATH, public_tokenizers.PATTERN)
    same = digest(F.col("decoded")) == F.col("given")
    return both.select("doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Trained models, connected components and suffix order are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of the operators, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alpenglow.llm import (
    byte_bpe, chat_grammar, decontaminate, fill_in_middle, language_mix, lexical_search, pitman_yor, pivot_search, poisson_mix, quartile_digest,
    simhash_ball, suffix_dedup, toxicity,
)
from alpenglow.llm.common import id_remainder, table

BPE_PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
MIX_SEED = 20


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 5) == 1
    found = pitman_yor.score(table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = byte_bpe.encode(docs, BPE_PATH, public_tokenizers.PATTERN).select("doc_id", "ids")
    both = byte_bpe.decode(ids, BPE_PATH, public_tokenizers.PATTERN)
    return both.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.search(pivot_search.quantised(table(spark, sf_dir, "embeddings")), k=20, every=20)


def op5_language_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 3) == 1
    model = language_mix.fit(docs.filter(~held_out))
    found = language_mix.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.edited_pairs(table(spark, sf_dir, "documents"))


def op7_chat_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.sql("""SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')
                         AS t(conv_id, turn, role, text)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat_grammar.digest(chat_grammar.render(rows))


def op8_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_ball.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' whole rows, all sources weighing the same, in as many characters as the corpus has."""
    return poisson_mix.replicate(table(spark, sf_dir, "documents"), seed=MIX_SEED)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.round_trip(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n", "form", F.col("prefix").alias("prefix_chars"), F.col("middle").alias("middle_chars"), "output_sha256", "restored_sha256")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, x: total + x["b"] - x["a"])
    names = F.array_sort(F.transform("items", lambda x: F.coalesce(x.cast("string"), F.lit(""))))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


#: One rate a source; its distribution function; copies by comparing each hashed number with it.
POISSON_MIX_SQL = f"""
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0)) AS size FROM documents GROUP BY source
), filled AS (SELECT * FROM sizes WHERE size > 0), mean AS (
  SELECT source, size, (1.0::DOUBLE / (SELECT count(*) FROM filled)) * (SELECT sum(size) FROM sizes)::DOUBLE / size AS rate FROM filled
), split AS (
  SELECT source, greatest(ceil(rate / {poisson_mix.PART}::DOUBLE)::INT, 1) AS parts, rate / greatest(ceil(rate / {poisson_mix.PART}::DOUBLE)::INT, 1) AS lam FROM mean
), terms AS (
  SELECT source, parts, k, exp(-lam + CASE WHEN k = 0 THEN 0 ELSE k * ln(lam) END - lgamma(k + 1)) AS p
  FROM split, LATERAL (SELECT unnest(range(0, ceil(lam)::BIGINT + {poisson_mix.TAIL} + 1)) AS k)
), steps AS (
  SELECT source, parts, sum(p) OVER (PARTITION BY source ORDER BY k) AS cum FROM terms
), cdf AS (SELECT source, parts, list(cum) AS cums FROM steps GROUP BY source, parts), drawn AS (
  SELECT d.*, list_sum(list_transform(range(1, parts + 1), lambda j: len(list_filter(cums, lambda c: c <
    ((('0x' || substr(md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || j), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE)))))::INT AS copies
  FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
)
SELECT * EXCLUDE (c), c::INT AS copy, md5('order{MIX_SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || c) AS order_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS c FROM drawn WHERE copies > 0)
"""


PIVOT_SEARCH_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r AS q, c.r AS c, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, c)::INT AS rank, vec_id, score
FROM scored QUALIFY row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id, c) <= 20
"""


FILL_IN_MIDDLE_SQL = """
WITH given AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), drawn AS (
  SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS c1, ('0x' || h[9:16])::BIGINT % (n + 1) AS c2, ('0x' || h[17:24])::BIGINT % 100 AS c3,
         ('0x' || h[25:32])::BIGINT % 100 AS c4 FROM given
), formed AS (
  SELECT *, least(c1, c2) AS p, greatest(c1, c2) AS e,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c3 >= 90 THEN 'plain' WHEN c4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), written AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || t[1:p] || '<S>' || t[e+1:] || '<M>' || t[p+1:e]
                      ELSE '<S>' || t[e+1:] || '<P>' || t[1:p] || '<M>' || t[p+1:e] END AS output FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN e - p END AS middle_chars,
       sha256(output) AS output_sha256, sha256(t) AS restored_sha256 FROM written
"""


def _words_sql(text: str) -> str:
    return (f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


LEXICAL_SEARCH_SQL = f"""
WITH occurring AS (
  SELECT doc_id, unnest({_words_sql("text")}) AS term FROM documents
), postings AS (SELECT doc_id, term, count(*) AS tf FROM occurring GROUP BY ALL), lengths AS (
  SELECT doc_id, sum(tf)::BIGINT AS n FROM postings GROUP BY ALL
), corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths), normal AS (
  SELECT doc_id, 50 + (50 * n * n_docs) // n_terms AS m FROM lengths, corpus
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, corpus GROUP BY term, n_docs
), asked AS (SELECT DISTINCT item_id, unnest({_words_sql("text")}) AS term FROM benchmark), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN normal USING (doc_id) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

DECONTAMINATE_SQL = f"""
WITH texts AS (SELECT doc_id, coalesce({_words_sql("text")}, []) AS w FROM documents), given AS (
  SELECT item_id, {_words_sql("text")} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM given WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT m FROM windows), grams AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM texts, sizes)
), met AS (SELECT doc_id, item_id, m, i FROM grams JOIN windows USING (m, g)), hits AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS word FROM met) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names FROM (SELECT DISTINCT doc_id, item_id FROM met)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pitman_yor": op1_pitman_yor,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_toxicity": op3_toxicity,
        "op4_pivot_search": op4_pivot_search,
        "op5_language_mix": op5_language_mix,
        "op6_quartile_digest": op6_quartile_digest,
        "op7_chat_grammar": op7_chat_grammar,
        "op8_simhash_ball": op8_simhash_ball,
        "op9_poisson_mix": op9_poisson_mix,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_fill_in_middle": op11_fill_in_middle,
        "op12_lexical_search": op12_lexical_search,
        "op13_decontaminate": op13_decontaminate,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_pivot_search": PIVOT_SEARCH_SQL, "op9_poisson_mix": POISSON_MIX_SQL, "op11_fill_in_middle": FILL_IN_MIDDLE_SQL,
        "op12_lexical_search": LEXICAL_SEARCH_SQL, "op13_decontaminate": DECONTAMINATE_SQL,
    }

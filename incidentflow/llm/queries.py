"""Registered queries of the training-data operators: thin digests of what
the operators return, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.llm import (
    byte_bpe,
    decontaminate,
    filter_audit,
    gru_lm,
    importance,
    license_scan,
    mtree,
    ngram_join,
    substring_dedup,
    token_counts,
    toxicity,
    transcripts,
    twins,
    url_filter,
)
from incidentflow.llm.common import crc_mod, read

#: The rules of the URL filter's query.
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(read(spark, sf_dir, "documents"))


def op3_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score(read(spark, sf_dir, "documents"), train=crc_mod(F.col("doc_id"), 5) != 1)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.expr(decontaminate.N_HIT).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recovered role of every turn and its canonical rendering; the model
    learns from conversations whose crc32(conv_id) mod 5 is not 0."""
    rows = transcripts.turns(read(spark, sf_dir, "conversations"))
    held_out = crc_mod(F.col("conv_id"), 5) == 0
    parsed = transcripts.parse(rows, transcripts.fit(rows, usable=~held_out))
    return parsed.select("conv_id", "turn", "role", "rendered", held_out.alias("held_out"), (F.col("role") == F.col("given")).alias("as_given"))


def op7_mtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = mtree.integer_vectors(read(spark, sf_dir, "embeddings"))
    return mtree.top_k(vectors, vectors.where("id % 100 = 0"), k=10)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_spans(read(spark, sf_dir, "documents")).select("doc_id", "n_sentences", "n_removed", "text")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = read(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), usable=~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_clauses")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = filter_audit.label_flags(read(spark, sf_dir, "labels"), {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    filters, states = filter_audit.failure_states(read(spark, sf_dir, "documents"), flags, F.col("source"))
    return filter_audit.audit(states, filters)


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.label_scores(license_scan.scan(read(spark, sf_dir, "documents")))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.start").alias("first_word"),
        F.array_max("base.start").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_ngram_join": op2_ngram_join,
    "op3_gru_lm": op3_gru_lm,
    "op4_decontamination": op4_decontamination,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_chat_format": op6_chat_format,
    "op7_mtree_search": op7_mtree_search,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_license_scan": op12_license_scan,
    "op13_importance": op13_importance,
}

#: Sentences numbered from 1; runs of two; every occurrence but the first covers
#: its sentences; covered stretches of 25 words or more are cut.
OP8_SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?\n]*|[.!?\n]+') AS s FROM documents)),
runs AS (
  SELECT *, trim(s, E' \t\n\r') || E'\n' || lead(trim(s, E' \t\n\r')) OVER w AS run FROM split WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, pos, run IS NOT NULL AND row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) > 1 AS again FROM runs),
covered AS (
  SELECT split.*, again OR coalesce(lag(again) OVER (PARTITION BY doc_id ORDER BY pos), false) AS hit
  FROM split JOIN later USING (doc_id, pos)),
stretch AS (
  SELECT *, pos - row_number() OVER (PARTITION BY doc_id, hit ORDER BY pos) AS g FROM covered),
sized AS (
  SELECT *, hit AND sum(len(regexp_extract_all(s, '[^ \t\n\r]+'))) OVER (PARTITION BY doc_id, hit, g) >= 25 AS gone FROM stretch)
SELECT d.doc_id, count(pos) AS n_sentences, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(s, '' ORDER BY pos) FILTER (NOT gone), '') AS text
FROM documents d LEFT JOIN sized USING (doc_id) GROUP BY d.doc_id
"""

OP7_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""

SQL: dict[str, str] = {
    "op7_mtree_search": OP7_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op11_filter_audit": twins.OP11_SQL,
    "op12_license_scan": twins.op12_sql(),
    "op13_importance": twins.OP13_SQL,
}

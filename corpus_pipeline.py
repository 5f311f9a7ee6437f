"""Corpus pipeline: from raw documents to encoded ones.

``STAGES`` are (name, function) pairs; each function takes
``(spark, docs, sf_dir)``, works on all documents it is given and returns a
DataFrame, the columns of documents in all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentflow.llm import byte_bpe, decontaminate, ngram_join, substring_dedup, toxicity
from incidentflow.llm.common import read
from incidentflow.session import materialise, releasing


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, fitted on the labels, rejects go.
    A null or empty text has no clause and stays; rows stay whole, repeated ones
    each; an empty table stays empty."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each near-duplicate group stays; rows
    without id and texts without words are in no group.  Repeated rows are one
    document; an id's different texts are several."""
    return ngram_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that another document has before are cut from the text: windows
    of more than 50 words, then shorter runs of whole sentences.  A column
    ``n_chars`` is counted anew; all others pass through.  Rows with a null id
    or text stay as they are; an empty table stays empty."""
    # written once: the second step reads its input three times
    with releasing(spark) as scratch:
        passages = scratch.keep(materialise(substring_dedup.cut_passages(docs), "pipeline-passages"))
    # the step's own counts are not the input's columns of that name
    own = {c: f"{c}_of_input" for c in ("n_sentences", "n_removed") if c in docs.columns}
    out = substring_dedup.dedup_spans(passages.withColumnsRenamed(own)).drop("n_sentences", "n_removed")
    out = out.withColumnsRenamed({v: k for k, v in own.items()})
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; a null or empty
    text holds none, an empty benchmark has none."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of each document (a
    null text is the empty one, without tokens)."""
    out = byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), keep_ids=True)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again;
    what a stage wrote besides is removed with its end, its result with the
    end of the next."""
    docs = read(spark, sf_dir, "documents")
    with releasing(spark) as results:
        for name, stage in STAGES:
            with releasing(spark) as scratch:
                docs = scratch.keep(materialise(stage(spark, docs, sf_dir), f"pipeline-{name}"))
            results.drop_older()
        return results.keep(docs)


#: No SQL: the toxicity model is learned and the encoding is not relational.
ORACLE_SQL = None

"""Corpus pipeline: five stages from raw documents to token ids.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet to the
shared folder and read again as the next stage's documents. All but the last return the
columns of ``documents``.

1. language ID: documents whose language is rejected go;
2. exact dedup: one document of each group of equal texts stays;
3. near dedup: one document of each group of near-duplicates stays;
4. mixing: documents stay in the numbers that bring the label domains to their target weights;
5. BPE: every document left is encoded, and decoded again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import bpe_dp, exact_dedup, language_id, near_dedup, queries, soft_mixing
from logtide.llm.common import documents, stored
from logtide.session import query_run


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier accepts."""
    return language_id.accepted(docs, queries.language_training_rows(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near-duplicates."""
    return near_dedup.keep_one(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix to the target weights takes."""
    return soft_mixing.keep_mixed(docs, queries.label_domains(spark, sf_dir), queries.TARGET_WEIGHTS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document with digests of ids and decoded text."""
    path = queries.tokenizer_path()
    both = bpe_dp.decode(bpe_dp.encode(docs, path), path)
    return both.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_domains),
    ("bpe", encode_tokens),
]

#: No SQL: classifier, signatures and encoder can't be expressed; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents at ``sf_dir``."""
    with query_run(spark, "pipeline"):
        docs = documents(spark, sf_dir)
        for name, stage in STAGES[:-1]:
            docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)

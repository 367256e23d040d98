"""Corpus pipeline: documents in, encoded clean documents out.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, secrets, sentencepiece_stream, simhash_dedup, toxicity
from tessera.llm.common import fold, table, written
from tessera.llm.queries import PIECES, secret_model


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that score 0.7 or more for toxicity."""
    learn = table(spark, sf_dir, "labels").filter(fold("doc_id", 3) != 1)
    return toxicity.reject(docs, toxicity.fit(docs, learn), 0.7)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate group."""
    return simhash_dedup.first_of_each(docs, shingle=3, radius=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    return secrets.redacted(docs, secret_model(spark), path_col="source", length_col="n_chars")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the SentencePiece ids of the text."""
    return sentencepiece_stream.encode(docs, PIECES)


STAGES = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scan", without_secrets),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can't express trained scores, token ids or reachability; tests hold the stages against brute force.
ORACLE_SQL = None

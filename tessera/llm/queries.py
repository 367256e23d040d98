"""The operators bound to the given tables: ``QUERIES`` and, where SQL can tell the rows, ``ORACLES``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (alignment, byte_bpe, decontaminate, language, licenses, quality, runs, secrets, sentencepiece_stream, simhash_dedup,
                         token_files, topk, toxicity)
from tessera.llm.common import fold, shared_path, table, written

#: Files of public tokenizers; the operators take any path.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def held_out(mod: int, rest: int, id_col: str = "doc_id"):
    return (fold(id_col, mod) == rest).alias("held_out")


def decided(scores: DataFrame, threshold: float, mod: int, rest: int) -> DataFrame:
    """doc_id, held_out, score and the decision at ``threshold``."""
    return scores.select("doc_id", held_out(mod, rest), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


@query("op1_token_output")
def op1_token_output(spark, sf):
    path = shared_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf, "documents"), path, BYTE_BPE, end_id=2)
    return token_files.catalogue(spark, path).drop("file", "row")


@query("op2_benchmark_decontamination")
def op2_benchmark_decontamination(spark, sf):
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def secret_model(spark) -> secrets.SecretModel:
    words = written(secrets.vocabulary(spark, BYTE_BPE), "words")
    return secrets.train(secrets.seed_findings(spark, words), words)


@query("op3_secret_scan")
def op3_secret_scan(spark, sf):
    return secret_model(spark).findings(table(spark, sf, "documents"), path_col="source")


@query("op4_quality")
def op4_quality(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality.fit(docs, labels.filter(fold("doc_id", 3) != 1))
    return decided(quality.score(docs, model), 0.5, 3, 1)


@query("op5_language_id")
def op5_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language.fit(docs.filter(fold("doc_id", 4) != 2))
    return language.identify(docs, model).select("doc_id", held_out(4, 2), "lang_pred", "score")


@query("op6_license_scan", licenses.ORACLE)
def op6_license_scan(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


@query("op7_exact_top_k", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM pairs)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20""")
def op7_exact_top_k(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


@query("op8_sentencepiece")
def op8_sentencepiece(spark, sf):
    """Ids of every text, their checksum, and whether decoding them gives the text back."""
    return sentencepiece_stream.round_trip(table(spark, sf, "documents"), PIECES).drop("decoded")


@query("op9_simhash_near_dedup")
def op9_simhash_near_dedup(spark, sf):
    return simhash_dedup.near_duplicates(table(spark, sf, "documents"), shingle=3, radius=2)


@query("op10_toxicity")
def op10_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels.filter(fold("doc_id", 3) != 1))
    return decided(toxicity.score(docs, model), 0.7, 3, 1)


@query("op11_token_alignment")
def op11_token_alignment(spark, sf):
    return alignment.align(table(spark, sf, "documents"), BYTE_BPE, PIECES)


@query("op12_byte_bpe")
def op12_byte_bpe(spark, sf):
    return byte_bpe.digests(table(spark, sf, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)


def planted_words(docs: DataFrame) -> DataFrame:
    """doc_id and words; of documents whose id's crc32 divides by 10, the words from some place on repeat the first of them."""
    h = F.crc32(F.col("doc_id").cast("string"))

    def repeated(words):
        n = F.size(words)
        a = F.floor(h / 10) % n
        p = F.floor((n - a) / (3 + F.floor(h / 10) % 8)) + 1
        again = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))
        return F.when((h % 10 == 0) & (n > 0), again).otherwise(words)

    # the words are worked out once, as the one element of an array
    return docs.select("doc_id", F.transform(F.array(runs.words_of("text")), repeated)[0].alias("words"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf):
    found = runs.find_runs(planted_words(table(spark, sf, "documents")))
    number = lambda c: c.cast("string")
    listed = F.transform("runs", lambda x: F.concat(number(x["start"]), F.lit(","), number(x["length"]), F.lit(","),
                                                    number(x["period"]), F.lit("\n")))
    best = found.withColumn("best", runs.strongest("runs"))
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.floor(F.try_divide(F.col("best.length") * 1000, F.col("best.period"))).alias("exponent_milli"),
                       F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))

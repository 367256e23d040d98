"""Text jobs: word count (C5), tokens per record.

Whole texts are processed: lines come from splitting each document on
newlines, words from splitting lines, all inside executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import remove_punctuation, simple_tokens, tokens_without


def lines_of(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """S2 over a text column: one row per line (column ``value``, with its line number)."""
    return docs.select(*(keep or []), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "value"))


def words(lines: DataFrame, col: str = "value") -> DataFrame:
    """C5 steps: punctuation removed, split on single spaces, empty words dropped."""
    cleaned = remove_punctuation(F.col(col))
    return (lines.select(F.explode(F.split(cleaned, " ")).alias("word"))
            .filter(F.col("word") != ""))


def word_counts(lines: DataFrame, col: str = "value") -> DataFrame:
    """(word, count); the count is combined map-side (reduceByKey)."""
    return words(lines, col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(lines: DataFrame, k: int = 15, col: str = "value") -> DataFrame:
    """The k most frequent words, ties broken by word (a bounded top-k)."""
    return word_counts(lines, col).orderBy(F.desc("count"), F.asc("word")).limit(k)


def unique_words(lines: DataFrame, col: str = "value") -> DataFrame:
    """Number of distinct words."""
    return words(lines, col).agg(F.count_distinct("word").alias("unique_words"))


def tokenize(records: DataFrame, text: str = "text", id_col: str = "id", stop_words: bool = True,
             out: str = "tokens") -> DataFrame:
    """(id, tokens array) per record."""
    expr = tokens_without(F.col(text)) if stop_words else simple_tokens(F.col(text))
    return records.select(id_col, expr.alias(out))


def token_total(tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """Total tokens in a record set."""
    return tokens.agg(F.coalesce(F.sum(F.size(col)), F.lit(0)).cast("long").alias("total_tokens"))


def longest_records(tokens: DataFrame, k: int = 1, id_col: str = "id", col: str = "tokens") -> DataFrame:
    """The k records with most tokens (ties by id)."""
    return (tokens.select(id_col, F.size(col).alias("n_tokens"))
            .orderBy(F.desc("n_tokens"), F.asc(id_col)).limit(k))

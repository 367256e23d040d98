"""Web access-log jobs (C1 parse, C2 quality report, C3 traffic reports).

The parse is one projection of native regex/cast expressions: no Python
worker, whole-stage codegen, and it works unchanged on a streaming frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.logs import clf_time, line_parts, part, request_path
from tessera.operators.relational import any_null

FIELDS = ["host", "timestamp", "path", "status", "content_size"]


def split_fields(lines: DataFrame, col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """C1 step 1: raw fields; unmatched text is null, bad numbers are null."""
    cut = lines.select(*(keep or []), line_parts(F.col(col)).alias("__parts"))
    p = lambda n: part(F.col("__parts"), n)
    return cut.select(*(keep or []), p(1).alias("host"), p(2).alias("timestamp"), request_path(p(3)).alias("path"),
                      p(4).try_cast("int").alias("status"), p(5).try_cast("bigint").alias("content_size"))


def parse(lines: DataFrame, col: str = "value") -> DataFrame:
    """(host, path, status, content_size, time); missing status/size become 0."""
    raw = split_fields(lines, col).na.fill({"content_size": 0, "status": 0})
    return raw.select("host", "path", "status", "content_size", clf_time(F.col("timestamp")).alias("time"))


def quality(lines: DataFrame, col: str = "value") -> DataFrame:
    """One row, one pass: lines, bad rows, nulls per field, lines without a trailing size."""
    raw = split_fields(lines, col, keep=[col])
    return raw.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(any_null(FIELDS)).alias("bad_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in FIELDS],
        F.count_if(_no_size(F.col(col))).alias("bad_size_lines"),
    )


def _no_size(line):
    """Whether a line does not end in a digit."""
    return ~F.right(line, F.lit(1)).between("0", "9")


def bad_lines(lines: DataFrame, col: str = "value", mark: str = "*") -> DataFrame:
    """The lines without a trailing size, each with a mark at its end."""
    return lines.filter(_no_size(F.col(col))).select(F.concat(F.col(col), F.lit(mark)).alias("line"))


def status_counts(parsed: DataFrame) -> DataFrame:
    """Requests per status with ln(count)."""
    return (parsed.groupBy("status").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("log_count", F.ln(F.col("count"))))


def frequent_hosts(parsed: DataFrame, min_count: int = 10) -> DataFrame:
    """Hosts with more than ``min_count`` requests."""
    return (parsed.groupBy("host").agg(F.count(F.lit(1)).alias("count"))
            .filter(F.col("count") > min_count))


def top_paths(parsed: DataFrame, k: int = 10) -> DataFrame:
    """The k most requested paths (ties by path)."""
    return (parsed.groupBy("path").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("path")).limit(k))


def size_stats(parsed: DataFrame) -> DataFrame:
    """Avg / min / max content size."""
    return parsed.agg(F.avg("content_size").alias("avg_size"), F.min("content_size").alias("min_size"),
                      F.max("content_size").alias("max_size"))

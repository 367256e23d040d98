"""Access logs as a stream.

The parse (C1) is stateless and row-wise, so the batch operator applies
unchanged to a streaming frame; status counts (C3) become a streaming
aggregation whose state is one row per status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import logs


def read_log_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files arriving in a folder, one row per line (column ``value``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def parsed_stream(lines: DataFrame) -> DataFrame:
    """C1 on a stream."""
    return logs.parse(lines)


def status_counts_stream(lines: DataFrame) -> DataFrame:
    """C3 status counts, maintained across micro-batches (complete output mode)."""
    return logs.parse(lines).groupBy("status").agg(F.count(F.lit(1)).alias("count"))

"""Readers, writers and catalog helpers.

All readers take explicit schemas: schema inference scans the data once more
and, on CSV, types every column as a string anyway.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml.functions import array_to_vector


# ---------------------------------------------------------------- scans

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType,
             header: bool = True, sep: str = ",") -> DataFrame:
    """CSV or TSV by position with a declared schema.

    Bad cells become null (PERMISSIVE mode); extra file columns are ignored.
    """
    return (spark.read.option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").schema(schema).csv(path))


def read_tsv_doubles(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Tab-separated numbers, every column a double."""
    schema = ", ".join(f"`{n}` double" for n in names)
    return read_csv(spark, path, schema, header=False, sep="\t")


#: The column that keeps the text of a line that could not be read as its schema says.
BAD_LINE = "bad_line"


def read_csv_checked(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = True, sep: str = ",") -> DataFrame:
    """As ``read_csv``, and the whole text of each line with an unreadable cell, or with too few or too many
    cells, in the column ``bad_line`` (null for good lines).  A line is a record; lines equal to the header are left out.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    kept = T.StructType([*kind.fields, T.StructField(BAD_LINE, T.StringType())])
    lines = spark.read.text(path)
    if header:
        lines = lines.filter(F.col("value") != sep.join(kind.names))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    cells = F.from_csv("value", ddl, {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE})
    return lines.select(cells.alias("cells")).select("cells.*")


def good_lines(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def bad_lines(checked: DataFrame) -> DataFrame:
    """(line): the lines that could not be read, as they stand in the file."""
    return checked.filter(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))


def labeled_points(lines: DataFrame, col: str = "value", sep: str = ",") -> DataFrame:
    """S6: 'label,f1,f2,...' lines to (label double, features vector)."""
    nums = F.transform(F.split(F.col(col), sep), lambda x: F.trim(x).try_cast("double"))
    cut = lines.select(nums.alias("__n")).select(F.element_at("__n", 1).alias("label"),
                                                 F.slice("__n", 2, F.size("__n") - 1).alias("__x"))
    # a row with an unreadable cell has no vector; ``unreadable_points`` counts such rows
    whole = ~F.exists("__x", lambda x: x.isNull())
    return cut.select("label", F.when(whole, array_to_vector(F.when(whole, F.col("__x")).otherwise(F.array().cast("array<double>"))))
                      .alias("features"))


def unreadable_points(points: DataFrame) -> DataFrame:
    """One row: how many rows lack a label or a vector because a cell could not be read."""
    return points.agg(F.count_if(F.col("label").isNull()).alias("bad_labels"),
                      F.count_if(F.col("features").isNull()).alias("bad_vectors"))


def positional_fields(lines: DataFrame, col: str = "value", sep: str = "\t",
                      keep: list[str] | None = None) -> DataFrame:
    """S7: 'label<TAB>v0<TAB>v1...' to (label double, features array<struct<pos,value>>).

    Newlines are removed first (X18); positions start at 0 after the label.
    The text is split once, in a projection of its own.
    """
    cut = lines.select(*(keep or []), F.split(F.replace(F.col(col), F.lit("\n"), F.lit("")), sep).alias("__parts"))
    fields = F.transform(F.slice("__parts", 2, F.greatest(F.size("__parts") - 1, F.lit(0))),
                         lambda v, i: F.struct(i.cast("long").alias("pos"), v.alias("value")))
    return cut.select(*(keep or []), F.element_at("__parts", 1).try_cast("double").alias("label"), fields.alias("features"))


def from_rows(spark: SparkSession, rows: list, schema: str | T.StructType,
              partitions: int | None = None) -> DataFrame:
    """A table from local tuples, optionally spread over n partitions."""
    df = spark.createDataFrame(rows, schema)
    return df.repartition(partitions) if partitions else df


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the catalog by name."""
    return spark.table(name)


def select_text(df: DataFrame, *expressions: str) -> DataFrame:
    """Columns given as SQL expression strings."""
    return df.selectExpr(*expressions)


def sql_over(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A SQL text over frames, each named as a view first."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def keyed_text(df: DataFrame, id_col: str, text_cols: list[str], out: str = "text") -> DataFrame:
    """(id, text) with the text fields joined by one space; null fields skipped."""
    return df.select(F.col(id_col).alias("id"), F.concat_ws(" ", *[F.col(c) for c in text_cols]).alias(out))


# ------------------------------------------------------------- catalog (K1-K2)

def register(df: DataFrame, name: str) -> DataFrame:
    """K1: name a frame for SQL."""
    df.createOrReplaceTempView(name)
    return df


def drop_view(spark: SparkSession, name: str) -> bool:
    """K2: drop a temporary view if it exists."""
    return spark.catalog.dropTempView(name)


def describe_columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """K2: (column, type) of a registered table."""
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(name)]


def list_tables(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


# --------------------------------------------------------------- sinks (K3-K4)

def write_first_lines(spark: SparkSession, src: str, dst: str, n: int = 1000) -> None:
    """K3: the first n lines of a text file into another (the limit is the feature)."""
    spark.read.text(src).limit(n).write.mode("overwrite").text(dst)


def write_tsv(df: DataFrame, path: str, header: bool = False) -> None:
    """K4: tab-separated text export, one part file per partition."""
    df.write.mode("overwrite").option("sep", "\t").option("header", header).csv(path)


# -------------------------------------------------- bounded results (K5-K9)

def head_rows(df: DataFrame, n: int = 20) -> list:
    """K5: at most n rows to the driver."""
    return df.limit(n).collect()


def to_local(df: DataFrame, max_rows: int = 100_000):
    """K7: a bounded frame to pandas; refuses frames over ``max_rows``."""
    rows = df.limit(max_rows + 1)
    pdf = rows.toPandas()
    if len(pdf) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate or limit first")
    return pdf


def partition_sizes(df: DataFrame) -> DataFrame:
    """K9: rows per partition, computed in the executors."""
    return df.groupBy(F.spark_partition_id().alias("partition")).count()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """K9: the plan as text (what ``explain`` prints)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def cached(df: DataFrame) -> bool:
    """K8: is the frame marked for caching?"""
    return df.is_cached


def release(df: DataFrame) -> DataFrame:
    """K8: drop a frame's cached blocks."""
    return df.unpersist()

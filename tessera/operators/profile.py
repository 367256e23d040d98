"""Aggregations and profiles.

Every aggregate here is a partial/final hash aggregate: rows are combined
map-side before the shuffle, so a hot group costs one row per task, not one
row per input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.joins import one_row

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def count_by(df: DataFrame, *keys: str | Column, name: str = "count") -> DataFrame:
    """A2: rows per group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_and_mean(df: DataFrame, key: str, value: str, count_name: str = "count",
                   mean_name: str = "average") -> DataFrame:
    """A3: count and average of a value per group."""
    return df.groupBy(key).agg(F.count(value).alias(count_name), F.avg(value).alias(mean_name))


def sum_all(df: DataFrame) -> DataFrame:
    """A5: global sum of every numeric column, named ``sum(col)``."""
    return df.agg(*[F.sum(c).alias(f"sum({c})") for c in numeric_columns(df)])


def describe_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, sample stddev, min, max per column, in long form with text values.

    Numbers and texts alike, as a user expects of ``describe``: min and max keep the column's
    own type until they are printed (a bigint beyond 2^53 stays exact), mean and stddev are null
    for texts.  One aggregation pass computes all statistics; the result (5 rows a column) is
    unpivoted with ``inline``.
    """
    numeric = set(numeric_columns(df))
    cols = cols or [f.name for f in df.schema.fields if f.name in numeric or isinstance(f.dataType, T.StringType)]
    none = F.lit(None).cast("double")
    wide = df.agg(*[a for c in cols for a in (
        F.count(c).alias(f"{c}__count"), (F.avg(F.col(c).cast("double")) if c in numeric else F.max(none)).alias(f"{c}__mean"),
        (F.stddev_samp(F.col(c).cast("double")) if c in numeric else F.max(none)).alias(f"{c}__stddev"),
        F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("summary"), F.col(f"`{c}__{s}`").cast("string").alias("value"))
        for c in cols for s in ("count", "mean", "stddev", "min", "max")])))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A10: nulls per column, all columns in one pass."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def share_of_total(grouped: DataFrame, count_col: str = "count", out: str = "percent") -> DataFrame:
    """Each group's share of the total.

    The total is one more aggregate over the grouped frame, brought to the
    driver as a scalar (one row) and applied as a literal.
    """
    total = one_row(grouped.agg(F.sum(count_col).alias("t")))["t"]
    return grouped.select(*grouped.columns, (F.col(count_col).cast("double") / F.lit(total)).alias(out))


def reduce_by_key(df: DataFrame, key: str, value: str, out: str = "sum") -> DataFrame:
    """reduceByKey(+) is a map-side combined sum per key."""
    return df.groupBy(key).agg(F.sum(value).alias(out))


def grouped_values(df: DataFrame, key: str, value: str, tie: str) -> DataFrame:
    """The values of each group in order: (key, value, pos), pos from 0 within the group.

    A group's list is kept as rows.  Positions come from one global order on
    (key, value, tie), cut into buckets, less the rows of the groups before, so
    a hot group spans many tasks and is never gathered into one row or task.
    """
    from tessera.operators.keys import row_index
    ordered = row_index(df.select(key, value, tie), [key, value, tie], name="__at")
    firsts = ordered.groupBy(F.col(key).alias("__key")).agg(F.min("__at").alias("__first"))   # one row a group
    return (ordered.join(firsts, F.col(key).eqNullSafe(F.col("__key")))
            .select(key, value, tie, (F.col("__at") - F.col("__first")).alias("pos")))


def count_via_grouping(df: DataFrame, key: str) -> DataFrame:
    """The count a grouped list would give, without building the list."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def blank_lines(df: DataFrame, col: str = "value") -> DataFrame:
    """Number of empty lines (an aggregate, not a side effect)."""
    return df.agg(F.count_if(F.col(col) == "").alias("blank_lines"))


def pair_relation(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """M9: slope, intercept, R2 and correlation of target on each feature, one pass.

    Each row is unpivoted to its (feature, x, y) and one set of co-moments is kept for a feature; the four
    statistics are derived from it.  The aggregate stays small however many features there are.  Pairs with a null are left
    out; slope and intercept are null for a constant feature, R2 is then null too, and 1 for a constant target.
    """
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x"),
                                                  F.col(target).cast("double").alias("y")) for f in features])))
    whole = F.col("x").isNotNull() & F.col("y").isNotNull()
    m = (pairs.select("feature", F.when(whole, F.col("x")).alias("x"), F.when(whole, F.col("y")).alias("y")).groupBy("feature")
         .agg(F.avg("x").alias("mx"), F.avg("y").alias("my"), F.var_pop("x").alias("vx"), F.var_pop("y").alias("vy"),
              F.covar_pop("x", "y").alias("c")))
    slope = F.when(F.col("vx") != 0, F.col("c") / F.col("vx"))
    r2 = F.when(F.col("vx") != 0, F.when(F.col("vy") == 0, 1.0).otherwise(F.col("c") * F.col("c") / (F.col("vx") * F.col("vy"))))
    corr = F.when((F.col("vx") != 0) & (F.col("vy") != 0), F.col("c") / F.sqrt("vx") / F.sqrt("vy"))
    return m.select("feature", slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept"),
                    r2.alias("r2"), corr.alias("corr"))


def histogram(df: DataFrame, col: str, width: float, origin: float = 0.0) -> DataFrame:
    """Fixed-width bins by floor((x - origin) / width), with counts."""
    b = F.floor((F.col(col) - F.lit(origin)) / F.lit(width))
    return (df.filter(F.col(col).isNotNull()).groupBy(b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .withColumn("lower", F.col("bin") * F.lit(width) + F.lit(origin)))

"""Relational building blocks.

Thin, named compositions of DataFrame operators.  They stay declarative so
Catalyst can push filters and prune columns into the scans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ----------------------------------------------------------- projections

def project(df: DataFrame, *cols: str | Column) -> DataFrame:
    """Select columns / expressions (``'*'`` allowed)."""
    return df.select(*cols)


def add_constant(df: DataFrame, name: str, value) -> DataFrame:
    """P5: constant column."""
    return df.withColumn(name, F.lit(value))


def explode_array(df: DataFrame, array_col: str, keep: list[str], pos: str | None = "pos",
                  value: str = "value") -> DataFrame:
    """One row per array element (with its position when ``pos`` is set)."""
    if pos:
        return df.select(*keep, F.posexplode(array_col).alias(pos, value))
    return df.select(*keep, F.explode(array_col).alias(value))


def bucket(c: str | Column, bounds: list[tuple[float, float, object]], default) -> Column:
    """CASE WHEN lo <= c <= hi THEN label ... ELSE default."""
    expr = None
    for lo, hi, label in bounds:
        cond = (_c(c) >= lo) & (_c(c) <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


# ---------------------------------------------------------------- filters

def where(df: DataFrame, cond: Column) -> DataFrame:
    """predicate filter (kept native so it is pushed into the scan)."""
    return df.filter(cond)


def lookup_one(df: DataFrame, col: str, value) -> DataFrame:
    """rows whose column equals value; raises unless exactly one matches."""
    hit = df.filter(F.col(col) == value)
    n = hit.limit(2).count()
    if n != 1:
        raise AssertionError(f"expected exactly one row with {col} == {value!r}, found {n if n < 2 else '2+'}")
    return hit


def drop_nan_null(df: DataFrame, col: str) -> DataFrame:
    """keep rows whose value is neither NaN nor null."""
    return df.filter(F.col(col).isNotNull() & ~F.isnan(col))


def not_in(df: DataFrame, col: str, values: list | DataFrame, other_col: str | None = None) -> DataFrame:
    """Rows whose key is absent from a literal list or from another table."""
    if isinstance(values, DataFrame):
        other = values.select(F.col(other_col or col).alias("__k")).filter(F.col("__k").isNotNull())
        return df.join(other, df[col] == other["__k"], "left_anti")
    return df.filter(~F.col(col).isin(values))


def any_null(cols: list[str]) -> Column:
    """true when any column is null."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def not_matching(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """rows whose text does not match the regex."""
    return df.filter(~F.col(col).rlike(pattern))


def having(grouped: DataFrame, cond: Column) -> DataFrame:
    """F8: filter on an aggregated frame (stays above the aggregate)."""
    return grouped.filter(cond)


def fill_nulls(df: DataFrame, defaults: dict) -> DataFrame:
    """per-column null replacement."""
    return df.na.fill(defaults)


# ------------------------------------------------------------------ joins

JOIN_KINDS = {"inner": "inner", "outer": "full", "full": "full", "left_outer": "left", "left": "left",
              "right_outer": "right", "right": "right", "leftsemi": "left_semi", "left_semi": "left_semi",
              "semi": "left_semi", "leftanti": "left_anti", "left_anti": "left_anti", "anti": "left_anti"}


def join_on(left: DataFrame, right: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Equi-join on shared column names; the key appears once (coalesced for full)."""
    return left.join(right, key, JOIN_KINDS[how])


def join_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              how: str = "inner") -> DataFrame:
    """Join on differently named keys, keeping only the left key."""
    return left.join(right, left[left_key] == right[right_key], JOIN_KINDS[how]).drop(right[right_key])


def lookup_join(fact: DataFrame, dim: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Enrich facts from a dimension; Catalyst and AQE choose the join by size in bytes."""
    return fact.join(dim, key, JOIN_KINDS[how])


def with_group_stats(rows: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Attach per-group statistics; key kept once."""
    return rows.join(stats, key, "inner")


# ------------------------------------------------------- sorts and top-k

def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First k rows of an order (one plan: TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*order).limit(k)


# ------------------------------------------------------------------- sets

def union_bag(*frames: DataFrame, by_name: bool = False) -> DataFrame:
    """Bag union by position (or by name)."""
    if by_name:
        return reduce(lambda a, b: a.unionByName(b), frames)
    return reduce(lambda a, b: a.unionAll(b), frames)


def shared_elements(a: str | Column, b: str | Column) -> Column:
    """Distinct elements present in both arrays."""
    return F.array_intersect(_c(a), _c(b))

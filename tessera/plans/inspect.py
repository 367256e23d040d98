"""Plan inspection (K9) and the plan properties the tests assert.

Everything goes through ``DataFrame.explain`` -- the public plan printer.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from tessera.sources.readers import plan_text


def physical_plan(df: DataFrame) -> str:
    return plan_text(df, "formatted")


def has_cartesian(df: DataFrame) -> bool:
    """True when the plan multiplies rows without a join key."""
    p = physical_plan(df)
    return "CartesianProduct" in p or "BroadcastNestedLoopJoin" in p


def runs_python(df: DataFrame) -> bool:
    """True when rows leave the JVM for a Python worker."""
    p = physical_plan(df)
    return any(k in p for k in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                                "PythonUDF"))


def pushed_filters(df: DataFrame) -> list[str]:
    """The PushedFilters lists of every scan."""
    return re.findall(r"PushedFilters: \[([^\]]*)\]", physical_plan(df))


def read_schemas(df: DataFrame) -> list[str]:
    """The ReadSchema of every scan (pruned columns)."""
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", physical_plan(df))


def single_partition_window(df: DataFrame) -> bool:
    """True when a window runs without partitioning (all rows into one task)."""
    p = physical_plan(df)
    return "Window" in p and "SinglePartition" in p


def exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges (broadcasts not counted) in the physical plan tree."""
    tree = physical_plan(df).split("\n\n")[0]
    return len(re.findall(r"(?<!Broadcast)Exchange \(\d+\)", tree))


def codegen_stages(df: DataFrame) -> int:
    """Number of whole-stage-codegen spans (``*(n)`` markers of the simple plan)."""
    return len(set(re.findall(r"\*\((\d+)\)", plan_text(df, "simple"))))

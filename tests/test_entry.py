"""The driver contract: entry, queries, oracles (small-scale oracle run)."""

import math

import duckdb
import pandas as pd
import pytest

from conftest import SF0001

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

# fast, deterministic subset checked in the unit suite; tools/oracle_check.py runs them all
FAST = ["popular_items", "group_count", "join_full", "agg_global", "log_parse", "word_count_top",
        "row_index", "split_hash", "cosine_pairs", "roc_points", "covariance_long", "hash_features_long",
        "kv_group", "dedupe_latest", "hash_features_prime", "gold_match", "log_bad_lines", "agg_describe", "linreg_exact",
        "logit_hashed", "variance_explained"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["movieId", "title", "count", "average"]
    assert all(r["count"] >= 30 for r in rows)
    assert [r.average for r in rows] == sorted((r.average for r in rows), reverse=True)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, (int, float)) and not isinstance(v, bool):
        return (1, repr(float(v)))
    return (2, str(v))


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    got = _rows(entry.queries()[name](spark, SF0001).toPandas())
    want = _rows(duck.execute(entry.oracle_sql()[name]).df())
    assert got == want

"""Relational operators on the literal fixtures (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import keys, profile
from tessera.operators import relational as rel

LEFT = [("Alice", 1), ("Bob", 2), ("Bill", 4)]
RIGHT = [("jia", 165), ("Bob", 150), ("Bill", 157)]


@pytest.fixture()
def pair(spark):
    return (spark.createDataFrame(LEFT, "name string, age long"),
            spark.createDataFrame(RIGHT, "name string, heigh long"))


@pytest.mark.parametrize("how,rows,cols", [("inner", 2, 3), ("outer", 4, 3), ("left_outer", 3, 3),
                                           ("right_outer", 3, 3), ("leftsemi", 2, 2), ("anti", 1, 2)])
def test_join_kinds(pair, how, rows, cols):
    out = rel.join_on(*pair, "name", how)
    assert out.count() == rows
    assert len(out.columns) == cols
    assert out.columns.count("name") == 1


def test_full_join_coalesces_key(pair):
    names = {r["name"] for r in rel.join_on(*pair, "name", "outer").collect()}
    assert names == {"Alice", "Bob", "Bill", "jia"}


def test_join_keys_keeps_left_key(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 3.0)], "movieId long, average double")
    b = spark.createDataFrame([(1, "x"), (3, "y")], "ID long, title string")
    out = rel.join_keys(a, b, "movieId", "ID")
    assert out.columns == ["movieId", "average", "title"]
    assert [tuple(r) for r in out.collect()] == [(1, 2.0, "x")]


def test_sum_all(pair):
    out = profile.sum_all(pair[0]).collect()[0]
    assert out["sum(age)"] == 7


def test_distinct_and_dedupe(spark):
    df = spark.createDataFrame([("Joe", 1), ("Joe", 1), ("Anna", 15), ("Anna", 12), ("Ravi", 5)],
                               "name string, score long")
    assert df.distinct().count() == 4
    first = {r["name"]: r["score"] for r in keys.dedupe_first(df, ["name"], "score").collect()}
    assert first == {"Joe": 1, "Anna": 12, "Ravi": 5}


def test_lookup_one(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "t string")
    assert rel.lookup_one(df, "t", "a").count() == 1
    with pytest.raises(AssertionError):
        rel.lookup_one(df, "t", "b")
    with pytest.raises(AssertionError):
        rel.lookup_one(df, "t", "z")


def test_drop_nan_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "prediction double")
    assert [r[0] for r in rel.drop_nan_null(df, "prediction").collect()] == [1.0]


def test_not_in_list_and_table(spark):
    items = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "ID long, title string")
    rated = spark.createDataFrame([(1,), (3,), (None,)], "movieId long")
    a = {r.ID for r in rel.not_in(items, "ID", [1, 3]).collect()}
    b = {r.ID for r in rel.not_in(items, "ID", rated, "movieId").collect()}
    assert a == b == {0, 2, 4, 5}


def test_union_widens_int_to_long(spark):
    a = spark.createDataFrame([(1, 2)], "u int, m int")
    b = spark.createDataFrame([(3, 4)], "u long, m long")
    out = rel.union_bag(a, b)
    assert dict(out.dtypes)["u"] == "bigint"
    assert out.count() == 2


def test_top_k_ties_broken(spark):
    df = spark.createDataFrame([("a", 2), ("b", 2), ("c", 1)], "w string, c long")
    out = rel.top_k(df, 2, F.desc("c"), F.asc("w")).collect()
    assert [r.w for r in out] == ["a", "b"]


def test_share_of_total(spark):
    g = spark.createDataFrame([(1, 1), (2, 3)], "b int, count long")
    out = {r.b: r.percent for r in profile.share_of_total(g).collect()}
    assert out == {1: 0.25, 2: 0.75}


def test_describe_long_matches_describe(spark):
    df = spark.createDataFrame([(1.0, 2), (3.0, 5), (8.0, 7)], "x double, y long")
    long = {(r.column, r.summary): r.value for r in profile.describe_long(df).collect()}
    ref = {r.summary: r for r in df.describe().collect()}
    for s in ("count", "mean", "stddev", "min", "max"):
        assert math.isclose(float(long[("x", s)]), float(ref[s]["x"]), rel_tol=1e-9)
        assert math.isclose(float(long[("y", s)]), float(ref[s]["y"]), rel_tol=1e-9)


def test_describe_long_texts_and_exact_bounds(spark):
    df = spark.createDataFrame([("pear", 2 ** 53 + 1), ("apple", 3), (None, None)], "t string, n long")
    got = {(r.column, r.summary): r.value for r in profile.describe_long(df).collect()}
    assert [got["t", s] for s in ("count", "mean", "stddev", "min", "max")] == ["2", None, None, "apple", "pear"]
    assert (got["n", "min"], got["n", "max"]) == ("3", str(2 ** 53 + 1))


def test_null_counts(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (None, None)], "a long, b string")
    r = profile.null_counts(df).collect()[0]
    assert (r.a, r.b) == (2, 2)


def test_count_via_grouping_equals_reduce(spark):
    df = spark.createDataFrame([(w, 1) for w in ["cat", "elephant", "rat", "rat", "cat"]], "w string, one long")
    a = {r.w: r["count"] for r in profile.count_via_grouping(df, "w").collect()}
    b = {r.w: r["sum"] for r in profile.reduce_by_key(df, "w", "one").collect()}
    assert a == b == {"cat": 2, "elephant": 1, "rat": 2}


def test_bucket_expression(spark):
    df = spark.createDataFrame([(0.5,), (-1.5,), (3.0,)], "x double")
    b = rel.bucket("x", [(-1.0, 1.0, 1), (-2.0, 2.0, 2)], 3)
    assert [r[0] for r in df.select(b).collect()] == [1, 2, 3]


def test_histogram(spark):
    df = spark.createDataFrame([(1.0,), (9.9,), (10.0,), (25.0,)], "x double")
    out = {r.bin: (r["count"], r.lower) for r in profile.histogram(df, "x", 10.0).collect()}
    assert out == {0: (2, 0.0), 1: (1, 10.0), 2: (1, 20.0)}

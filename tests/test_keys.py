"""Global order without one partition; stable splits and samples."""

import datetime
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera import queries as q
from tessera.operators import keys
from tessera.plans import inspect as pi


def test_row_index_many_buckets(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    out = keys.row_index(df, "k", buckets=6).collect()
    assert [i for _, i in sorted((r.k, r.idx) for r in out)] == list(range(5000))
    assert [r.k for r in sorted(out, key=lambda r: r.idx)] == sorted(r.k for r in out)


def test_running_sums_descending(spark):
    vals = [(i, i % 3) for i in range(100)]
    df = spark.createDataFrame(vals, "k long, v long").repartition(5)
    out = {r.k: r.cum for r in keys.running_sums(df, "-k", {"cum": "v"}, buckets=4).collect()}
    acc, want = 0, {}
    for k, v in sorted(vals, reverse=True):
        acc += v
        want[k] = acc
    assert out == want


def test_mixed_directions_nulls_texts_and_dates(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(None if i % 7 == 0 else f"s{i % 5}", None if i % 11 == 0 else day + datetime.timedelta(i % 13), i) for i in range(400)]
    df = spark.createDataFrame(rows, "s string, d date, i long")
    for order in (["s", "-d", "i"], ["-s", "d", "-i"], ["-d", "-i"]):
        want = df.orderBy(*[F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order]).collect()
        got = sorted(keys.row_index(df, order, buckets=9).collect(), key=lambda r: r.idx)
        assert [r.i for r in got] == [r.i for r in want] and [r.idx for r in got] == list(range(400))


def test_a_value_of_a_third_of_the_rows_is_cut_by_the_rest_of_the_key(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    cuts = keys._cut_points(df, keys._order(["k", "id"]), 12)
    assert sum(c[0] == 5 for c in cuts) > 1
    got = sorted(keys.row_index(df, ["k", "id"], buckets=12).collect(), key=lambda r: r.idx)
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_two_level_bucket_search(spark):
    df = spark.range(0, 20_000).select((F.col("id") * 7919 % 20_011).alias("k"))
    cuts = [(i * 200,) for i in range(1, 100)]
    got = df.select("k", keys._bucket(df, [("k", True)], cuts).alias("b")).collect()
    assert all(r.b == sum(c[0] <= r.k for c in cuts) for r in got)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_index_survives_a_cleared_cache(spark, sf):
    path = f"/root/testdata/{sf}"
    li = spark.read.parquet(f"{path}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    df = keys.row_index(li, ["l_orderkey", "-l_linenumber", "l_partkey", "l_suppkey"])
    spark.catalog.clearCache()
    got = df.agg(F.count("*"), F.countDistinct("idx"), F.min("idx"), F.max("idx"), F.sum(F.col("idx") * F.col("l_partkey"))).first()
    want = duckdb.sql(f"""SELECT count(*), count(DISTINCT i), min(i), max(i), CAST(sum(i * l_partkey) AS BIGINT) FROM (
        SELECT l_partkey, row_number() OVER (ORDER BY l_orderkey, l_linenumber DESC, l_partkey, l_suppkey) - 1 AS i
        FROM '{path}/lineitem.parquet')""").df().iloc[0].tolist()
    assert list(got) == want


def test_no_python_and_no_cached_copy(spark):
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    df = q.QUERIES["row_index"](spark, "/root/testdata/sf0.001")
    assert not pi.runs_python(df) and df.count() > 0
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_grouped_values_positions(spark):
    rows = [("a", 3, 1), ("b", 1, 2), ("a", 1, 3), ("a", 1, 4), (None, 9, 5)]
    from tessera.operators.profile import grouped_values
    got = sorted((r.k or "", r.pos, r.v, r.t) for r in
                 grouped_values(spark.createDataFrame(rows, "k string, v int, t int"), "k", "v", "t").collect())
    assert got == [("", 0, 9, 5), ("a", 0, 1, 3), ("a", 1, 1, 4), ("a", 2, 3, 1), ("b", 0, 1, 2)]


def test_dedupe_is_a_hash_aggregate_over_digests(spark):
    df = q.QUERIES["dedupe_latest"](spark, "/root/testdata/sf0.001")
    plan = pi.physical_plan(df)
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    rows = spark.createDataFrame([("x", None, 3), ("x", None, 1), ("x", "", 2), ("x|", "y", 4)], "a string, b string, i int")
    assert sorted(r.i for r in keys.dedupe_first(rows, ["a", "b"], "i").collect()) == [1, 2, 4]


def test_hash_split_stable_under_layout(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "key")
    a = {r.key: r.split for r in keys.hash_split(df, "key", [0.6, 0.2, 0.2], 5).collect()}
    b = {r.key: r.split for r in keys.hash_split(df.repartition(9), "key", [0.6, 0.2, 0.2], 5).collect()}
    assert a == b
    share = sum(1 for v in a.values() if v == "0") / len(a)
    assert 0.55 < share < 0.65


def test_sample_exact(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "key")
    s1 = {r.key for r in keys.sample_exact(df, "key", 200, 11).collect()}
    s2 = {r.key for r in keys.sample_exact(df.repartition(3), "key", 200, 11).collect()}
    assert len(s1) == 200 and s1 == s2


def test_hash_sample_fraction(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "key")
    n = keys.hash_sample(df, "key", 0.1).count()
    assert 400 < n < 600
    assert keys.bernoulli_sample(df, 0.1, seed=3).count() > 0


def test_row_index_more_buckets_than_rows(spark):
    df = spark.createDataFrame([(30,), (10,), (20,)], "k long")
    out = sorted((r.k, r.idx) for r in keys.row_index(df, "k", buckets=8).collect())
    assert out == [(10, 0), (20, 1), (30, 2)]


def test_running_sums_empty_input(spark):
    df = spark.createDataFrame([], "k long, v long")
    assert keys.running_sums(df, "k", {"cum": "v"}).count() == 0


def test_two_levels_of_buckets_give_the_same_order(spark):
    rows = [(None if i % 29 == 0 else i * 7919 % 501, f"t{i % 17}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, t string, i long")
    for order in (["k", "-t", "i"], ["-k", "i"]):
        want = df.orderBy(*[F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order]).collect()
        got = sorted(keys.row_index(df, order, buckets=120, coarse=8).collect(), key=lambda r: r.idx)
        assert [r.idx for r in got] == list(range(6000)) and [r.i for r in got] == [r.i for r in want]
    sums = keys.running_sums(df, ["i"], {"cum": "i"}, buckets=200, coarse=10).orderBy("i").collect()
    assert [r["cum"] for r in sums] == [i * (i + 1) // 2 for i in range(6000)]


def test_the_sample_is_its_share_and_buckets_are_even(spark):
    df = spark.range(0, 40_000).select((F.col("id") * 7919 % 40_009).alias("k"))
    assert 300 < keys._sampled(df, [("k", True)], 40_000, 400).count() < 520
    cuts = keys._cut_points(df, [("k", True)], 10, 40_000)
    sizes = [r["count"] for r in df.groupBy(keys._bucket(df, [("k", True)], cuts).alias("b")).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 4000
    fine = keys._fine_cuts(df, [("k", True)], 100, 40_000, cuts).collect()
    assert len(fine) == 10 and all(len(g) <= keys._FAN for r in fine for g in r["__cuts"])


def test_sample_exact_takes_the_least_hashes(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "key")
    for n in (0, 1, 37, 3000, 5000):
        want = sorted(range(3000), key=lambda i: (int(hashlib.md5(f"11:{i}".encode()).hexdigest()[:8], 16), i))[:n]
        assert sorted(r.key for r in keys.sample_exact(df, "key", n, 11).collect()) == sorted(want)

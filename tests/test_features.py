"""Categorical features: the animal samples and md5 buckets."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.hashing import md5_bucket
from tessera.operators import features as feat

SAMPLES = [(0, [(0, "mouse"), (1, "black")]),
           (1, [(0, "cat"), (1, "tabby"), (2, "mouse")]),
           (2, [(0, "bear"), (1, "black"), (2, "salmon")])]
SCHEMA = "id long, features array<struct<pos:bigint,value:string>>"


def test_distinct_pairs_and_categories(spark):
    rec = spark.createDataFrame(SAMPLES, SCHEMA)
    d = feat.ohe_dictionary(rec)
    assert d.count() == 7
    ids = [(r.pos, r.value, r.ohe_id) for r in d.orderBy("ohe_id").collect()]
    assert ids[0] == (0, "bear", 0) and ids[-1] == (2, "salmon", 6)
    cc = {r.featureNumber: r.n_categories for r in feat.category_counts(rec).collect()}
    assert cc == {0: 3, 1: 2, 2: 2}


def test_ohe_unseen_dropped_width_fixed(spark):
    rec = spark.createDataFrame(SAMPLES, SCHEMA)
    d = feat.ohe_dictionary(rec.filter("id < 2"))
    enc = feat.ohe_encode(rec, d)
    per = {r.id: r.n for r in enc.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert per == {0: 2, 1: 3, 2: 1}          # bear and salmon unseen; black known
    rows = feat.to_vectors(feat.with_one_hot(rec, d, [0, 1, 2]), 5).withColumnRenamed("features", "v").collect()
    vecs = {r.id: r.v for r in rows}
    assert all(v.size == 5 for v in vecs.values())
    assert sorted(vecs[0].indices.tolist()) == sorted(
        r.ohe_id for r in d.filter("(pos = 0 AND value = 'mouse') OR (pos = 1 AND value = 'black')").collect())


def test_vectors_of_repeated_ids_and_empty_records(spark):
    rec = spark.createDataFrame(SAMPLES + [(0, [(0, "cat")]), (9, [])], SCHEMA)
    hashed = feat.to_vectors(feat.with_hashed(rec, 1 << 15), 1 << 15, out="v").collect()
    assert len(hashed) == 5 and all(r.v.size == 1 << 15 for r in hashed)
    assert [r.v.numNonzeros() for r in hashed if r.id == 9] == [0]
    one_hot = feat.with_one_hot(rec, feat.ohe_dictionary(rec), [0, 1, 2]).collect()
    assert sorted(len(r.entries) for r in one_hot) == [0, 1, 2, 3, 3]


def test_hashed_counts_of_colliding_features(spark):
    rec = spark.createDataFrame([(1, [(i, "v") for i in range(20)] + [(0, "v")])], SCHEMA)
    got = {r["index"]: r["weight"] for r in feat.hash_features(rec, 3).collect()}
    want = {}
    for i in range(20):
        b = int(hashlib.md5(f"v:{i}".encode()).hexdigest(), 16) % 3
        want[b] = want.get(b, 0.0) + 1.0
    assert got == want


def test_sparse_to_row_repeated_and_outside_positions(spark):
    rec = spark.createDataFrame([(1, [(0, "a"), (1, "b"), (0, "c")])], SCHEMA)
    row = feat.sparse_to_row(rec, "features", 2, keep=["id"]).first()
    assert (row.f0, row.f1) == ("c", "b")
    with pytest.raises(Exception, match="outside 0..0"):
        feat.sparse_to_row(rec, "features", 1, keep=["id"]).collect()


def test_sparse_to_row(spark):
    rec = spark.createDataFrame(SAMPLES, SCHEMA)
    rows = {r.id: (r.f0, r.f1, r.f2) for r in feat.sparse_to_row(rec, "features", 3, keep=["id"]).collect()}
    assert rows[0] == ("mouse", "black", None)
    assert rows[2] == ("bear", "black", "salmon")


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=8))
def test_md5_bucket_matches_big_integer(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    for buckets in (1 << 15, 1 << 20, 1_000_003, 7, 1):
        got = [r[0] for r in df.select(md5_bucket(F.col("w"), buckets)).collect()]
        assert got == [int(hashlib.md5(w.encode("utf-8")).hexdigest(), 16) % buckets for w in words]


def test_hash_features_counts(spark):
    rec = spark.createDataFrame(SAMPLES, SCHEMA)
    h = feat.hash_features(rec, 1 << 15)
    got = {(r["id"], r["index"]): r["weight"] for r in h.collect()}
    want = {}
    for i, fs in SAMPLES:
        for pos, v in fs:
            b = int(hashlib.md5(f"{v}:{pos}".encode()).hexdigest(), 16) % (1 << 15)
            want[(i, b)] = want.get((i, b), 0.0) + 1.0
    assert got == want


def test_sparsity(spark):
    enc = spark.createDataFrame([(0, 1), (0, 2), (1, 3)], "id long, index int")
    assert feat.sparsity(enc, 4).collect()[0][0] == (2 / 4 + 1 / 4) / 2


def test_digest_bucket_reads_two_signed_halves(spark):
    from tessera.functions.hashing import digest_bucket
    digests = ["f" * 32, "0" * 32, "8" + "0" * 31, "7" + "f" * 31, "0" * 16 + "8" + "0" * 15, "f" * 16 + "0" * 16, "0" * 16 + "f" * 16]
    df = spark.createDataFrame([(d,) for d in digests], "d string")
    for buckets in (3, 1_000_003, (1 << 31) - 1):
        bucket = digest_bucket(F.col("d"), buckets)
        assert [r[0] for r in df.select(bucket).collect()] == [int(d, 16) % buckets for d in digests]
        assert str(bucket).count("conv(") == 2


def test_hashed_features_by_arrow_batches(spark):
    from tessera.functions.hashing import md5_buckets

    words = ["", "a:0", "日本:1", *(f"w:{i}" for i in range(50))]
    for n in (1, 3, 1 << 20, 1_000_003, 1 << 31):
        want = [int(hashlib.md5(w.encode()).hexdigest(), 16) % n for w in words]
        assert md5_buckets(n)([w.encode() for w in words]).tolist() == want
    with pytest.raises(ValueError, match="num_buckets"):
        feat.with_hashed_batches(spark.createDataFrame(SAMPLES, SCHEMA), 0)
    rows = [(1, None), (1, [(1, "a:1"), (1, "a"), (1, "a"), (11, "")]), (2, [None, (None, "a"), (3, None), (4, "x")]), (3, [None]), (4, [])]
    hashed = feat.with_hashed_batches(spark.createDataFrame(rows, SCHEMA), 1 << 31).coalesce(1)
    plan = hashed._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "Exchange" not in plan
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest(), 16) % (1 << 31)
    got = [None if r.entries is None else [tuple(e) for e in r.entries] for r in hashed.collect()]
    # features without a position or value have no bucket and come behind the record's last one
    assert got == [None, sorted((bucket(w), 1.0) for w in ("a:1:1", "a:1", ":11")), [(bucket("x:4"), 4.0)], [(None, 1.0)], []]

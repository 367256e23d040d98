import math
import random

from tessera.llm import topk


def brute(rows, queries, k, scale=64):
    sound = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in queries:
        a = [math.floor(scale * x) for x in a]
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in sound if i != q)[:k]
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)}
    return out


def run(spark, rows, queries, **options):
    schema = "vec_id long, embedding array<float>"
    v = spark.createDataFrame(rows, schema).selectExpr("*", "1 AS norm", "'x' AS v", "2 AS id")
    return [tuple(r) for r in topk.top_k(v, spark.createDataFrame(queries, schema), **options).collect()]


def test_matches_brute_force_in_blocks(spark):
    rng = random.Random(6)
    rows = [(i, [rng.randint(-64, 64) / 64 * rng.choice((1, 1, 4)) for _ in range(12)]) for i in range(400)]
    queries = rows[::20]
    want = brute(rows, queries, 7)
    for options in ({}, {"query_block": 3, "seeds": 10, "sample": 50}, {"seeds": 1}):
        got = run(spark, rows, queries, k=7, **options)
        assert len(got) == len(want) and set(got) == want


def test_ties_copies_and_rows_that_take_no_part(spark):
    rows = [(i, [1.0, 0.5]) for i in range(30)] + [(100, None), (101, [1.0, None]), (102, [float("nan"), 1.0]), (103, [float("inf"), 1.0]),
                                                    (None, [9.0, 9.0]), (104, [5.0]), (105, [0.0, 0.0]), (7, [2.0, 2.0])]
    queries = [(0, [1.0, 0.5]), (7, [1.0, 0.5])]
    assert set(run(spark, rows, queries, k=5)) == brute([r if r[0] != 104 else (104, [5.0, 0.0]) for r in rows], queries, 5)


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0]), (1, [2.0])]
    assert set(run(spark, rows, rows[:1], k=20)) == {(0, 1, 1, 64 * 128)}
    assert run(spark, rows, []) == [] and run(spark, [], []) == []


def test_scores_beyond_doubles_and_beyond_longs(spark):
    big = float(1 << 24)
    rows = [(0, [big, 3.0]), (1, [big, 1.0]), (2, [big + 2, -2.0]), (3, [-big, 7.0])]
    assert set(run(spark, rows, rows[:1], k=3)) == brute(rows, rows[:1], 3)
    huge = [(0, [2.0 ** 50]), (1, [2.0 ** 50]), (2, [-(2.0 ** 50)])]
    assert set(run(spark, huge, huge[:1], k=3)) == {(0, 1, 1, (1 << 63) - 1), (0, 2, 2, -(1 << 63))}

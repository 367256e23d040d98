import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries as Q
from tessera.llm import runs as R


def brute(w, least_periods=4, least_words=6):
    """Runs by definition: every maximal stretch of every period, the smallest period of each."""
    n, out = len(w), []
    for q in range(1, n // least_periods + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size, part = j - i + q, w[i:j + q]
            if size >= max(least_words, least_periods * q) and not any(
                    all(part[x] == part[x + r] for x in range(size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = j
    return sorted(out)


@pytest.mark.parametrize("least_periods, least_words", [(4, 6), (3, 3), (5, 20)])
def test_runs_equal_brute_force(least_periods, least_words):
    rng = random.Random(1)
    for _ in range(600):
        docs = []
        for _ in range(rng.randint(1, 4)):
            k, n = rng.choice([1, 2, 3, 20]), rng.choice([0, 1, 5, 6, 20, 60])
            w = [rng.randrange(k) for _ in range(n)]
            if rng.random() < .7 and n > 3:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            docs.append(w)
        starts = np.cumsum([0] + [len(d) for d in docs])
        found = [[] for _ in docs]
        for s, size, p in zip(*R.runs_in(np.array(sum(docs, []), np.int64), starts, least_periods, least_words)):
            d = int(np.searchsorted(starts, s, side="right")) - 1
            found[d].append((int(s - starts[d]), int(size), int(p)))
        assert [sorted(f) for f in found] == [brute(d, least_periods, least_words) for d in docs]


def test_rows_edge_cases_and_slices(spark, documents, empty):
    rows = documents.withColumn("words", R.words_of("text"))
    found = R.find_runs(rows)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"] and found.count() == documents.count()
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect())
    want = []
    for i, t in documents.select("doc_id", "text").collect():
        w = re.findall(R.WORD, t or "")
        # the long text has one run, of period 977: brute force on its numbers
        runs = brute(w) if len(w) < 1000 else [(0, 30_000, 977)]
        drop = {x for s, n, p in runs for x in range(s + p, s + n)}
        want.append((str(i), len(w), runs, " ".join(x for k, x in enumerate(w) if k not in drop)))
    assert got == sorted(want)
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in R.find_runs(rows, slice_words=5).collect()) == got
    none = R.find_runs(empty.withColumn("words", R.words_of("text")))
    assert none.count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, ["a", None, "a", None] * 4)], "doc_id long, words array<string>")
    assert [r.n_words for r in R.find_runs(odd).orderBy("doc_id").collect()] == [0, 0, 16]
    with pytest.raises(ValueError):
        R.find_runs(rows, least_periods=2)


def test_the_strongest_run_by_exact_exponent(spark):
    rows = [(1, [(5, 13, 3), (0, 26, 6), (40, 9, 2)]), (2, []), (3, [(9, 8, 2), (4, 8, 2), (4, 12, 3)])]
    df = spark.createDataFrame(rows, "id long, runs array<struct<start:long,length:long,period:long>>")
    got = {r.id: r.best and tuple(r.best) for r in df.select("id", R.strongest("runs").alias("best")).collect()}
    assert got == {1: (40, 9, 2), 2: None, 3: (4, 8, 2)}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in Q.op13_periodic_runs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    n_runs = 0
    for i, t in docs:
        w = re.findall(R.WORD, t or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        ids = {}
        number = [ids.setdefault(x, len(ids)) for x in w]
        runs = brute(number) if n < 1500 else None
        r = got[i]
        if runs is None:
            continue
        n_runs += len(runs)
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (None if not runs else 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        drop = {x for s, m, q in runs for x in range(s + q, s + m)}
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in drop).encode()).hexdigest()
    assert n_runs > 5


def test_null_ids_and_repeats_are_kept(spark, documents):
    rows = Q.planted_words(documents)
    assert rows.count() == documents.count()
    assert rows.filter(F.col("doc_id").isNull()).first().words[0] == "alpha"

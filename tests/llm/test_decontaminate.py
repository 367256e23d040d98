import random
from collections import Counter

import numpy as np

from tessera.llm import decontaminate as D


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def brute(docs, items, similarity=0.8):
    out = {}
    for doc_id, text in docs:
        w = D._WORD.findall((text or "").lower())
        for item_id, item in items:
            t = D._WORD.findall((item or "").lower())
            if not w or not t:
                continue
            n = min(len(t), len(w))
            best = max((D.bag_similarity(D.bag(w[a:a + n]), D.bag(t)), -a) for a in range(len(w) - n + 1))
            if best[0] >= similarity:
                out[doc_id, item_id] = (round(best[0], 9), -best[1])
    return out


def planted():
    items = [(i, " ".join(words(size, i))) for i, size in enumerate([3, 5, 12, 20, 33, 40, 59])] + [(90, None), (91, "!!"), (92, "")]
    docs = []
    for i, text in items[:7]:
        filler = words(60, 100 + i)
        docs.append((10 + i, " ".join(filler[:25]) + " " + text.title() + ", " + " ".join(filler[25:])))
        changed = text.split()
        changed[-1] = "zzzz"
        docs.append((30 + i, " ".join(filler[:9] + changed)))
    docs += [(50, items[4][1]), (51, None), (52, ""), (53, " ".join(words(900, 5)) + " " + items[5][1] * 2), (54, items[5][1][:150])]
    return docs, items


def test_leaks_equal_brute_force(spark):
    docs, items = planted()
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id", "'x' AS similarity")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'y' AS doc_id")
    want = brute(docs, items)
    for block in (2048, 3):
        got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.first_word) for r in D.leaks(d, b, item_block=block).collect()}
        assert got == want
    assert {(10 + i, i) for i in range(7)} <= set(want)
    clean = {r.doc_id for r in D.clean(d, b).collect()}
    assert clean == {i for i, _ in docs} - {i for i, _ in want}
    assert D.clean(d, b).columns == d.columns


def test_multi_index_finds_every_item_within_the_radius():
    rng = np.random.default_rng(1)
    index = D.ItemIndex([(i, " ".join(words(20, i))) for i in range(40)], 15)
    members, prints, _ = index.sizes[20]
    windows = np.concatenate([prints ^ np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for _ in prints], np.uint64)
                              for k in (0, 3, 11, 15, 16)])
    got = {(w, i, d) for w, i, d in index.near(windows, 20)}
    want = {(w, int(members[j]), (int(x) ^ int(p)).bit_count()) for w, x in enumerate(windows) for j, p in enumerate(prints)}
    assert got == {t for t in want if t[2] <= 15}


def test_simhash_is_the_weighted_majority():
    w, _ = D.word_hashes([" ".join(words(50, 2))])
    s = D.shingle_hashes(w)
    got = D.simhashes(s, np.arange(len(s) - 15), 16)
    for at, p in enumerate(got.tolist()):
        run = Counter(s[at:at + 16].tolist())
        assert p == sum((2 * sum(n for h, n in run.items() if h >> b & 1) > 16) << b for b in range(64))


def test_word_hashes_do_not_depend_on_the_place():
    a, at = D.word_hashes(["one TWO three", "", None, "x two"])
    assert at.tolist() == [0, 3, 3, 3, 5] and a[1] == a[4] and len(set(a.tolist())) == 4


def test_edge_cases(spark, documents, empty):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None)], "item_id long, text string")
    assert {r.doc_id for r in D.leaks(documents, items).collect()} == {1, 2, 7, None}
    assert D.leaks(empty, items).count() == 0 and D.leaks(documents, items.limit(0)).count() == 0
    assert D.clean(documents, items.limit(0)).count() == documents.count()
    assert {r.doc_id for r in D.clean(documents, items).collect()} == {3, 4, 5, 6, 8, 9}

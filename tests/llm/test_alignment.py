import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tessera.llm import alignment as A
from tessera.llm import queries as Q
from tessera.llm.common import written

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    return A.TokenizerA(PATH_A), A.TokenizerB(PATH_B)


def brute(rows, both):
    """Row number -> counts and digest, and pair -> (documents, links), from whole texts and nested loops."""
    a, b = both
    per, documents, links = [], collections.defaultdict(set), collections.Counter()
    for k, t in enumerate(rows):
        per.append((0, 0, 0, [], ""))
        if not t:
            continue
        ids_a, ids_b = a.tokenizer.encode(" " + t, add_special_tokens=False).ids, b.model.encode(t)
        spelled = [[x.spelling[i] for i in ids] for x, ids in ((a, ids_a), (b, ids_b))]
        if any(b"".join(s) != (" " + t).encode() for s in spelled):
            continue
        ends_a, ends_b = (np.cumsum([len(p) for p in s]).tolist() for s in spelled)
        found, texts, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            group_a = [ids_a[x] for x in range(i, ends_a.index(end) + 1)]
            group_b = [ids_b[x] for x in range(j, ends_b.index(end) + 1)]
            i, j = i + len(group_a), j + len(group_b)
            found += [(x, y) for x in group_a for y in group_b]
            texts.append(",".join(map(str, group_a)) + "|" + ",".join(map(str, group_b)))
        per[-1] = (len(ids_a), len(ids_b), len(texts), found, hashlib.sha256(";".join(texts).encode()).hexdigest())
        links.update(found)
        for p in set(found):
            documents[p].add(k)
    most = collections.Counter()
    for (x, _), held in documents.items():
        most[x] = max(most[x], len(held))
    rows = [(n, m, g, len(f), sum(len(documents[p]) == most[p[0]] for p in f), sum(len(documents[p]) for p in f), d) for n, m, g, f, d in per]
    return rows, {p: (len(h), links[p]) for p, h in documents.items()}


def texts(n=500):
    rng = random.Random(5)
    odd = [None, "", "  two  spaces \n here ", "▁ has the mark", "tab\tand\nlines \r\n x", "<|endoftext|> and <s> text", "naïve 日本語 😀", "a\x00b c",
           " lead", "trail ", " ", "x" * 500, "\x1c \x1f y", "nb sp 　 z", "the the the the " * 30]
    return odd + ["".join(rng.choice(" \n\tabcXYé日1.'" + ("▁" if rng.random() < .05 else "")) for _ in range(rng.randrange(80))) for _ in range(n)]


def values(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


@pytest.mark.parametrize("limits", [A.Sizes(), A.Sizes(64, 4000, 300)])
def test_rows_equal_brute_force(spark, both, limits):
    # small containers: bits and places both occur, many containers, texts in parts
    rows = texts()
    want, pairs = brute(rows, both)
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(2)
    got = {r.doc_id: values(r) for r in A.align(df, PATH_A, PATH_B, limits=limits).collect()}
    assert [got[k] for k in range(len(rows))] == want
    held = A.pair_counts(written(A.postings(df, PATH_A, PATH_B, limits=limits), "test"))
    assert {(r.id_a, r.id_b): (r.documents, r.links) for r in held.collect()} == pairs


def test_bitmaps_give_their_places_back():
    rng = np.random.default_rng(1)
    for n in (1, 200, 255, 256, 257, 4096):
        sets = [np.sort(rng.choice(4096, n, replace=False)) for _ in range(3)]
        maps = A._bitmaps(np.concatenate(sets).astype(np.int32), np.array([n] * 3), 512)
        places, counts = A._places(maps, 512)
        assert counts.tolist() == [n] * 3 and (places == np.concatenate(sets)).all()
        assert max(len(m.as_py()) for m in maps) <= 512


def test_units_encode_as_the_whole_text(both):
    a, b = both
    for t in texts(400):
        if t and "▁" not in t:          # such texts have no tokens
            units = A.units_of(t)
            assert "".join(units) == " " + t
            assert [i for x in a.encode(units) for i in x] == a.encode([" " + t])[0]
            assert [i for x in b.encode(units) for i in x] == b.encode([" " + t])[0]
            parts = list(A.parts_of(t, 7))
            assert " ".join(parts) == t and [u for p in parts for u in A.units_of(p)] == units


def test_edge_rows(spark, documents, empty, both):
    rows = documents.select("doc_id", "text").collect()
    want, _ = brute([r.text for r in rows], both)
    got = sorted((str(r.doc_id), values(r)) for r in A.align(documents, PATH_A, PATH_B).collect())
    assert got == sorted((str(r.doc_id), w) for r, w in zip(rows, want))
    assert A.align(empty, PATH_A, PATH_B).count() == 0


def test_query_equals_brute_force(spark, both):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute([t for _, t in docs], both)
    got = {r.doc_id: values(r) for r in Q.op11_token_alignment(spark, sf).collect()}
    assert [got[i] for i, _ in docs] == want


def test_ids_as_text_are_made_once_for_each_tokenizer():
    a, b = A.TokenizerA(PATH_A), A.TokenizerB(PATH_B)
    for tokenizer, end in ((a, "|"), (b, ";")):
        n = len(tokenizer.spelling)
        assert tokenizer.within.tolist() == [f"{i}," for i in range(n)] and tokenizer.last.tolist() == [f"{i}{end}" for i in range(n)]
    words = [" the", " annual", " x1"]
    units = A.Units(words, a, b)
    for word, text in zip(words, units.texts):
        groups = [g.split("|") for g in text[:-1].split(";")]
        assert [int(i) for x, _ in groups for i in x.split(",")] == a.encode([word])[0]
        assert [int(i) for _, y in groups for i in y.split(",")] == b.encode([word])[0]


def test_units_are_encoded_many_at_a_time():
    a = A.TokenizerA(PATH_A)
    rng = random.Random(12)
    signs = "ab'st \n\t1.,<é\x1c\x85　日😀"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 30))) for _ in range(800)] + ["it's <|endoftext|> b\n", " ", "x" * 3000]
    units = [*dict.fromkeys(u for t in texts for u in A.units_of(t))]
    alone, asked = a.encode(units), []
    one_by_one, a.encode = a.encode, lambda given: asked.append(len(given)) or one_by_one(given)
    flat, counts = a.flat(units, [u.encode() for u in units])
    assert counts.tolist() == [len(x) for x in alone] and flat.tolist() == [i for x in alone for i in x]
    plain = [f" word{i}" for i in range(3000)]
    asked.clear()
    _, counts = a.flat(plain, [u.encode() for u in plain])
    assert asked == [-(-len(plain) // A.JOINED)] and counts.tolist() == [len(x) for x in one_by_one(plain)]

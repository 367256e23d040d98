import random
import re

import xxhash

from tessera.llm import simhash_dedup as S


def brute_fingerprint(text, shingle=3):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    runs = [b" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def brute_components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_match_brute_force(documents):
    texts = [r.text for r in documents.collect()] + ["A b C", "a  B\tc", "one", "É é É é"]
    assert S.fingerprints(texts) == [brute_fingerprint(t) for t in texts]


def test_links_are_all_pairs_within_radius(spark):
    rng = random.Random(4)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))) for _ in range(4)]
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    for radius in (0, 1, 2, 3):
        want = {tuple(sorted((signed(a), signed(b)))) for i, a in enumerate(prints) for b in prints[:i]
                if (a ^ b).bit_count() <= radius}
        assert {(r.a, r.b) for r in S.links(frame, radius).collect()} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 3)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame([tuple(sorted(e)) for e in edges], "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_rows_and_edge_cases(documents):
    rows = documents.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    groups = brute_components(prints, 2)
    least = {g: min((rows[i].doc_id for i in range(len(rows)) if groups[i] == g and rows[i].doc_id is not None), default=None)
             for g in set(groups)}
    want = sorted((str(r.doc_id), f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, groups))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in S.near_duplicates(documents).collect()) == want


def test_first_of_each_keeps_columns_and_one_row_a_group(documents, empty):
    out = S.first_of_each(documents)
    assert out.columns == documents.columns
    ids = sorted(r.doc_id for r in out.collect() if r.doc_id is not None)
    assert ids == sorted(set(ids)) and {1, 3, 6, 8, 9} <= set(ids) and not {2, 4, 5} & set(ids)
    assert S.first_of_each(empty).count() == 0 and S.near_duplicates(empty).count() == 0


def test_rows_without_an_id_are_decided_by_text(spark):
    lines = ["one two three four five six seven eight", "red green blue black white brown grey pink", "a b c d e f g h"]
    rows = [(None, lines[0]), (None, lines[0]), (7, lines[0]), (None, lines[1]), (None, lines[1]), (9, lines[2])]
    out = S.first_of_each(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(7, lines[0]), (None, lines[1]), (9, lines[2])], key=str)

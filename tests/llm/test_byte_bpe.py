import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tessera.llm import byte_bpe as B
from tessera.llm import queries as Q

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=B.read_ranks(RANKS), special_tokens={})


def texts():
    rng = random.Random(3)
    odd = [None, "", " ", "\n", "aaa bbb" * 3 + "  \n\n x  y  z 　w", "日本語の長い文章です" * 50, "don't I'LL we've 12345 ²³ 😀😀🏳️‍🌈",
           "a" * 300, "ab" * 2000, "<|endoftext|> x", "".join(chr(rng.randrange(32, 0x2fff)) for _ in range(3000)),
           "".join(rng.choice("abcdefgh") for _ in range(1500))]
    return odd + ["".join(rng.choice(" \n\tabcXYé日1.'") for _ in range(rng.randrange(80))) for _ in range(800)]


def test_ids_and_bytes_equal_the_library(spark, library):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    encoded = B.encode(df, RANKS, PATTERN)
    got = {r.doc_id: (r.ids, bytes(r.decoded)) for r in B.decode(encoded, RANKS).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i] == (library.encode_ordinary(t or ""), (t or "").encode()), t
    for r in B.digests(df, RANKS, PATTERN).collect():
        ids, data = got[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(data).hexdigest())


def test_other_rank_files(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("multi", pat_str=PATTERN, mergeable_ranks=B.read_ranks(path), special_tokens={})
    rows = list(enumerate(texts()[:200]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.ids for r in B.encode(df, path, PATTERN).collect()}
    assert all(got[i] == library.encode_ordinary(t or "") for i, t in rows)


def test_files_that_the_fold_cannot_follow_are_refused(tmp_path):
    def file(name, tokens):
        path = tmp_path / name
        path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for i, t in enumerate(tokens)))
        return str(path)
    every = [bytes([b]) for b in range(256)]
    with pytest.raises(ValueError, match="cover every byte"):
        B.tables(file("few", every[:200]))
    with pytest.raises(ValueError, match="don't merge"):
        B.tables(file("apart", [*every, b"abc"]))
    assert B.tables(file("whole", [*every, b"ab", b"abc"])).longest == 3


def test_the_map_finds_every_rank_and_nothing_else(spark):
    ranks = B.read_ranks(RANKS)
    rng = random.Random(9)
    known = rng.sample([t for t in ranks if len(t) > 1], 400)
    other = [bytes(rng.randrange(256) for _ in range(rng.randint(2, 12))) for _ in range(400)]
    m = B.tables(RANKS)
    t = B._Tables(B._numbers(F.lit(m.rows)), B._numbers(F.lit(m.entries)), None, m.places, m.longest)
    df = spark.createDataFrame([(x,) for x in known + other], "token binary")
    rank = F.col("rank")
    got = df.select("token", B._rank(F.xxhash64("token"), t).alias("rank")).select("token", F.when(B._ranked(rank), rank).alias("rank")).collect()
    assert all(r["rank"] == ranks.get(bytes(r["token"])) for r in got)


def test_rows_and_edge_cases(spark, documents, empty, library):
    want = sorted((str(i), library.encode_ordinary(t or "")) for i, t in documents.select("doc_id", "text").collect())
    for words in (B.SLICE_WORDS, 3):
        encoded = B.encode(documents, RANKS, PATTERN, slice_words=words)
        assert encoded.columns == ["doc_id", "ids"]
        assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == want
    assert B.encode(empty, RANKS, PATTERN).count() == 0 and B.digests(empty, RANKS, PATTERN).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [-1, None, 999_999, 64])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in B.decode(odd, RANKS).orderBy("doc_id").collect()] == [b"", b"", b"a"]


def test_query_equals_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in Q.op12_byte_bpe(spark, sf).collect()}
    for i, t in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(t or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())

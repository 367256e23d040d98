import random
import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm import token_files as T
from tessera.llm.common import shared_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_pieces_give_the_ids_of_the_whole_text():
    whole, ours = Tokenizer.from_file(VOCABULARY), T.Encoder(VOCABULARY)
    rng = random.Random(3)
    signs = "ab'st \n\t   1.,<|endoftext|>éÀ\x1c\x85　 日😀"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["it's 12 <|endoftext|> b", " ", "x" * 4000]
    for t, got in zip(texts, ours.encode(texts, 2)):
        ids = whole.encode(t, add_special_tokens=False).ids + [2]
        assert got == struct.pack(f"<{len(ids)}I", *ids)


def test_ids_of_a_slice_are_gathered_from_one_array():
    whole, ours = Tokenizer.from_file(VOCABULARY), T.Encoder(VOCABULARY)
    rng = random.Random(5)
    words = ["and", "now", "Élan", "naïve", "it's", "x1", "<b>", "日本", "...", "a.b,", "w" * 40, "42", "😀", "»é«"]
    some = lambda: "".join(rng.choice("  \n") + rng.choice(words) + rng.choice(["", ".", ",", ";", "!?", "'"]) for _ in range(9))
    texts = [None, "", " led", *(some().strip() for _ in range(2000)), "two  spaces", "feed\n", "end", None]
    want = [whole.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    for _ in range(2):                               # learned, then remembered
        flat, counts = ours.flat(texts, 2)
        assert flat.dtype == "int32" and flat.tolist() == [i for x in want for i in x] and counts.tolist() == [len(x) for x in want]
    assert "w" * 40 not in ours.numbers and "and" in ours.numbers
    for few in ([], [None], [""], ["  "], ["one"]):
        flat, counts = ours.flat(few, 2)
        assert flat.tolist() == [i for t in few for i in whole.encode(t or "", add_special_tokens=False).ids + [2]] and len(counts) == len(few)


def test_long_runs_of_words_are_gathered_in_parts(monkeypatch):
    whole, ours = Tokenizer.from_file(VOCABULARY), T.Encoder(VOCABULARY)
    monkeypatch.setattr(T, "RUNS", 7)
    monkeypatch.setattr(T, "WORDS", 50)              # words are forgotten between slices
    for n in range(5):
        text = " ".join(f"w{n}x{k}, word{'abcdefghij'[k % 10]}." for k in range(60))
        assert ours.flat([text], 2)[0].tolist() == whole.encode(text, add_special_tokens=False).ids + [2]


def test_words_learned_little_by_little_are_copied_few_times():
    whole, ours = Tokenizer.from_file(VOCABULARY), T.Encoder(VOCABULARY)
    copies, before = 0, ours.ids
    for n in range(300):
        text = " ".join(f"w{n}x{k}, word{'abcdefghij'[k % 10]}{'abc'[n % 3]}{'xyz'[n // 3 % 3]}." for k in range(100))
        assert ours.flat([text], 2)[0].tolist() == whole.encode(text, add_special_tokens=False).ids + [2]
        copies, before = copies + (ours.ids is not before), ours.ids
    assert copies <= 10                              # the room grows by half, not with each text


def test_files_and_catalogue(spark, documents):
    whole = Tokenizer.from_file(VOCABULARY)
    for encoding in ("dictionary", "delta"):
        path = shared_path(spark, "test-tokens")
        T.write_tokens(documents, path, VOCABULARY, encoding=encoding, page_kb=1, page_rows=2)
        got = T.catalogue(spark, path).orderBy("start").collect()
        rows = documents.select("doc_id", "text").collect()
        want = sorted((-1 if i is None else i, zlib.crc32(struct.pack(f"<{len(x)}I", *x)), len(x)) for i, x in
                      ((i, whole.encode(t or "", add_special_tokens=False).ids + [2]) for i, t in rows))
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.n_tokens) for r in got) == want
        ids = [-1 if r.doc_id is None else r.doc_id for r in got]
        assert ids == sorted(ids)
        at = 0
        for r in got:
            assert r.start == at
            at += r.n_tokens
        some = T.read_tokens(spark, path, 3, 6).collect()
        assert sorted(r.doc_id for r in some) == [3, 4, 5, 6, 6] and all(len(r.tokens) == r.n_tokens and r.tokens[-1] == 2 for r in some)
        plan = T.read_counts(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "tokens:" not in plan.split("ReadSchema")[1].replace("n_tokens:", "")


def test_page_index_and_encodings(spark, documents):
    import glob

    import pyarrow.parquet as pq
    for encoding, name in (("dictionary", "RLE_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")):
        path = shared_path(spark, "test-tokens")
        T.write_tokens(documents, path, VOCABULARY, encoding=encoding)
        files = [pq.ParquetFile(f).metadata for f in glob.glob(path.replace("file:", "") + "/*.parquet")]
        columns = [m.row_group(0).column(c) for m in files if m.num_row_groups for c in range(3)]
        assert columns and all(c.has_offset_index and c.has_column_index for c in columns)
        assert all(name in c.encodings for c in columns if "tokens.list" in c.path_in_schema)
        assert all("DELTA_BINARY_PACKED" in c.encodings for c in columns if c.path_in_schema == "n_tokens")


def test_empty_table(spark, empty):
    path = shared_path(spark, "test-tokens")
    T.write_tokens(empty, path, VOCABULARY)
    assert T.catalogue(spark, path).count() == 0

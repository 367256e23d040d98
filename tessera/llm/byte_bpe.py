"""Byte-level BPE encoding and decoding with Spark higher-order functions.

A rank file lists byte strings (base64) and their ranks, which are the ids.  The words that the
split pattern finds in a text are encoded separately: of all neighbouring pieces whose joined
bytes have a rank the two of least rank, the leftmost of equal ones, are joined, until none has a rank.

The fold runs in the JVM, over the byte arrays of distinct words.  Every ranked string inside a
word is looked up in a literal rank map; in order of rank, then of place, each joins what stands
between its ends if both ends are still boundaries between pieces.  That is the same as joining pairs:
a pair that comes up later never has a lower rank than the pair joined before it, and when a
ranked string's turn comes and pieces fill exactly its bytes, these pieces are the two that its own
merges end with.  Both hold for files in which every ranked string comes out of its own bytes' merges;
``tables`` refuses others.  The boundaries of a word are the bits of a number (of a
text, for words of over 62 bytes).

The literal map is a hash table in two arrays: the first, by the upper bits of a byte string's XXH64, tells where in
the second its entry is, and the entry gives the rank if all 64 bits of the hash agree.

Each distinct word of a slice of documents is folded once: an Arrow step numbers the slice's words
and another puts their ids in the places of the numbers.  Texts are never joined or shuffled.

Decoding concatenates the pieces' bytes; ids that the file lacks, and nulls, decode to nothing.

Defined cases: a null text counts as empty; an empty text has no ids; null ids and repeated rows
are kept as they are; other columns are not read.  A slice holds about SLICE_WORDS words; a
longer text comes alone, whole.  Java decides what is a letter or digit, so characters newer than
its Unicode tables count as neither.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tessera.llm.common import cut

#: Words of one slice of documents.
SLICE_WORDS = 1 << 22
#: Bits of a rank and of a table row; seed of the hash.
RANK_BITS, ROW_BITS, SEED = 17, 14, 42
#: Longest word whose boundaries are the bits of one number.
SHORT = 62


@dataclass(frozen=True)
class RankMap:
    """A rank file as two literal arrays (numbers between blanks), the places of the second (a power of two), and the
    longest ranked string."""

    rows: str
    entries: str
    places: int
    longest: int


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _merged(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    none = 1 << RANK_BITS
    parts = [word[i:i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], none), i) for i in range(len(parts) - 1))
        if rank == none:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


def _table(rows: dict[int, list[tuple[int, int]]], size: int) -> tuple[list[int], list[int | None]] | None:
    """Each row's number and the entries by place, or None if some row finds no number."""
    moved, entries = [0] * (1 << ROW_BITS), [None] * size
    for row, keys in sorted(rows.items(), key=lambda r: (-len(r[1]), r[0])):
        for move in range(size):
            places = [(h ^ move) & (size - 1) for h, _ in keys]
            if len(set(places)) == len(places) and all(entries[p] is None for p in places):
                break
        else:
            return None
        moved[row] = move
        for p, (h, rank) in zip(places, keys):
            entries[p] = h ^ rank
    return moved, entries


@lru_cache(maxsize=4)
def tables(path: str) -> RankMap:
    """The literal map of a rank file's strings of two bytes and more.

    Strings whose hashes share their upper ROW_BITS make a row; rows with most strings first, each
    takes the first number with which all its strings' places are free.
    """
    ranks = read_ranks(path)
    size = 1 << RANK_BITS
    if max(ranks.values()) >= size or len(ranks) != len(set(ranks.values())) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path}: ranks must be distinct, below {size}, and cover every byte")
    rows: dict[int, list[tuple[int, int]]] = {}
    for token, rank in ranks.items():
        if len(token) > 1:
            if _merged(token, ranks) != [token]:
                raise ValueError(f"{path}: {token!r} is ranked but its bytes don't merge to it")
            h = xxhash.xxh64_intdigest(token, seed=SEED)
            rows.setdefault(h >> (64 - ROW_BITS), []).append((h, rank))
    size = 1 << (len(ranks) * 5 // 4).bit_length()
    while (found := _table(rows, size)) is None:
        size *= 2
    moved, entries = found
    texts = ["" if e is None else str((e ^ (1 << 63)) - (1 << 63)) for e in entries]     # signed; nothing for an empty place
    return RankMap(" ".join(map(str, moved)), " ".join(texts), size, max(map(len, ranks)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _numbers(text: Column, kind: str = "bigint") -> Column:
    """An array of numbers from a text, null where it has nothing between blanks."""
    return F.split(text, " ").try_cast(f"array<{kind}>")


def _literal(values, kind: str = "bigint") -> Column:
    return _numbers(F.lit(" ".join(map(str, values))), kind)


@dataclass(frozen=True)
class _Tables:
    """What a fold looks things up in, as arrays that are made once for a slice."""

    rows: Column
    entries: Column
    cuts: Column      # the spans of a word of n bytes, by n: (start + 1) * 64 + size, in the order of their ends
    places: int
    longest: int


def _rank(h: Column, t: _Tables) -> Column:
    """The rank of the byte string with hash ``h``; anything outside 0 .. 2 ** RANK_BITS - 1, or null, if it has none."""
    place = F.get(t.rows, F.shiftrightunsigned(h, 64 - ROW_BITS)).bitwiseXOR(h).bitwiseAND(t.places - 1)
    return F.get(t.entries, place).bitwiseXOR(h)


def _ranked(rank: Column) -> Column:
    return F.shiftrightunsigned(rank, RANK_BITS) == 0


def _short_word(word: Column, ranks: _Tables) -> Column:
    """Boundaries of a word of at most SHORT bytes, as digits 0 and 1 from its end to its start.

    Spans come in the order of their ends, so those of a word are the first of all; ``codes`` has each as start * 64 + end.
    """
    spans = [(i, j) for j in range(2, SHORT + 1) for i in range(j - 1)]
    codes = _literal(i * 64 + j for i, j in spans)
    by_code = [0] * (64 * 64)
    inner = list(by_code)
    for i, j in spans:
        by_code[i * 64 + j] = 1 << i | 1 << j
        inner[i * 64 + j] = -1 ^ ((1 << j) - (1 << (i + 1)))
    ends, kept = _literal(by_code), _literal(inner)
    n = F.length(word)
    hashes = F.transform(F.get(ranks.cuts, n), lambda c: F.xxhash64(F.substring(word, F.shiftright(c, 6), c.bitwiseAND(63))))
    found = F.transform(F.transform(hashes, lambda h: _rank(h, ranks)),
                        lambda r, i: F.when(_ranked(r), F.shiftleft(r, 12).bitwiseOR(F.get(codes, i))))

    def join(state, c):
        span = c.bitwiseAND(4095)
        return F.when(F.bitwise_not(state).bitwiseAND(F.get(ends, span)) == 0, state.bitwiseAND(F.get(kept, span))).otherwise(state)

    every = F.get(_literal((2 << k) - 1 for k in range(SHORT + 1)), n)
    return F.bin(F.aggregate(F.array_sort(F.array_compact(found)), every, join))


def _long_word(word: Column, ranks: _Tables) -> Column:
    """The same for words of any length: the state is the digits themselves."""
    n = F.length(word)
    spans = F.flatten(F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.transform(
        F.sequence(F.lit(2), F.least(F.lit(ranks.longest), n - i)), lambda size: F.struct(i.alias("i"), size.alias("n")))))
    hashed = F.transform(spans, lambda s: F.struct(F.xxhash64(F.substring(word, s["i"] + 1, s["n"])).alias("h"), s["i"].alias("i"), s["n"].alias("n")))
    ranked = F.filter(F.transform(hashed, lambda x: F.struct(_rank(x["h"], ranks).alias("rank"), x["i"].alias("i"), x["n"].alias("n"))),
                      lambda x: _ranked(x["rank"]))

    def join(state, x):
        both = (F.substring(state, x["i"] + 1, 1) == "1") & (F.substring(state, x["i"] + x["n"] + 1, 1) == "1")
        return F.when(both, F.overlay(state, F.repeat(F.lit("0"), x["n"] - 1), x["i"] + 2, x["n"] - 1)).otherwise(state)

    return F.reverse(F.aggregate(F.array_sort(ranked), F.repeat(F.lit("1"), n + 1), join))


def boundaries(words: str, ranks: RankMap) -> Column:
    """Of each word of an array, which of its n + 1 places between bytes, its ends included, part two ids.

    Digits 0 and 1, from the word's end to its start.  The literal texts of the map become arrays
    once for each array of words, so the plan carries two texts and not their many numbers.
    """
    def text(literal):
        return F.when(F.col(words).isNotNull(), F.lit(literal))

    spans = ";".join(" ".join(str((i + 1) * 64 + j - i) for j in range(2, n + 1) for i in range(j - 1)) for n in range(SHORT + 1))

    def of(tables):
        return F.transform(words, lambda w: F.when(F.length(w) <= SHORT, _short_word(w, tables)).otherwise(_long_word(w, tables)))

    return _let(_numbers(text(ranks.rows)), lambda rows: _let(_numbers(text(ranks.entries)), lambda entries: _let(
        F.transform(F.split(text(spans), ";"), lambda of_size: F.array_compact(_numbers(of_size, "int"))),
        lambda cuts: of(_Tables(rows, entries, cuts, ranks.places, ranks.longest)))))


def _one(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _numbered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One row for each slice of documents: their ids, their words as numbers, and the distinct words' bytes."""
    for batch in batches:
        for a, b in cut(pc.list_value_length(batch.column("words")).to_pylist(), size):
            part = batch.slice(a, b - a)
            lists = part.column("words")
            flat = lists.flatten().dictionary_encode()
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [_one(part.column("id")), _one(pa.ListArray.from_arrays(at, flat.indices.cast(pa.int32()))),
                 _one(flat.dictionary.cast(pa.binary()))], ["id", "texts", "words"])


def _word_ids(words: pa.Array, digits: pa.Array, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one behind the other, and where each word's begin."""
    data = b"".join(words.to_pylist())
    sizes = pc.binary_length(digits).to_numpy(zero_copy_only=False).astype(np.int64)     # bytes of a word, and one
    parts = np.frombuffer("".join(digits.to_pylist()).encode(), np.uint8) == ord("1")
    word = np.repeat(np.arange(len(sizes)), sizes)[parts]
    ends = np.cumsum(sizes)
    place = ends[word] - 1 - np.flatnonzero(parts)                                       # from the word's start
    before = ends - sizes - np.arange(len(sizes))                                        # bytes of the words before
    order = np.lexsort([place, word])
    word, place = word[order], (before[word] + place)[order]
    same = word[1:] == word[:-1]
    ids = [ranks[data[a:b]] for a, b in zip(place[:-1][same].tolist(), place[1:][same].tolist())]
    return np.array(ids, np.int32), np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(sizes)) - 1)])


def split_pattern(pattern: str) -> str:
    """A pattern of Unicode white space (\\s, \\S) in Java's terms."""
    return pattern.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def _folded(docs: DataFrame, path: str, pattern: str, id_col: str, text_col: str, slice_words: int) -> DataFrame:
    """Slices of documents: ids, texts as word numbers, distinct words, and their boundaries."""
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(split_pattern(pattern)), F.lit(0))
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(found, F.array().cast("array<string>")).alias("words"))
    slices = source.mapInArrow(lambda batches: _numbered(batches, slice_words), StructType([
        StructField("id", ArrayType(source.schema["id"].dataType)), StructField("texts", ArrayType(ArrayType(IntegerType()))),
        StructField("words", ArrayType(BinaryType()))]))
    return slices.select("id", "texts", "words", boundaries("words", tables(path)).alias("digits"))


def _placed(batches: Iterator[pa.RecordBatch], path: str):
    """(ids, ids of all words, starts of each word's, texts as word numbers) of each slice, some documents at a time."""
    ranks = read_ranks(path)
    for batch in batches:
        for row in range(batch.num_rows):
            ids, starts = _word_ids(batch.column("words")[row].values, batch.column("digits")[row].values, ranks)
            texts = batch.column("texts")[row].values
            for a, b in cut(pc.list_value_length(texts).to_pylist(), 1 << 18):
                yield batch.column("id")[row].values.slice(a, b - a), ids, starts, texts.slice(a, b - a)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           ids_col: str = "ids", slice_words: int = SLICE_WORDS) -> DataFrame:
    """(id, ids array<int>) of every row, each match of ``pattern`` encoded by the ranks in ``path``."""
    folded = _folded(docs, path, pattern, id_col, text_col, slice_words)

    def run(batches):
        for doc, ids, starts, texts in _placed(batches, path):
            words = texts.flatten().to_numpy()
            sizes = starts[words + 1] - starts[words]
            ends = np.cumsum(sizes)
            places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts[words], sizes)
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(texts).to_numpy())])
            offsets = np.concatenate([[0], ends])[at].astype(np.int32)
            yield pa.RecordBatch.from_arrays([doc, pa.ListArray.from_arrays(offsets, pa.array(ids[places]))], ["id", "ids"])

    schema = StructType([StructField("id", folded.schema["id"].dataType.elementType), StructField("ids", ArrayType(IntegerType()))])
    return folded.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "ids": ids_col})


def _pieces(path: str) -> list[bytes]:
    ranks = read_ranks(path)
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """(id, ids, decoded): the ids of every row and the bytes they stand for."""
    source = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array()).cast("array<int>").alias("ids"))

    def run(batches):
        pieces = _pieces(path)
        sizes = np.array([len(p) for p in pieces] + [0], np.int64)
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(pieces), np.uint8)
        for batch in batches:
            for a, b in cut(pc.list_value_length(batch.column("ids")).to_pylist(), 1 << 20):
                part = batch.slice(a, b - a)
                lists = part.column("ids")
                ids = lists.flatten().fill_null(-1).to_numpy().astype(np.int64)
                ids[(ids < 0) | (ids >= len(pieces))] = len(pieces)
                ends = np.cumsum(sizes[ids])
                places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes[ids] - starts[ids], sizes[ids])
                at = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
                offsets = np.concatenate([[0], ends])[at].astype(np.int32)
                decoded = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offsets), pa.py_buffer(data[places])])
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, decoded], ["id", "ids", "decoded"])

    schema = StructType([source.schema["id"], source.schema["ids"], StructField("decoded", BinaryType())])
    return source.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "ids": ids_col, "decoded": out})


def digests(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
            slice_words: int = SLICE_WORDS) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: its ids as decimal text, and the bytes they decode to.

    As ``encode`` and ``decode``, but the ids' text and bytes are put together word by word, so no
    row of ids leaves the step that finds them.
    """
    folded = _folded(docs, path, pattern, id_col, text_col, slice_words)

    def run(batches):
        pieces = _pieces(path)
        numbers = [f"{i} " for i in range(len(pieces))]
        last = None
        for doc, ids, starts, texts in _placed(batches, path):
            if last is not ids:
                flat, cuts, last = ids.tolist(), starts.tolist(), ids
                shown = ["".join([numbers[i] for i in flat[a:b]]) for a, b in zip(cuts, cuts[1:])]
                spelled = [b"".join([pieces[i] for i in flat[a:b]]) for a, b in zip(cuts, cuts[1:])]
                sizes = np.diff(starts)
                flat = None
            n, ids_sums, sums = [], [], []
            for text in texts:
                words = text.values.to_numpy()
                n.append(int(sizes[words].sum()))
                listed = words.tolist()
                ids_sums.append(hashlib.sha256("".join([shown[w] for w in listed])[:-1].encode()).hexdigest())
                sums.append(hashlib.sha256(b"".join([spelled[w] for w in listed])).hexdigest())
            yield pa.RecordBatch.from_arrays([doc, pa.array(n, pa.int64()), pa.array(ids_sums, pa.string()), pa.array(sums, pa.string())],
                                             ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = StructType([StructField("id", folded.schema["id"].dataType.elementType), StructField("n_tokens", LongType()),
                         StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])
    return folded.mapInArrow(run, schema).withColumnRenamed("id", id_col)

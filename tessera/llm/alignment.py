"""Alignment of two tokenizers' ids by inverted pair bitmaps.

Both tokenizers encode space + text.  Byte offsets where tokens of both end cut the text into
groups; in a group every token of the one (A) is linked with every token of the other (B).  A pair
of ids counts as often as there are documents that hold it linked.

Method.  Documents get places in containers of bounded size (``Sizes``; a longer
text has one of its own).  Each slice of texts gives its linked pairs with the places that hold
them; slices of one container are OR-merged and every pair's places are kept as a compressed bitmap:
sorted 16-bit places, or the bits themselves where those are shorter.  How often a place links a
pair is kept in multiplicity planes: plane k is the bitmap of the places whose multiplicity less 1
has bit k.  Popcounts give a pair's documents and links.  The bitmaps are the postings: a
pair's count and whether it is the greatest of its A id come back to each container with that pair,
and the container's postings and planes add them up for its places.

Shuffled are one short row for each pair and container, there and back, and the compressed postings
once; a pair found everywhere has one row in each container, so no key holds more than its even share.

Texts are encoded unit by unit: a unit begins with a space after a character that is no white
space.  Neither tokenizer joins anything across that place (B must have no piece with a space after
another character), so units are encoded once for each slice of texts, and both tokenizers have an end there.

Defined cases: a null or empty text, or one whose joined A or B bytes differ from space + text (so any that holds U+2581), has no
tokens: zeros and an empty string; null ids and repeated rows are kept and count as documents of their own; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tessera.llm.common import written



@dataclass(frozen=True)
class Sizes:
    """Documents (a multiple of 8, at most 2^16) and characters of one container, characters of one slice."""

    docs: int = 4096
    chars: int = 8 << 20
    slice_chars: int = 2 << 20

    @property
    def bitmap(self) -> int:
        """Bytes of a container's places as bits."""
        return self.docs // 8


_STARTS = re.compile(r"(?<=\S)(?= [\s\S])")
_INNER = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Units that the byte-level tokenizer encodes as one text.
JOINED = 512

#: Sums over a document's units.
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _numbers(n: int, end: str) -> np.ndarray:
    """Ids from 0 as text with what stands behind them."""
    return np.array([f"{i}{end}" for i in range(n)], object)


def _sizes(spelling: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, spelling), np.int64, len(spelling))


def _together(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


class TokenizerA:
    """A byte-level tokenizer file of the tokenizers library; strings of special tokens are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")   # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        code = {b: b for b in shown} | {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in shown)}
        byte = {chr(c): b for b, c in code.items()}
        vocab = self.tokenizer.get_vocab()
        self.spelling = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.spelling[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.sizes = _sizes(self.spelling)
        self.within, self.last = _numbers(len(self.spelling), ","), _numbers(len(self.spelling), "|")

    def encode(self, units: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def flat(self, units: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one behind the other, and how many each has; ``raw`` are the units' bytes.

        Units are encoded many at a time as one text, which is cut where they end: the next one begins with a space after a
        character that is no white space.  Those that end in white space come last in such a text, and a text whose
        tokens don't end where its units do is encoded again unit by unit.
        """
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = [k + 1 for k, u in enumerate(units) if u[-1].isspace()]
        cuts = sorted({*range(0, len(units), JOINED), *ends, len(units)})
        spans = [*zip(cuts, cuts[1:])]
        flat, counts = [], []
        for (s, e), found in zip(spans, self.encode(["".join(units[s:e]) for s, e in spans]), strict=True):
            ids = np.array(found, np.int64)
            at, want = np.cumsum(self.sizes[ids]), np.cumsum(sizes[s:e])
            last = np.searchsorted(at, want)
            if len(at) and at[-1] == want[-1] and (at[last] == want).all():
                flat.append(ids)
                counts.append(np.diff(last, prepend=-1))
            else:
                apart = self.encode(units[s:e])
                flat.append(np.fromiter(chain.from_iterable(apart), np.int64))
                counts.append(np.fromiter(map(len, apart), np.int64, e - s))
        return _together(flat), _together(counts)


class TokenizerB:
    """A SentencePiece model file; it puts the space before a text itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path}: a piece holds a space after another character")
        self.spelling = [bytes([int(p[3:5], 16)]) if m.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.sizes = _sizes(self.spelling)
        self.within, self.last = _numbers(len(pieces), ","), _numbers(len(pieces), ";")

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.model.encode([u[1:] for u in units], num_threads=1)

    def flat(self, units: list[str], raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units, one behind the other, and how many each has."""
        ids = self.encode(units)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int64, int(counts.sum())), counts


def units_of(text: str) -> list[str]:
    """Space + text, cut before each space that follows a character other than white space and doesn't end the text."""
    if text[0] == " " or text[-1] == " " or _INNER.search(text):
        return _STARTS.split(" " + text)
    return [" " + word for word in text.split(" ")]


def parts_of(text: str, limit: int) -> Iterator[str]:
    """A long text in parts of about ``limit`` characters that are cut where units begin (the space between is left out)."""
    start = 0
    while len(text) - start > limit:
        found = _CUT.search(text, start + limit)
        if found is None:
            break
        yield text[start:found.start()]
        start = found.end()
    yield text[start:]


class Units:
    """Distinct units of a slice: their tokens, groups and links, in flat arrays with starts."""

    def __init__(self, units: list[str], a: TokenizerA, b: TokenizerB):
        raw = [u.encode("utf-8", "replace") for u in units]
        (flat_a, self.n_a), (flat_b, self.n_b) = a.flat(units, raw), b.flat(units, raw)
        self.good = self._spelled(flat_a, self.n_a, raw, a) & self._spelled(flat_b, self.n_b, raw, b)
        if not self.good.all():
            flat_a, flat_b = flat_a[np.repeat(self.good, self.n_a)], flat_b[np.repeat(self.good, self.n_b)]
            self.n_a, self.n_b = self.n_a * self.good, self.n_b * self.good
        n = len(units)
        end_a, end_b = np.cumsum(a.sizes[flat_a]), np.cumsum(b.sizes[flat_b])
        unit_a, unit_b = np.repeat(np.arange(n), self.n_a), np.repeat(np.arange(n), self.n_b)
        shared = np.intersect1d(end_a, end_b, assume_unique=True)           # ascending byte ends over all units
        group_a, group_b = np.searchsorted(shared, end_a), np.searchsorted(shared, end_b)
        unit_of_group = np.zeros(len(shared), np.int64)
        unit_of_group[group_a] = unit_a
        self.n_groups = np.bincount(unit_of_group, minlength=n)
        size_a, size_b = np.bincount(group_a, minlength=len(shared)), np.bincount(group_b, minlength=len(shared))
        # links: each A token with all B tokens of its group
        each = size_b[group_a]
        first_b = np.cumsum(size_b) - size_b
        at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        self.pairs = np.repeat(flat_a, each) << 32 | flat_b[np.repeat(first_b[group_a], each) + at]
        self.n_links = np.bincount(np.repeat(unit_a, each), minlength=n)
        self.link_start = np.concatenate([[0], np.cumsum(self.n_links)])
        self.texts = self._texts(flat_a, flat_b, group_a, group_b, size_a, size_b, a, b)

    @staticmethod
    def _spelled(flat: np.ndarray, counts: np.ndarray, raw: list[bytes], tokenizer: TokenizerA | TokenizerB) -> np.ndarray:
        """Which units' tokens have the units' own bytes."""
        spelling = tokenizer.spelling
        tokens = [spelling[i] for i in flat.tolist()]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(counts)
        at = np.concatenate([[0], np.cumsum(tokenizer.sizes[flat])])[ends]
        if (at == np.cumsum(sizes)).all() and b"".join(tokens) == b"".join(raw):     # all together, as is usual
            return np.ones(len(raw), bool)
        return np.array([b"".join(tokens[s:e]) == r for s, e, r in zip((ends - counts).tolist(), ends.tolist(), raw)], bool)

    def _texts(self, flat_a, flat_b, group_a, group_b, size_a, size_b, a: TokenizerA, b: TokenizerB) -> list[str]:
        """Each unit's groups as text, with ; behind each group."""
        words = np.empty(len(flat_a) + len(flat_b), object)
        last_a = np.diff(group_a, append=-1) != 0
        last_b = np.diff(group_b, append=-1) != 0
        words[np.arange(len(flat_a)) + (np.cumsum(size_b) - size_b)[group_a]] = np.where(last_a, a.last[flat_a], a.within[flat_a])
        words[np.arange(len(flat_b)) + np.cumsum(size_a)[group_b]] = np.where(last_b, b.last[flat_b], b.within[flat_b])
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        words = words.tolist()
        return ["".join(words[s:e]) for s, e in zip([0, *ends[:-1]], ends)]


def _links(units: Units, place: np.ndarray, unit: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, place, links) for units found at places, by pair and place, each once."""
    n = len(units.n_links)
    held, times = np.unique(place * n + unit, return_counts=True)
    place, unit = held // n, held % n
    each = units.n_links[unit]
    at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each - units.link_start[unit], each)
    known, number = np.unique(units.pairs, return_inverse=True)             # pairs by their numbers: short keys
    keys = number[at] * docs + np.repeat(place, each)
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], np.repeat(times, each)[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    links = np.add.reduceat(times, first) if len(first) else times
    keys = keys[first]
    return known[keys // docs], (keys % docs).astype(np.int32), links.astype(np.int32)


def _bitmaps(place: np.ndarray, counts: np.ndarray, bitmap: int) -> pa.Array:
    """Compressed bitmaps of consecutive runs of ascending places, ``counts`` of them each."""
    ends = np.cumsum(counts)
    data, sizes = place.astype("<u2").tobytes(), 2 * counts
    dense = np.flatnonzero(sizes >= bitmap).tolist()   # of equal length the bits, so the length tells which it is
    if not dense:
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    parts, at = [], 0
    for k in dense:
        e = int(ends[k])
        s = e - int(counts[k])
        bits = np.zeros(8 * bitmap, bool)
        bits[place[s:e]] = True
        parts += [data[2 * at:2 * s], np.packbits(bits, bitorder="little").tobytes()]
        at = e
    parts.append(data[2 * at:])
    offsets = np.concatenate([[0], np.cumsum(np.minimum(sizes, bitmap))]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(parts))])


def _places(bitmaps: pa.Array, bitmap: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of all bitmaps, one behind the other, and each one's popcount."""
    size = pc.binary_length(bitmaps).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(bitmaps.to_pylist()), np.uint8)
    dense = size == bitmap
    counts = size // 2
    ends = np.cumsum(size)
    for_dense = data[np.repeat(dense, size)].reshape(-1, bitmap) if dense.any() else np.zeros((0, bitmap), np.uint8)
    counts[dense] = np.bitwise_count(for_dense).sum(axis=1, dtype=np.int64)
    out = np.empty(int(counts.sum()), np.int64)
    is_dense = np.repeat(dense, counts)
    out[~is_dense] = np.frombuffer(data[np.repeat(~dense, size)].tobytes(), "<u2")
    if dense.any():
        out[is_dense] = np.nonzero(np.unpackbits(for_dense, axis=1, bitorder="little"))[1]
    return out, counts


def _or_merged(slices: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair, place, links) of several slices as one, by pair and place; a place of two slices (a text in parts) adds its links."""
    pair, place, links = (np.concatenate(x) for x in zip(*slices))
    order = np.lexsort([place, pair])
    pair, place, links = pair[order], place[order], links[order]
    first = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(place, prepend=-1) != 0))
    return pair[first], place[first], np.add.reduceat(links, first) if len(first) else links


class _Container:
    """Documents and linked pairs gathered until the container is full."""

    def __init__(self, number: int, limits: Sizes):
        self.number, self.chars, self.limits = number, 0, limits
        self.ids: list = []
        self.slices: list[tuple] = []
        self.counts = np.zeros((limits.docs, len(_COUNTS)), np.int64)
        self.bad = np.zeros(limits.docs, bool)
        self.digests: list = []                    # a running sha256 of the groups, None before the first

    def full(self, chars: int) -> bool:
        return len(self.ids) == self.limits.docs or bool(self.ids) and self.chars + chars > self.limits.chars

    def add(self, parts: list[tuple[int, str]], a: TokenizerA, b: TokenizerB) -> None:
        """One slice: parts of texts and the places of their documents."""
        texts = [units_of(t) for _, t in parts]
        coded = pa.array([u for t in texts for u in t], pa.string()).dictionary_encode()
        units, unit = Units(coded.dictionary.to_pylist(), a, b), coded.indices.to_numpy().astype(np.int64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        place = np.repeat(np.array([p for p, _ in parts], np.int64), sizes)
        self.bad[place[~units.good[unit]]] = True
        for k, name in enumerate(_COUNTS):
            np.add.at(self.counts[:, k], place, getattr(units, name)[unit])
        ends = np.cumsum(sizes)
        for (p, _), s, e in zip(parts, (ends - sizes).tolist(), ends.tolist()):
            if not self.bad[p]:
                text = "".join([units.texts[u] for u in unit[s:e].tolist()])
                if self.digests[p] is None:
                    self.digests[p] = hashlib.sha256()
                else:
                    self.digests[p].update(b";")
                self.digests[p].update(text[:-1].encode())
        good = ~self.bad[place]
        self.slices.append(_links(units, place[good], unit[good], self.limits.docs))

    def batches(self, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """Rows of documents (plane -1) and of postings (plane 0: places; plane k + 1: bit k of the multiplicity less 1)."""
        n = len(self.ids)
        self.counts[self.bad] = 0
        digests = ["" if d is None or bad else d.hexdigest() for d, bad in zip(self.digests, self.bad.tolist())]
        yield self._batch(id_type, np.full(n, -1), place=pa.array(np.arange(n, dtype=np.int32)), id=pa.array(self.ids, id_type),
                          groups_sha256=pa.array(digests, pa.string()),
                          **{c: pa.array(self.counts[:n, k].copy()) for k, c in enumerate(_COUNTS)})
        if self.slices:
            pair, place, links = _or_merged(self.slices)
            self.slices = []
            held = ~self.bad[place]                # a long text may turn out bad after its first parts
            pair, place, more = pair[held], place[held], links[held] - 1
            yield self._postings(id_type, 0, pair, place)
            for bit in range(int(more.max(initial=0)).bit_length()):
                has = (more >> bit & 1).astype(bool)
                yield self._postings(id_type, bit + 1, pair[has], place[has])

    def _postings(self, id_type: pa.DataType, plane: int, pair: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        held = np.diff(first, append=len(pair))
        return self._batch(id_type, np.full(len(first), plane), pair=pa.array(pair[first]), n=pa.array(held.astype(np.int64)),
                           places=_bitmaps(place, held, self.limits.bitmap))

    def _batch(self, id_type: pa.DataType, plane: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
        n = len(plane)
        fixed = {"container": pa.array(np.full(n, self.number, np.int64)), "plane": pa.array(plane.astype(np.int32))}
        kinds = {"pair": pa.int64(), "n": pa.int64(), "places": pa.binary(), "place": pa.int32(), "id": id_type,
                 **dict.fromkeys(_COUNTS, pa.int64()), "groups_sha256": pa.string()}
        return pa.RecordBatch.from_pydict(fixed | {c: columns[c] if c in columns else pa.nulls(n, t) for c, t in kinds.items()})


def postings(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
             limits: Sizes = Sizes()) -> DataFrame:
    """Containers as rows: documents (plane -1) with their counts, and each pair's bitmaps, planes 0 and up.

    Containers are numbered by partition and order, so write the rows once and read them from there.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        from pyspark import TaskContext
        a, b = TokenizerA(path_a), TokenizerB(path_b)
        number = TaskContext.get().partitionId() << 32
        container, waiting, chars = _Container(number, limits), [], 0
        for batch in batches:
            id_type = batch.schema.field("id").type
            for id_, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                if container.full(len(text)):
                    if waiting:
                        container.add(waiting, a, b)
                    yield from container.batches(id_type)
                    number, waiting, chars = number + 1, [], 0
                    container = _Container(number, limits)
                place = len(container.ids)
                container.ids.append(id_)
                container.digests.append(None)
                container.chars += len(text)
                for part in parts_of(text, limits.slice_chars) if text else ():
                    if waiting and chars + len(part) > limits.slice_chars:
                        container.add(waiting, a, b)
                        waiting, chars = [], 0
                    waiting.append((place, part))
                    chars += len(part)
        if waiting:
            container.add(waiting, a, b)
        if container.ids:
            yield from container.batches(id_type)

    schema = StructType([
        StructField("container", LongType()), StructField("plane", IntegerType()), StructField("pair", LongType()),
        StructField("n", LongType()), StructField("places", BinaryType()), StructField("place", IntegerType()),
        StructField("id", source.schema["id"].dataType), *(StructField(c, LongType()) for c in _COUNTS),
        StructField("groups_sha256", StringType())])
    return source.mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, id_a, id_b, documents, links, best) of ``postings``: popcounts of the places and of the weighted planes.

    ``best``: no other pair of this A id is held by more documents.
    """
    weight = F.when(F.col("plane") <= 1, 1.0).otherwise(F.pow(F.lit(2.0), F.col("plane") - 1)).cast("long")
    counts = (rows.filter(F.col("plane") >= 0).groupBy("pair")
              .agg(F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("documents"), F.sum(F.col("n") * weight).alias("links")))
    ids = counts.select("pair", F.shiftright("pair", 32).alias("id_a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("id_b"),
                        "documents", "links")
    # at most the B vocabulary's size of rows to an A id
    return ids.withColumn("best", F.col("documents") == F.max("documents").over(Window.partitionBy("id_a")))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          limits: Sizes = Sizes()) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    ``count_sum`` adds up, over a document's links, how many documents hold the link's pair; ``n_best``
    counts the links whose pair is the most frequent of its A id.
    """
    rows = written(postings(docs, path_a, path_b, id_col, text_col, limits), "postings")
    counts = pair_counts(rows).select("pair", "documents", "best")
    held_by = rows.filter(F.col("plane") == 0).select(F.col("container").alias("to"), F.col("pair").alias("p"))
    back = held_by.join(counts, held_by["p"] == counts["pair"]).select("to", "p", "documents", "best")

    def score(held: pa.Table, found: pa.Table) -> pa.Table:
        held, found = held.combine_chunks(), found.combine_chunks()
        plane = held.column("plane").to_numpy()
        mine = held.filter(pa.array(plane == -1)).sort_by("place")
        found = found.sort_by("p")
        pairs, documents, best = (found.column(c).to_numpy() for c in ("p", "documents", "best"))
        sums = np.zeros((2, limits.docs), np.int64)
        for k in range(int(plane.max()) + 1):
            maps = held.filter(pa.array(plane == k))
            weight = 1 << max(k - 1, 0)
            for part in maps.to_batches(max_chunksize=1 << 16):
                places, n = _places(part.column("places"), limits.bitmap)
                at = np.repeat(np.searchsorted(pairs, part.column("pair").to_numpy()), n)
                np.add.at(sums[0], places, weight * best[at].astype(np.int64))
                np.add.at(sums[1], places, weight * documents[at])
        n = mine.num_rows
        return pa.table([mine.column("id"), *(mine.column(c) for c in _COUNTS), pa.array(sums[0, :n]), pa.array(sums[1, :n]),
                         mine.column("groups_sha256")], [id_col, *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    schema = StructType([StructField(id_col, rows.schema["id"].dataType),
                         *(StructField(c, LongType()) for c in (*_COUNTS, "n_best", "count_sum")),
                         StructField("groups_sha256", StringType())])
    return rows.groupBy("container").cogroup(back.groupBy("to")).applyInArrow(score, schema)

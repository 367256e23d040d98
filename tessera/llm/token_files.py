"""Token-id output: documents as Parquet list columns that can be read selectively.

File format: Parquet, one row per document in ascending id, columns ``doc_id`` (the id's own
type), ``n_tokens`` and ``tokens`` (list of int32, the end id last).  Token ids are delta-packed or
dictionary-coded, ids and counts delta-packed; row groups and pages have set sizes, so the page
index lets a reader fetch the tokens of an id range, or ids and counts alone, without the rest.
Files are numbered in the order of the ids they hold.

Encoding uses the tokenizers library and gives the ids of the whole text; see ``Encoder``.

Defined cases: a null or empty text is the end id alone; rows of one id are ordered by the hash
of their text, then by the text; a null id comes first; an empty table makes files without rows;
only the id and text columns are read.
"""

from __future__ import annotations

import os
import zlib
from itertools import filterfalse, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_slices

#: Words up to this length are remembered, up to so many at a time.
WORD_CHARS, WORDS = 32, 5 << 18
#: Bytes of texts that are encoded at a time, words whose ids are gathered at a time.
SLICE_BYTES, RUNS = 1 << 20, 1 << 17
_TAIL = regex.compile(r"(\p{L}+)([^\s\p{L}\p{N}']+)")


def _plain(text: str) -> bool:
    """Whether single spaces and line feeds between other characters are the text's only white space."""
    return (text.replace("\n", "").isprintable() and text[0] not in " \n" and text[-1] not in " \n"
            and not any(run in text for run in ("  ", "\n\n", " \n", "\n ")))


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` at some places, one behind the other."""
    out = [flat[:0]]
    for a in range(0, len(starts), RUNS):        # short arrays of places, however long a text is
        first, size = starts[a:a + RUNS], sizes[a:a + RUNS]
        ends = np.cumsum(size)
        out.append(flat[np.arange(ends[-1]) + np.repeat(first - ends + size, size)])
    return np.concatenate(out)


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The array itself if it has ``size`` places, else a longer one that begins with it.

    It grows by half, so what is added little by little is copied few times.
    """
    if size <= len(values):
        return values
    out = np.empty(max(size, len(values) * 3 // 2), values.dtype)
    out[:len(values)] = values
    return out


class Encoder:
    """Ids of whole texts by the tokenizers library, each distinct word encoded once while it is remembered.

    In a text without runs of white space the splitter joins a space to the word behind it, never
    to what stands before, and a line feed to neither; so a text's ids are those of its lines'
    first words, of its other words with their space, and of its line feeds.  Words of letters
    are encoded many at a time, as one text whose ids are dealt out again, and so are the letters
    that begin a word ended by other marks.  Other texts go through the library as they are.

    Words are numbered: a line's first word with the line feed before it, others without their space.
    All words' ids lie in one array, from which those of the texts are gathered.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.space = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.space[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith("Ġ")]] = True
        self.feed = self.tokenizer.encode("\n", add_special_tokens=False).ids[0]
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}    # a word, or a mark behind a word's letters (led by a space), to its number
        self.long: list[str] = []            # those that are too long to be remembered beyond a slice
        # all words' ids, and where each word's begin and how many they are: longer than what is used, the rest is free
        self.used, self.ids = 0, np.zeros(1 << 16, np.int32)
        self.words, self.starts, self.sizes = 0, np.zeros(1 << 14, np.int32), np.zeros(1 << 14, np.int32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _keep(self, words: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Remember words by their ids, which lie one behind the other."""
        n, end = self.words + len(words), self.used + len(ids)
        self.numbers.update(zip(words, range(self.words, n)))
        self.long += [w for w in words if len(w) > WORD_CHARS]
        self.starts, self.sizes, self.ids = _room(self.starts, n), _room(self.sizes, n), _room(self.ids, end)
        self.starts[self.words:n] = self.used + np.cumsum(sizes) - sizes
        self.sizes[self.words:n] = sizes
        self.ids[self.used:end] = ids
        self.words, self.used = n, end

    def _keep_whole(self, words: list[str], texts: list[str]) -> None:
        found = self._whole(texts)
        self._keep(words, np.array([i for x in found for i in x], np.int32), np.fromiter(map(len, found), np.int64, len(found)))

    def _letters(self, words: list[str], first: bool) -> None:
        """Ids of words of letters, 512 in one text, after a space each or (``first``) after a line feed each.

        Such a word's first id holds its space, and no other id does; a line feed is an id of its own.
        """
        for a in range(0, len(words), 1 << 13):      # the library's own results are large: those of a few texts at a time
            parts = [words[b:b + 512] for b in range(a, min(a + (1 << 13), len(words)), 512)]
            kept, sizes = [], []
            for part, found in zip(parts, self._whole(["".join(p) if first else " " + " ".join(p) for p in parts]), strict=True):
                ids = np.array(found, np.int32)
                begins = np.flatnonzero(ids == self.feed if first else self.space[ids])
                if len(begins) != len(part):
                    raise ValueError("a word's first id isn't the only one that holds its space")
                kept.append(ids)
                sizes.append(np.diff(begins, append=len(ids)))
            self._keep([w for p in parts for w in p], np.concatenate(kept), np.concatenate(sizes))

    def _learn(self, new: list[str], first: bool) -> None:
        """Ids of words with their space, or (``first``) of words after a line feed, which lead them."""
        known, skip = self.numbers, int(first)
        tails, stems, ends, rest = [], [], [], []
        alpha = (lambda w: w[1:].isalpha()) if first else str.isalpha
        letters = [*filter(alpha, new)]
        for w in filterfalse(alpha, new):
            bare = w[skip:]
            stem = bare.rstrip(",.")
            if not stem.isalpha() and (m := _TAIL.fullmatch(bare)):
                stem = m[1]
            if stem.isalpha():
                tails.append(w)
                stems.append(w[:skip + len(stem)])
                ends.append(" " + bare[len(stem):])
            else:
                rest.append(w)
        fresh = dict.fromkeys(letters)
        fresh.update((stem, None) for stem in stems if stem not in known)
        self._letters([*fresh], first)
        marks = [m for m in set(ends) if m not in known]
        self._keep_whole(marks, [m[1:] for m in marks])
        if tails:
            both = np.empty((len(tails), 2), np.int64)
            for k, found in enumerate((stems, ends)):
                both[:, k] = np.fromiter(map(known.__getitem__, found), np.int64, len(tails))
            ids = _gather(self.ids, self.starts[both.ravel()], self.sizes[both.ravel()])
            self._keep(tails, ids, self.sizes[both].sum(axis=1))
        self._keep_whole(rest, rest if first else [" " + w for w in rest])

    def flat(self, texts: list, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the end id behind each, one text behind the other, and how many each has."""
        plain = np.array([bool(t) and _plain(t) and not any(a in t for a in self.added) for t in texts], bool)
        odd = [k for k, t in enumerate(texts) if t and not plain[k]]
        cut = pc.split_pattern(pa.array(["\n" + t.replace("\n", " \n") for t, p in zip(texts, plain.tolist()) if p], pa.large_string()), " ")
        coded = cut.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()      # faster than to_pylist
        if self.words + len(words) > WORDS or self.used > 8 * WORDS:
            self._forget()
        number = np.fromiter(map(self.numbers.get, words, repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(number < 0)
        new = [words[k] for k in unknown.tolist()]
        self._learn([w for w in new if w[0] == "\n"], True)
        self._learn([w for w in new if w[0] != "\n"], False)
        number[unknown] = np.fromiter(map(self.numbers.__getitem__, new), np.int64, len(new))
        number = number[coded.indices.to_numpy()]
        for w in self.long:
            self.numbers.pop(w, None)
        self.long.clear()
        starts, sizes = self.starts[number], self.sizes[number]
        begins = cut.offsets.to_numpy()
        starts[begins[:-1]] += 1                 # no line feed before a text's first word
        sizes[begins[:-1]] -= 1
        counts = np.ones(len(texts), np.int64)
        counts[plain] += np.add.reduceat(sizes, begins[:-1]) if len(sizes) else 0
        others = self._whole([texts[k] for k in odd])
        for k, ids in zip(odd, others, strict=True):
            counts[k] += len(ids)
        ends = np.cumsum(counts)
        out, free = np.full(ends[-1] if len(ends) else 0, end_id, np.int32), np.ones(ends[-1] if len(ends) else 0, bool)
        free[ends - 1] = False
        for k, ids in zip(odd, others, strict=True):
            at = slice(ends[k] - counts[k], ends[k] - 1)
            out[at], free[at] = ids, False
        out[free] = _gather(self.ids, starts, sizes)
        return out, counts

    def encode(self, texts: list, end_id: int) -> list[bytes]:
        """Ids of each text, the end id last, as little-endian unsigned 32-bit bytes."""
        flat, counts = self.flat(texts, end_id)
        data, ends = flat.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each vocabulary and Python worker, so that pieces stay remembered between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 2, encoding: str = "dictionary", row_group_mb: int = 32, page_kb: int = 256,
                 page_rows: int = 2000) -> None:
    """Encode every text and write the files, in ascending order of the ids."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = source.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions(*order)

    def run(batches):
        for batch in batches:
            for part, texts in text_slices(batch, "text", SLICE_BYTES):
                flat, counts = encoder(tokenizer_path).flat(texts, end_id)
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts.astype(np.int32)), pa.ListArray.from_arrays(offsets, flat)],
                    ["doc_id", "n_tokens", "tokens"])
        pa.default_memory_pool().release_unused()

    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
    schema = StructType([source.schema["doc_id"], StructField("n_tokens", IntegerType()),
                         StructField("tokens", ArrayType(IntegerType()))])
    options = {
        "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false",
        "parquet.enable.dictionary#tokens.list.element": str(encoding == "dictionary").lower(),
        "parquet.block.size": row_group_mb << 20, "parquet.page.size": page_kb << 10,
        "parquet.page.row.count.limit": page_rows, "parquet.dictionary.page.size": 1 << 20,
    }
    ordered.mapInArrow(run, schema).write.options(**options).parquet(path)


def read_tokens(spark: SparkSession, path: str, low=None, high=None) -> DataFrame:
    """(doc_id, n_tokens, tokens), for ids from ``low`` to ``high`` if given: pages outside are not read."""
    out = spark.read.parquet(path)
    if low is not None:
        out = out.filter(F.col("doc_id") >= low)
    return out if high is None else out.filter(F.col("doc_id") <= high)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens) alone; token pages are not read."""
    return spark.read.parquet(path).select("doc_id", "n_tokens")


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file, row) of every document, from the files alone.

    ``start`` counts the ids of all documents before it: running counts within a file (its size
    bounds the window) on top of the totals of the files before it, one row a file.
    """
    rows = spark.read.parquet(path).select("doc_id", "tokens", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))

    def run(batches):
        for batch in batches:
            lists = batch.column("tokens")
            flat, at = np.asarray(lists.values).astype("<u4"), np.asarray(lists.offsets)
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64()),
                 batch.column("file"), batch.column("row")], ["doc_id", "n_tokens", "ids_crc32", "file", "row"])

    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([rows.schema["doc_id"], StructField("n_tokens", LongType()), StructField("ids_crc32", LongType()),
                         StructField("file", StringType()), StructField("row", LongType())])
    sums = rows.mapInArrow(run, schema)
    counts = spark.read.parquet(path).select("n_tokens", F.col("_metadata.file_name").alias("file"))
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = (counts.groupBy("file").agg(F.sum(F.col("n_tokens").cast("long")).alias("total"))
             .select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")))  # one row a file
    within = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (sums.withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(bases, "file")
            .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "file", "row"))

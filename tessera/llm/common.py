"""Helpers shared by the operators: table access, shared storage, text batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

#: Most bytes of text that a kernel works on at a time (a longer text comes alone).
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col: str, mod: int):
    """crc32 of the id as text, modulo ``mod``: decides what is held out."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(mod)


def cut(sizes, limit: int, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Row ranges whose sizes add up to about ``limit``, at least one row each and at most ``rows``."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (total + n > limit or i - start == rows):
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` characters together, at least one row each."""
    yield from cut([len(t) if t else 0 for t in texts], limit)


def text_slices(batch: pa.RecordBatch, text_col: str, limit: int = CHUNK_BYTES,
                rows: int | None = None) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of an Arrow batch with about ``limit`` bytes of text and at most ``rows`` rows each, and their texts (null stays None).

    Only one slice's texts are Python objects at a time.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
    for a, b in cut(sizes, limit, rows):
        part = batch.slice(a, b - a)
        yield part, part.column(text_col).to_pylist()


def text_chunks(batches: Iterator[pa.RecordBatch], text_col: str, limit: int = CHUNK_BYTES, rows: int | None = None):
    """``text_slices`` of all batches."""
    for batch in batches:
        yield from text_slices(batch, text_col, limit, rows)


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace")


def _word_table() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    for c in range(256):
        if chr(c).isalnum() and c < 128 or c >= 128 or c == ord("_"):
            t[c] = c
    return t


#: Bytes of words (letters, digits, underscore, all non-ASCII) map to themselves, the rest to a space.
WORD_BYTES = _word_table()


def packed(texts: list, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each between two spaces; ``offsets`` has one more entry than texts.

    Text i lies in data[offsets[i]:offsets[i + 1]], which starts with a space; one more space ends the array.
    """
    raw = [encoded(t.lower() if lower and t else t) for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=offsets[1:])
    return np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8), offsets


def by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one per byte) over each text of ``packed``."""
    return np.add.reduceat(values, offsets[:-1]) if len(offsets) > 1 else np.zeros(0, values.dtype)


def ids_of(df: DataFrame, id_col: str, cls: str, per_class: int | dict) -> DataFrame:
    """At most ``per_class`` rows of each class (a number, or one for each class), the first in the order of their ids' hash.

    A cut on the hash, set from each class's row count, leaves about 1.5 * ``per_class`` rows of a
    class, so the ranking doesn't get a whole class in one task.
    """
    unit = F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) / F.lit(float(1 << 30))
    counts = df.groupBy(cls).agg(F.count("*").alias("__n"))  # one row a class
    order = Window.partitionBy(cls).orderBy(unit, id_col)
    most = F.lit(per_class) if isinstance(per_class, int) else F.coalesce(
        *[F.when(F.col(cls) == c, n) for c, n in per_class.items()], F.lit(0))
    near = df.join(F.broadcast(counts), cls).filter(unit <= 1.5 * most / F.col("__n"))
    return (near.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= most)
            .drop("__rank", "__n"))


def scored_slices(batches: Iterator[pa.RecordBatch], fields: list[tuple[str, pa.DataType]], kernel,
                  limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """(id, fields) of batches of id and text, one batch of results for each slice of texts.

    A batch of the input may be a task's whole rows, and lists of ids are larger than their texts, so
    results are handed on by the slice: neither this process nor the JVM holds those of more.
    """
    names = ["id", *(n for n, _ in fields)]
    for batch in batches:
        for part, texts in text_slices(batch, "text", limit, rows):
            values = [pa.array(v, t) for v, (_, t) in zip(kernel(texts), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("id"), *values], names)
    pa.default_memory_pool().release_unused()


def scored(df: DataFrame, id_col: str, text_col: str, fields: list[tuple[str, pa.DataType]], kernel,
           limit: int = CHUNK_BYTES, rows: int | None = None) -> DataFrame:
    """One row for each row of ``df``: its id and what ``kernel(texts)`` returns, a list per field.

    Only the id and the text are read; other columns, whatever their names, are left out.  What a task took from
    the Arrow pool goes back when it ends, so that a worker kept for the next stage holds none of it.
    """
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        return scored_slices(batches, fields, kernel, limit, rows)

    from pyspark.sql.pandas.types import from_arrow_type
    from pyspark.sql.types import StructField, StructType
    schema = StructType([source.schema["id"], *(StructField(n, from_arrow_type(t)) for n, t in fields)])
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def kept(df: DataFrame, text_col: str, keep, limit: int = CHUNK_BYTES) -> DataFrame:
    """Rows of ``df``, all columns, for whose text ``keep(texts)`` gives true."""
    def run(batches):
        for batch in batches:
            mask = []
            for _, texts in text_slices(batch, text_col, limit):
                mask.extend(bool(x) for x in keep(texts))
            yield batch.filter(pa.array(mask, pa.bool_()))
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, df.schema)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str,
                  per_class: int | dict) -> DataFrame:
    """(label, text) of a bounded sample: up to ``per_class`` documents of each class, by the hash of the id.

    Null ids and labels are left out; an id labelled more than once has its greatest label; of
    documents with one id, one is taken.  Only ids and labels are shuffled to choose the sample.
    """
    lab = (labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("label")))
    ids = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    chosen = ids_of(lab.join(ids, "id", "left_semi"), "id", "label", per_class)
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # at most per_class rows a class: a proven bound
    return text.join(F.broadcast(chosen), "id").dropDuplicates(["id"]).select("id", "label", "text")

"""Exact top-k inner products: norm-sorted vectors, rotated partial sums, Cauchy-Schwarz bounds.

Vectors are rotated into the basis of the singular vectors of a bounded sample, so that the
leading coordinates carry most of an inner product.  All rows are range-partitioned by length,
longest first, and sorted so within a partition.  For a block of queries a task goes down its
rows and keeps the best ``k`` of every query.  A query is done with the task when its length
times the next row's length is below its k-th best score (all later rows are shorter); until
then a row is passed over if the partial sum over the leading coordinates plus the product of
the residual lengths is below it.  What remains is scored exactly on the unrotated vectors.

The first bar of every query is its k-th best score among the longest ``seeds`` rows, found
on the driver from that bounded set, so tasks emit little.  Queries come in blocks of
``query_block``, each block's results are written to the shared folder, and the best ``k`` of
all tasks are ranked there.  Rotation only changes how much is pruned, never the result.

Defined cases: vectors that are null or hold null or non-finite components take no part; shorter
vectors count as padded with zeros; a null id takes no part; a query passes over all rows with
its own id; of queries with one id the least vector asks; other repeated rows are candidates
of their own; ties go to the smaller id; fewer than ``k`` candidates give fewer rows; scores
beyond 64 bits are held at the limits of a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import shared_path

ROWS = 1024
_LONG = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v, norm): v holds floor(scale * component) as longs."""
    sound = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias(vec_col))
            .filter(F.col("id").isNotNull() & F.col(vec_col).isNotNull() & sound)
            .select("id", F.transform(vec_col, lambda x: F.floor(x * F.lit(float(scale)))).alias("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as long integers, padded with zeros."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten()).astype(np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _largest(x: np.ndarray) -> int:
    return max((abs(int(x.max())), abs(int(x.min()))), default=0) if x.size else 0


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products of the rows of q and x, exact."""
    if _largest(q) * _largest(x) * max(q.shape[1], 1) < 1 << 53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    wide = q.astype(object) @ x.astype(object).T
    return np.clip(wide, -_LONG - 1, _LONG).astype(np.int64)


class QueryBlock:
    """Queries with their rotation and first bars."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, rotation: np.ndarray, lead: int, k: int):
        self.ids, self.q, self.rotation, self.lead, self.k = ids, q, rotation, lead, k
        self.norm = np.sqrt((q.astype(np.float64) ** 2).sum(1))
        turned = q.astype(np.float64) @ rotation
        self.head, self.rest = turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(1))
        self.bar = np.full(len(ids), -np.inf)

    def seed(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Set the bars to the k-th best score among some rows."""
        if len(ids) <= self.k:
            return
        for a in range(0, len(self.ids), ROWS):
            s = exact(self.q[a:a + ROWS], x).astype(np.float64)
            s[self.ids[a:a + ROWS, None] == ids[None, :]] = -np.inf
            self.bar[a:a + ROWS] = np.partition(s, -self.k, axis=1)[:, -self.k]

    def search(self, blocks):
        """(query, id, score) arrays of the best k per query of the rows in ``blocks``, longest rows first."""
        n, k = len(self.ids), self.k
        scores = np.full((n, k), -_LONG - 1, np.int64)
        owners = np.full((n, k), _LONG, np.int64)
        bar = self.bar.copy()
        active = np.arange(n)
        for ids, x, norm in blocks:
            active = active[self.norm[active] * norm[0] * (1 + 1e-9) + 1e-6 >= bar[active]]
            if not len(active):
                break
            turned = x.astype(np.float64) @ self.rotation
            head, rest = turned[:, :self.lead], np.sqrt((turned[:, self.lead:] ** 2).sum(1))
            for a in range(0, len(active), ROWS):
                rows = active[a:a + ROWS]
                slack = 1e-9 * np.outer(self.norm[rows], norm) + 1e-6
                hope = self.head[rows] @ head.T + np.outer(self.rest[rows], rest) + slack >= bar[rows, None]
                hope &= self.ids[rows, None] != ids[None, :]
                some, cols = np.flatnonzero(hope.any(1)), np.flatnonzero(hope.any(0))
                if not len(some):
                    continue
                rows, hope = rows[some], hope[np.ix_(some, cols)]
                s = exact(self.q[rows], x[cols])
                s[~hope] = -_LONG - 1
                names = np.where(hope, ids[cols][None, :], _LONG)
                s, names = np.concatenate([scores[rows], s], 1), np.concatenate([owners[rows], names], 1)
                best = np.lexsort((names, ~s), axis=1)[:, :k]  # ~s sorts as -s does, without overflow
                scores[rows], owners[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(names, best, 1)
                full = owners[rows, -1] != _LONG
                bar[rows] = np.where(full, np.maximum(bar[rows], scores[rows, -1]), bar[rows])
        query, place = np.nonzero((owners != _LONG) & (scores >= np.where(np.isfinite(self.bar), self.bar, -np.inf)[:, None]))
        return self.ids[query], owners[query, place], scores[query, place]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 64, query_block: int = 8192, sample: int = 8192, seeds: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows of ``vectors`` for every row of ``queries``."""
    spark = vectors.sparkSession
    rows = quantised(vectors, id_col, vec_col, scale)
    asked = quantised(queries, id_col, vec_col, scale).groupBy("id").agg(F.min("v").alias("v"))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    dims = max(dims, asked.agg(F.max(F.size("v"))).first()[0] or 0)
    root = shared_path(spark, "topk")
    schema = "query_id long, rank int, vec_id long, score long"
    spark.createDataFrame([], schema).write.parquet(root)

    few = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    x = matrix(few["v"].combine_chunks(), dims).astype(np.float64)
    values, basis = np.linalg.eigh(x.T @ x) if dims else (np.zeros(0), np.zeros((0, 0)))
    rotation, values = basis[:, ::-1], values[::-1]
    lead = int(np.searchsorted(np.cumsum(values), 0.7 * values.sum())) + 1 if dims else 0
    top = rows.orderBy(F.desc("norm"), "id").limit(seeds).select("id", "v").toArrow()
    top_ids, top_x = np.asarray(top["id"].cast(pa.int64())), matrix(top["v"].combine_chunks(), dims)
    by_length = rows.repartitionByRange(F.desc("norm"), "id").sortWithinPartitions(F.desc("norm"), "id")

    def answer(block: list) -> None:
        ids = np.array([r[0] for r in block], np.int64)
        q = np.zeros((len(block), dims), np.int64)
        for i, r in enumerate(block):
            q[i, :len(r[1])] = r[1]
        made = QueryBlock(ids, q, rotation, lead, k)
        made.seed(top_ids, top_x)
        shared = spark.sparkContext.broadcast(made)  # query_block vectors at most

        def run(batches):
            def parts():
                for batch in batches:
                    m, names = matrix(batch.column("v"), dims), np.asarray(batch.column("id").cast(pa.int64()))
                    norm = np.asarray(batch.column("norm"))
                    for a in range(0, len(names), ROWS):
                        yield names[a:a + ROWS], m[a:a + ROWS], norm[a:a + ROWS]
            found = shared.value.search(parts())
            for _ in batches:  # rows that no query can want any more
                pass
            for a in range(0, len(found[0]), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + (1 << 16)]) for c in found], ["query_id", "vec_id", "score"])

        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        (by_length.mapInArrow(run, "query_id long, vec_id long, score long")
         .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
         .select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(root))

    block = []
    for row in asked.select("id", "v").toLocalIterator():
        block.append(row)
        if len(block) == query_block:
            answer(block)
            block = []
    if block:
        answer(block)
    return spark.read.schema(schema).parquet(root)

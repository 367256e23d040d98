"""Vectors, covariance and PCA.

Rows stay in executors.  Covariance is two passes: the column means (d
numbers), then per-partition Gram matrices of the centred rows computed with
numpy and summed by position -- a shuffle of d*d partial sums per partition,
independent of the row count.  Only the d x d matrix reaches the driver,
where it is diagonalised.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """sum(a_i * b_i) of two equal-length double arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def logistic(z: Column) -> Column:
    """X11: 1 / (1 + exp(-z))."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def as_doubles(df: DataFrame, col: str) -> Column:
    return F.transform(col, lambda x: x.cast("double"))


def mean_vector(df: DataFrame, col: str) -> DataFrame:
    """(pos, mean) per vector position; one summary row per partition, merged in the JVM."""
    mean = Summarizer.mean(array_to_vector(as_doubles(df, col))).alias("m")
    return df.filter(F.col(col).isNotNull()).agg(mean).select(F.posexplode(vector_to_array("m")).alias("pos", "mean"))


def _mean_array(df: DataFrame, col: str) -> np.ndarray:
    rows = mean_vector(df, col).collect()                    # d rows
    out = np.zeros(len(rows))
    for r in rows:
        out[r["pos"]] = r["mean"]
    return out


def dimensions(df: DataFrame, col: str) -> int:
    """Length of the vectors (0 without rows)."""
    return df.agg(F.max(F.size(col)).alias("d")).first()["d"] or 0


def covariance_long(df: DataFrame, col: str) -> DataFrame:
    """(i, j, cov) with divisor n, from centred per-partition Gram matrices."""
    mu = _mean_array(df, col)
    d = len(mu)

    def gram(batches):
        g = np.zeros((d, d))
        n = 0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.vstack(pdf["x"].to_numpy()).astype(np.float64) - mu
            g += x.T @ x
            n += len(x)
        if n:
            ii, jj = np.meshgrid(np.arange(d), np.arange(d), indexing="ij")
            yield pd.DataFrame({"i": ii.ravel(), "j": jj.ravel(), "s": g.ravel(),
                                "n": np.full(d * d, n, dtype=np.int64)})

    schema = "i long, j long, s double, n long"
    parts = df.select(as_doubles(df, col).alias("x")).mapInPandas(gram, schema)
    # every partition reports its row count on each (i, j) row, so sum(n) is the total n
    return (parts.groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
            .select("i", "j", (F.col("s") / F.col("n")).alias("cov")))


def covariance_matrix(df: DataFrame, col: str, max_dims: int = 4096) -> np.ndarray:
    """M36 on the driver, as columns of d * d numbers; more than ``max_dims`` dimensions are refused."""
    d = len(_mean_array(df, col))
    if d > max_dims:
        raise ValueError(f"{d} dimensions: a {d} x {d} matrix does not belong on the driver")
    got = covariance_long(df, col).toArrow()
    m = np.zeros((d, d))
    m[np.asarray(got["i"]), np.asarray(got["j"])] = np.asarray(got["cov"])
    return m


def pca(df: DataFrame, col: str, k: int = 2):
    """(components d x k, all eigenvalues descending), for at most 4,096 dimensions; ``pca_wide`` takes more.

    Eigenvector signs are fixed so that each component's largest-magnitude
    entry is positive.
    """
    cov = covariance_matrix(df, col)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    return _fixed_signs(vecs[:, order])[:, :k], vals[order]


def _block_product(df: DataFrame, col: str, mu: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, int]:
    """(sum over rows of x (x . block), rows) of centred rows x: the covariance times a d x l block, times the rows.

    Each partition sends its d x l sum as rows of l numbers; the d x d matrix is never made.
    """
    d, width = block.shape

    def partial(batches):
        total, n = np.zeros((d, width)), 0
        for batch in batches:
            x = batch.column(0)
            x = x.filter(x.is_valid())
            if len(x):
                rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), d) - mu
                total += rows.T @ (rows @ block)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({
                "j": pa.array(np.arange(d), pa.int32()), "n": pa.array(np.full(d, n), pa.int64()),
                "v": pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), width).cast(pa.list_(pa.float64()))})

    parts = df.select(as_doubles(df, col).alias("x")).mapInArrow(partial, "j int, n long, v array<double>")
    summed = parts.groupBy("j").agg(F.sum("n").alias("n"), *[F.sum(F.col("v")[c]).alias(f"v{c}") for c in range(width)]).toArrow()
    out = np.zeros((d, width))
    out[np.asarray(summed["j"])] = np.column_stack([np.asarray(summed[f"v{c}"]) for c in range(width)]) if summed.num_rows else 0.0
    return out, int(summed["n"][0].as_py()) if summed.num_rows else 0


def pca_wide(df: DataFrame, col: str, k: int = 2, extra: int = 8, most: int = 60, tol: float = 1e-9, seed: int = 17):
    """M37 for vectors too wide for a d x d matrix: (components d x k, their eigenvalues), by block power iteration.

    A random block of k + ``extra`` directions is multiplied by the covariance and made orthonormal again, a
    pass over the rows each, until the k leading eigenvalues and directions stand still (``tol``) or ``most`` passes are
    done; then the small matrix of the block against itself is diagonalised.  The driver holds d x (k + extra) numbers.
    """
    mu = _mean_array(df, col)
    d = len(mu)
    width = min(d, k + extra)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    last, vals, basis = None, np.zeros(width), q
    for _ in range(most):
        y, n = _block_product(df, col, mu, q)
        y /= max(n, 1)
        small = q.T @ y
        vals, turn = np.linalg.eigh((small + small.T) / 2)
        vals, turn = vals[::-1], turn[:, ::-1]
        basis = q @ turn
        lead = basis[:, :k]
        if width == d or last is not None and np.linalg.norm(lead - last @ (last.T @ lead)) < tol:
            break
        last, q = lead, np.linalg.qr(y)[0]
    return _fixed_signs(basis[:, :k]), vals[:k]


def _fixed_signs(vecs: np.ndarray) -> np.ndarray:
    """Eigenvectors with the largest-magnitude entry of each positive."""
    peak = vecs[np.argmax(np.abs(vecs), axis=0), np.arange(vecs.shape[1])]
    return vecs * np.where(peak < 0, -1.0, 1.0)


def pca_scores(df: DataFrame, col: str, components: np.ndarray, keep: list[str] | None = None,
               center: np.ndarray | None = None) -> DataFrame:
    """M37 scores: each row projected on the components (uncentred unless ``center``)."""
    x = as_doubles(df, col)
    if center is not None:
        mu = F.array(*[F.lit(float(m)) for m in center])
        x = F.zip_with(x, mu, lambda a, b: a - b)
    cols = []
    for c in range(components.shape[1]):
        w = F.array(*[F.lit(float(v)) for v in components[:, c]])
        cols.append(dot(x, w).alias(f"score{c}"))
    return df.select(*(keep or []), *cols)


def variance_explained(eigenvalues: np.ndarray, k: int = 1) -> float:
    """Share of total variance in the top k eigenvalues."""
    return float(np.sum(eigenvalues[:k]) / np.sum(eigenvalues))

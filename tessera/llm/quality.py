"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text's terms are the n-grams (1 to 4) of its shape (letters as a or A, digits as 0, runs of
equal signs cut to two, other signs as they are), hashed into columns, and one term for every word
that repeats the word 1 to ``LAGS`` places before it.  Term weights are (1 + ln count) * idf at
length 1; a truncated SVD of the sample's weights gives the latent-semantic space, and a text's
vector is its projection, again at length 1.

The labelled vectors, a bounded number, are broadcast.  Every document is compared with all of
them by exact blocked matrix products; the ``neighbours`` nearest (and all that tie with the
last) vote with their labels, each with its cosine to the power ``POWER`` times the share of its
class among all labelled rows over that in the sample.

Defined cases: a null text counts as empty; an empty text has the zero vector, is equally far
from all, and scores the share of label 1; so does every text if nothing was learned (0.5 without
labels); repeated rows get equal scores; only the id and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import packed, scored, text_chunks, training_rows
from tessera.llm.decontaminate import word_hashes

HASHED, LAGS = 2048, 8
DIMS = HASHED + LAGS
POWER = 4
CACHED = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[128:] = ord("a")
    for c in range(128):
        if chr(c).isalpha():
            t[c] = ord("a") if chr(c).islower() else ord("A")
        elif chr(c).isdigit():
            t[c] = ord("0")
    return t


_SHAPE = _shape_table()


def counts(texts: list) -> np.ndarray:
    """(texts, DIMS) term counts."""
    n = len(texts)
    data, offsets = packed(texts, lower=False)
    shape = _SHAPE[data]
    doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    shape = shape[:len(doc)]  # without the last space
    # the third and later of a run of equal signs add nothing
    keep = np.ones(len(shape), bool)
    keep[2:] = (shape[2:] != shape[1:-1]) | (shape[2:] != shape[:-2])
    shape, doc = shape[keep].astype(np.uint64), doc[keep]
    columns, code = [], np.zeros(len(shape), np.uint64)
    for size in range(1, 5):
        last = max(len(shape) - size + 1, 0)
        code = (code[:last] << np.uint64(8)) | shape[size - 1:]
        h = ((code + np.uint64(size)) * _MIX) >> np.uint64(64 - 11)
        same = doc[:last] == doc[size - 1:]
        columns.append((doc[:last] * DIMS + h.astype(np.int64))[same])
    words, starts = word_hashes(texts)
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(starts))
    for lag in range(1, LAGS + 1):
        again = np.flatnonzero((words[lag:] == words[:-lag]) & (owner[lag:] == owner[:-lag]))
        columns.append(owner[again] * DIMS + HASHED + lag - 1)
    table = np.bincount(np.concatenate(columns), minlength=n * DIMS).reshape(n, DIMS).astype(np.float32)
    table[[not t for t in texts]] = 0
    return table


def weighted(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.zeros_like(table)
    np.log(table, out=x, where=table > 0)
    x += table > 0
    x *= idf
    return unit(x)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def latent_space(x: np.ndarray, rank: int, seed: int = 3) -> np.ndarray:
    """Right singular vectors of the ``rank`` largest singular values, by subspace iteration."""
    rank = min(rank, *x.shape)
    q = np.linalg.qr(x.T @ np.random.default_rng(seed).normal(size=(x.shape[0], rank + min(8, x.shape[0] - rank))))[0]
    for _ in range(6):
        q = np.linalg.qr(x.T @ (x @ q))[0]
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return (q @ v.T)[:, :rank].astype(np.float32)


@dataclass
class QualityModel:
    idf: np.ndarray
    space: np.ndarray     # (DIMS, rank)
    vectors: np.ndarray   # labelled vectors, one row each
    labels: np.ndarray
    votes: np.ndarray     # weight of each labelled row's class
    share: float          # of label 1
    neighbours: int

    def scores(self, texts: list) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(texts), self.share)
        v = unit(weighted(counts(texts), self.idf) @ self.space)
        near = v @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        last = np.partition(near, -k, axis=1)[:, -k]
        vote = np.where(near >= last[:, None], np.maximum(near, 0) ** POWER, 0) * self.votes
        total = vote.sum(1)
        empty = (np.abs(v).sum(1) == 0) | (total <= 0)
        return np.where(empty, self.share, vote @ self.labels / np.where(empty, 1, total)).clip(0, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
        per_class: int = 1024, rank: int = 48, neighbours: int = 24) -> QualityModel:
    """Learn from at most ``per_class`` labelled documents of each class.

    Spark chooses the sample and counts terms of whole texts; the driver gets those counts, at
    most DIMS numbers a document.
    """
    known = {int(r[0]): r[1] for r in labels.filter(F.col(label).isNotNull()).groupBy(label).count().collect()}
    total = sum(known.values())
    share = known.get(1, 0) / total if total else 0.5
    rows = training_rows(docs, labels, id_col, text_col, label, per_class)

    def terms(batches):
        for batch, texts in text_chunks(batches, "text", CACHED):
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label").cast(pa.int32()),
                 pa.array([r.tobytes() for r in counts(texts)], pa.binary())], ["id", "label", "counts"])

    got = rows.mapInArrow(terms, "id string, label int, counts binary").toArrow().sort_by("id")
    y = np.array(got["label"].to_pylist(), np.float32)
    if len(set(y)) < 2:
        none = np.zeros((0, 1), np.float32)
        return QualityModel(np.zeros(DIMS, np.float32), none, none, y[:0], y[:0], share, neighbours)
    table = np.frombuffer(b"".join(c.as_py() for c in got["counts"]), np.float32).reshape(len(y), DIMS)
    idf = (np.log((len(y) + 1) / ((table > 0).sum(0) + 1)) + 0.1).astype(np.float32)
    x = weighted(table, idf)
    space = latent_space(x, rank)
    weight = {c: known[c] / total / float((y == c).mean()) for c in (0, 1)}
    votes = np.where(y == 1, weight[1], weight[0]).astype(np.float32)
    return QualityModel(idf, space, unit(x @ space).astype(np.float32), y, votes, share, neighbours)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the likelihood of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 * per_class vectors at most
    return scored(docs, id_col, text_col, [("score", pa.float64())], lambda texts: [shared.value.scores(texts)], CACHED)

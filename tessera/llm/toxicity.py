"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A text is a bag of subwords: the byte n-grams (3 to 6) of its lower-cased words, word
boundaries included, hashed into ``2**bits`` buckets.  Every bucket has a weight and an
embedding; a text's vector is the weighted average of its subwords' embeddings, and a linear
softmax over it gives the class.  Embeddings and softmax are trained jointly in numpy with
Adagrad on a bounded sample of labelled rows.

A few words make a long text toxic, so a plain average would drown them, and a model of all subwords would
learn its training texts by heart.  The weight of a bucket is therefore how much more often it
stands in texts of one label than of the other, in standard errors above SURE; the many buckets at or below, which
chance alone explains, weigh nothing and take no part.  A misspelt word shares n-grams with the word that was seen
and so keeps its vector.  With no bucket above SURE (very few labels) all scores are the share of label 1.

Scoring needs one scalar per bucket (its embedding times the softmax's difference), so a
task does one gather for every subword.

Defined cases: a null text counts as empty; an empty text, or one without subwords, has the
zero vector and so the score of the bias; repeated rows get equal scores; a null label is
left out; with no labelled row, or one class only, the score is the share of label 1 (0.5
without labels).  Other columns are passed by, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD_BYTES, by_text, kept, packed, scored, text_chunks, training_rows, written

SIZES = (3, 4, 5, 6)
BITS = 18
#: Standard errors that the best of 2**18 buckets may be off by chance.
SURE = 4.5
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Text that a task works on at a time: its arrays then stay in the processor's cache.
CACHED = 1 << 16


def subwords(texts: list, bits: int):
    """Yield the bucket of every byte position for each n-gram size, then the offsets of ``packed``.

    Bucket 0 stands for "no n-gram here" (a word boundary inside it); it has no weight and no value.
    """
    data, offsets = packed(texts)
    data = WORD_BYTES[data]
    inside = (data != 32).view(np.uint8)
    wide = data.astype(np.uint64)
    n = len(data)
    buckets = []
    code, valid = wide.copy(), np.ones(n, np.uint8)  # valid: no space strictly inside the n-gram
    for size in range(2, max(SIZES) + 1):
        last = max(n - size + 1, 0)
        code = (code[:last] << np.uint64(8)) | wide[size - 1:]
        valid = valid[:last] & inside[size - 2:size - 2 + last] if size > 2 else valid[:last]
        if size in SIZES:
            h = ((code + np.uint64(size)) * _MIX) >> np.uint64(64 - bits)
            buckets.append(h.astype(np.int32) * valid)
    return buckets, offsets


def _bag(texts: list, bits: int, known: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets (of the ``known`` ones, if given) and their counts, for each text alone."""
    bags = []
    for t in texts:
        b = np.concatenate(subwords([t], bits)[0])
        b, c = np.unique(b[b > 0] if known is None else b[known[b]], return_counts=True)
        bags.append((b.astype(np.int32), c.astype(np.int64)))
    return bags


def relevance(with_1: np.ndarray, with_0: np.ndarray, n_1: int, n_0: int) -> np.ndarray:
    """Weight of buckets held by so many of the ``n_1`` texts of label 1 and ``n_0`` of label 0."""
    p = (with_1 + with_0) / max(n_1 + n_0, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / max(n_1, 1) + 1 / max(n_0, 1)))
    return np.maximum((with_1 / max(n_1, 1) - with_0 / max(n_0, 1)) / spread - SURE, 0).astype(np.float32)


@dataclass
class ToxicityModel:
    bits: int
    weight: np.ndarray   # per bucket: how much it counts in the average
    value: np.ndarray    # per bucket: weight * (embedding . softmax difference)
    bias: float

    def __post_init__(self):
        #: Value and weight of a bucket side by side, so that one gather fetches both.
        self.table = (self.value + 1j * self.weight).astype(np.complex64)

    def scores(self, texts: list) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        buckets, offsets = subwords(texts, self.bits)
        both = np.zeros(int(offsets[-1]), np.complex64)
        for h in buckets:
            h = h[:len(both)]
            both[:len(h)] += self.table[h]
        total = by_text(both.astype(np.complex128), offsets)
        s, d = total.real, total.imag
        z = np.divide(s, d, out=np.zeros(len(s)), where=d > 0) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _constant(bits: int, ones: int, n: int) -> ToxicityModel:
    """The share of label 1 for every text."""
    none = np.zeros(1 << bits, np.float32)
    bias = 0.0 if n == 0 else 60.0 if ones == n else -60.0 if ones == 0 else float(np.log(ones / (n - ones)))
    return ToxicityModel(bits, none, none, bias)


def train(bags: list, labels: np.ndarray, bits: int = BITS, dim: int = 4, epochs: int = 20, rate: float = 1.0,
          batch: int = 64, seed: int = 7, weight: np.ndarray | None = None) -> ToxicityModel:
    """Joint training of embeddings and softmax over (buckets, counts) bags; empties the list of bags."""
    size, n = 1 << bits, len(bags)
    share = float(labels.mean()) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        return _constant(bits, int(labels.sum()) if n else 0, n)
    # all bags in two flat arrays: no small objects that the driver would keep
    sizes = np.array([len(b) for b, _ in bags], np.int64)
    start = np.concatenate([[0], np.cumsum(sizes)])
    cols = np.concatenate([b for b, _ in bags])
    vals = np.concatenate([c for _, c in bags]).astype(np.float32)
    bags.clear()
    if weight is None:
        held = [np.bincount(cols[np.repeat(labels, sizes) == k], minlength=size) for k in (0, 1)]
        weight = relevance(held[1], held[0], int(labels.sum()), int(n - labels.sum()))
    if not weight.any():
        return _constant(bits, int(labels.sum()), n)
    rng = np.random.default_rng(seed)
    seen = np.flatnonzero(weight)
    row = np.full(size, -1, np.int32)
    row[seen] = np.arange(len(seen), dtype=np.int32)
    emb = np.zeros((len(seen), dim), np.float32)
    soft = rng.normal(0, 1, (dim, 2)).astype(np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    g_emb, g_soft, g_bias = np.full(emb.shape, 1e-8, np.float32), np.full(soft.shape, 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    vals *= weight[cols]
    total = np.bincount(np.repeat(np.arange(n), sizes), vals, n)
    vals /= np.repeat(np.maximum(total, 1e-9), sizes)
    cols = row[cols]
    cols[cols < 0] = 0          # these weigh nothing
    onehot = np.eye(2, dtype=np.float32)[labels]
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, batch):
            ids = order[a:a + batch]
            at = np.concatenate([np.arange(start[i], start[i + 1]) for i in ids])
            doc = np.repeat(np.arange(len(ids)), sizes[ids])
            held = vals[at] > 0
            at, doc = at[held], doc[held]
            col, val = cols[at], vals[at]
            hidden = np.stack([np.bincount(doc, emb[col, k] * val, len(ids)) for k in range(dim)], 1)
            z = hidden @ soft + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            err = ((p - onehot[ids]) / len(ids)).astype(np.float32)
            back = err @ soft.T
            used, where = np.unique(col, return_inverse=True)
            grad = np.stack([np.bincount(where, back[doc, k] * val, len(used)) for k in range(dim)], 1).astype(np.float32)
            gs, gb = hidden.T.astype(np.float32) @ err, err.sum(0)
            g_emb[used] += grad * grad
            emb[used] -= rate * grad / np.sqrt(g_emb[used])
            g_soft += gs * gs
            soft -= 0.1 * rate * gs / np.sqrt(g_soft)
            g_bias += gb * gb
            bias -= 0.1 * rate * gb / np.sqrt(g_bias)
    value = np.zeros(size, np.float32)
    value[seen] = emb @ (soft[:, 1] - soft[:, 0])
    return ToxicityModel(bits, weight, value * weight, float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
        per_class: int | dict | None = None, **options) -> ToxicityModel:
    """Train on at most ``per_class`` labelled documents of each class (2,048 of label 0 and 1,024 of label 1).

    Spark chooses the sample, counts the texts that hold each bucket, and turns the whole texts into
    bags of the buckets that weigh something; these bags, whose number ``per_class`` bounds, reach the driver.
    """
    bits = options.get("bits", BITS)
    size = 1 << bits
    sample = written(training_rows(docs, labels, id_col, text_col, label, per_class or {0: 2048, 1: 1024}), "toxicity")
    sample = sample.select(F.col("id").cast("string").alias("id"), F.col("label").cast("int").alias("label"), "text")
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}

    def held(batches):
        counts = np.zeros((2, size), np.int64)
        for batch, texts in text_chunks(batches, "text"):
            for mark, (buckets, _) in zip(batch.column("label").to_pylist(), _bag(texts, bits)):
                counts[int(mark == 1), buckets] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[1, at]), pa.array(counts[0, at])], ["bucket", "ones", "zeros"])

    found = (sample.mapInArrow(held, "bucket int, ones long, zeros long").groupBy("bucket")
             .agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).toArrow())      # at most 2**bits rows
    with_1, with_0 = np.zeros(size), np.zeros(size)
    with_1[np.asarray(found["bucket"])], with_0[np.asarray(found["bucket"])] = np.asarray(found["ones"]), np.asarray(found["zeros"])
    weight = relevance(with_1, with_0, n.get(1, 0), sum(n.values()) - n.get(1, 0))
    known = weight > 0

    def bags(batches):
        for batch, texts in text_chunks(batches, "text"):
            b = _bag(texts, bits, known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([x for x, _ in b], pa.list_(pa.int32())),
                 pa.array([x for _, x in b], pa.list_(pa.int64()))], ["id", "label", "buckets", "counts"])

    got = sample.mapInArrow(bags, "id string, label int, buckets array<int>, counts array<long>").toArrow().sort_by("id")
    pairs = [(b.values.to_numpy(), c.values.to_numpy()) for b, c in zip(got["buckets"], got["counts"], strict=True)]
    marks = (np.array(got["label"].to_pylist(), np.int64) == 1).astype(np.int64)
    return train(pairs, marks, weight=weight, **options)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the likelihood of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**bits buckets, whatever the data
    return scored(docs, id_col, text_col, [("score", pa.float64())],
                  lambda texts: [shared.value.scores(texts)], CACHED)


def reject(docs: DataFrame, model: ToxicityModel, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """Documents, all columns, that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return kept(docs, text_col, lambda texts: shared.value.scores(texts) < threshold, CACHED)

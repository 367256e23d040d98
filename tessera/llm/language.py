"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text's letters, lower-cased, with every other character as a space, give n-grams of 1 to 3
characters (none across more than one word), hashed into ``DIMS`` columns.  Their weight is
(1 + ln count) * idf, scaled to length 1.  The regression is trained with follow-the-regularised-
leader steps, one per document, under an elastic net: the L1 part keeps most weights at zero, the
L2 part bounds the rest.  A fifth of the sample is kept back from training and sets the
temperature that divides the logits, so that scores are probabilities.

Idf and weights are fitted on a bounded sample of the labelled documents.

Defined cases: a text that is null or has no letter is ``und`` with score 0; so is every text
when nothing was learned; with one language learned its score is 1; repeated rows get equal
answers; ties go to the language that sorts first; only the id and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import scored, text_chunks, training_rows

DIMS = 1 << 14
SIZES = (1, 2, 3)
UNKNOWN = "und"
CACHED = 1 << 15
#: Most rows in one dense table of counts: 8 MB of 64-bit numbers.
ROWS = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    return np.array([c < 0xD800 and chr(c).isalpha() or c > 0xDFFF and chr(c).isalpha() for c in range(1 << 16)])


LETTERS = _letters()


def counts(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(texts, DIMS) n-gram counts, and for each text whether it has a letter."""
    n = len(texts)
    lower = [" " + (t or "").lower() + " " for t in texts]
    chars = np.frombuffer("".join(lower).encode("utf-32-le", "replace"), np.uint32)
    letter = LETTERS[np.minimum(chars, 0xFFFF)]
    letter |= (chars > 0xFFFF) & np.array([chr(c).isalpha() for c in chars]) if (chars > 0xFFFF).any() else False
    wide = np.where(letter, chars, 32).astype(np.uint64)
    doc = np.repeat(np.arange(n, dtype=np.int64), [len(t) for t in lower])
    columns, space = [], ~letter
    code, inner = np.zeros(len(wide), np.uint64), np.zeros(len(wide), bool)
    for size in range(1, max(SIZES) + 1):
        last = max(len(wide) - size + 1, 0)
        code = code[:last] * np.uint64(0x110000) + wide[size - 1:]
        inner = inner[:last] | space[size - 2:size - 2 + last] if size > 2 else inner[:last]
        edges = space[:last] & space[size - 1:]  # spaces at both ends: no letter inside, or a word of one letter
        ok = ~inner & ~edges if size < 3 else ~inner
        h = ((code[ok] + np.uint64(size)) * _MIX) >> np.uint64(64 - 14)
        columns.append(doc[:last][ok] * DIMS + h.astype(np.int64))
    table = np.bincount(np.concatenate(columns), minlength=n * DIMS).reshape(n, DIMS).astype(np.float32)
    return table, np.bincount(doc[letter], minlength=n) > 0


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray   # (DIMS, languages)
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        table, letters = counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        x = _weighted(table, self.idf)
        p = softmax((x @ self.weights + self.bias) / self.temperature)
        best = p.argmax(1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
        return names, np.where(letters, p[np.arange(len(p)), best], 0.0)


def _weighted(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.zeros_like(table)
    np.log(table, out=x, where=table > 0)
    x += table > 0
    x *= idf
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = 3,
               alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001, seed: int = 5):
    """Weights and bias from sparse (columns, values) rows by per-coordinate FTRL-proximal steps."""
    z, n = np.zeros((DIMS + 1, classes)), np.zeros((DIMS + 1, classes))  # the last row is the bias, unpenalised
    penalty = np.array([l1])

    def weights(z, n, l1):
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((beta + np.sqrt(n)) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            cols = np.append(rows[i][0], DIMS)
            vals = np.append(rows[i][1], 1.0)
            w = weights(z[cols], n[cols], np.append(np.repeat(penalty, len(cols) - 1), 0.0)[:, None])
            err = softmax(vals @ w)
            err[labels[i]] -= 1
            g = vals[:, None] * err
            sigma = (np.sqrt(n[cols] + g * g) - np.sqrt(n[cols])) / alpha
            z[cols] += g - sigma * w
            n[cols] += g * g
    w = weights(z, n, np.append(np.full(DIMS, l1), 0.0)[:, None])
    return w[:DIMS].astype(np.float32), w[DIMS].astype(np.float32)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t):
        p = softmax(logits / np.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    low, high, g = np.log(0.02), np.log(20.0), (5 ** 0.5 - 1) / 2
    a, b = high - g * (high - low), low + g * (high - low)
    for _ in range(60):
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
        a, b = high - g * (high - low), low + g * (high - low)
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_class: int = 768, **options) -> LanguageModel:
    """Train on at most ``per_class`` documents of each language of ``docs``.

    Spark chooses the sample and counts n-grams of whole texts; the driver gets sparse counts
    of the sample, at most DIMS numbers a document.
    """
    rows = training_rows(docs, docs.select(id_col, lang_col), id_col, text_col, lang_col, per_class)

    def sparse(batches):
        for batch, texts in text_chunks(batches, "text", CACHED, ROWS):
            table, _ = counts(texts)
            cols = [np.flatnonzero(r).astype(np.int32) for r in table]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.string()), batch.column("label").cast(pa.string()), pa.array([c.tobytes() for c in cols], pa.binary()),
                 pa.array([r[c].tobytes() for r, c in zip(table, cols)], pa.binary())], ["id", "label", "columns", "counts"])

    got = rows.mapInArrow(sparse, "id string, label string, columns binary, counts binary").toArrow().sort_by("id")
    names = sorted(set(got["label"].to_pylist()))
    labels = np.array([names.index(x) for x in got["label"].to_pylist()], np.int64)
    pairs = [(np.frombuffer(c.as_py(), np.int32), np.frombuffer(v.as_py(), np.float32))
             for c, v in zip(got["columns"], got["counts"], strict=True)]
    del got
    df = np.zeros(DIMS)
    for c, _ in pairs:
        df[c] += 1
    idf = (np.log((len(pairs) + 1) / (df + 1)) + 1).astype(np.float32)
    if len(names) < 2:
        return LanguageModel(names, idf, np.zeros((DIMS, len(names)), np.float32), np.zeros(len(names), np.float32), 1.0)
    rows = []
    for c, v in pairs:
        x = (1 + np.log(v)) * idf[c]
        rows.append((c, x / max(float(np.sqrt((x * x).sum())), 1e-12)))
    back = np.arange(len(rows)) % 5 == 4
    learn = np.flatnonzero(~back)
    weights, bias = train_ftrl([rows[i] for i in learn], labels[learn], len(names), **options)
    logits = np.array([rows[i][1] @ weights[rows[i][0]] + bias for i in np.flatnonzero(back)])
    return LanguageModel(names, idf, weights, bias, calibrate(logits, labels[back]))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIMS rows, one column a language
    return scored(docs, id_col, text_col, [("lang_pred", pa.string()), ("score", pa.float64())],
                  lambda texts: shared.value.predict(texts), CACHED, ROWS)

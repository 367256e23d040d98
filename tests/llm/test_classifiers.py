"""Trained scores: held-out accuracy on the given tables, and defined answers for odd rows."""

import re
import zlib

import duckdb
import numpy as np
import pytest

from tessera.llm import language, quality, queries, toxicity
from tessera.llm.common import chunks

SF = "/root/testdata/sf0.01"


def labels(column):
    return {i: y for i, y in duckdb.connect().execute(f"SELECT doc_id, {column} FROM '{SF}/labels.parquet'").fetchall() if y is not None}


@pytest.mark.parametrize(("name", "column", "least"), [("op4_quality", "quality", 0.9), ("op10_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, column, least):
    rows = queries.QUERIES[name](spark, SF).collect()
    known = labels(column)
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    threshold = 0.5 if column == "quality" else 0.7
    assert all(r.predicted == (r.score >= threshold) for r in rows)
    out = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert sum(a == b for a, b in out) / len(out) >= least


@pytest.mark.parametrize("sf, recall, precision", [("sf0.01", 0.8, 0.8), ("sf0.1", 0.85, 0.9)])
def test_toxic_documents_are_found_among_held_out_ones(spark, sf, recall, precision):
    path = f"/root/testdata/{sf}"
    known = {i: y for i, y in duckdb.connect().execute(f"SELECT doc_id, toxic FROM '{path}/labels.parquet'").fetchall() if y is not None}
    rows = queries.QUERIES["op10_toxicity"](spark, path).filter("held_out").collect()
    caught = [known[r.doc_id] for r in rows if r.predicted and r.doc_id in known]
    assert sum(caught) >= recall * sum(known[r.doc_id] for r in rows if r.doc_id in known)
    assert sum(caught) >= precision * len(caught)


def test_toxicity_scores_equal_a_plain_sum(spark):
    """Scores by definition: every n-gram of every word, its weight and its value, one at a time."""
    texts, y = sample("abominable", "pleasant")
    m = toxicity.train(toxicity._bag(texts, toxicity.BITS), y)
    long = " ".join(["Abominably", "plain", "caf\u00e9", "a_b", "x1"] * 3000)
    for text in [*texts[::9], "ABOMINABLE matters, truly!", "one", "", long]:
        total = weight = 0.0
        for word in re.findall(rb"[a-z0-9_\x80-\xff]+", text.lower().encode()):
            held = b" " + word + b" "
            for size in toxicity.SIZES:
                for at in range(len(held) - size + 1):
                    code = int.from_bytes(held[at:at + size], "big")
                    bucket = ((code + size) * 0x9E3779B97F4A7C15 % 2 ** 64) >> (64 - m.bits)
                    total, weight = total + float(m.value[bucket]), weight + float(m.weight[bucket])
        z = (total / weight if weight else 0.0) + m.bias
        assert m.scores([text])[0] == pytest.approx(1 / (1 + np.exp(-z)), rel=1e-4)


def test_toxicity_takes_ids_of_any_type(spark):
    texts, y = sample("abominable", "pleasant")
    docs = spark.createDataFrame([(f"id{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    marks = spark.createDataFrame([(f"id{i}", int(v)) for i, v in enumerate(y)], "doc_id string, toxic int")
    model = toxicity.fit(docs, marks)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert min(got[f"id{i}"] for i in range(40, 80)) > 0.7 and max(got[f"id{i}"] for i in range(40)) < 0.3


def test_language_held_out(spark):
    rows = queries.QUERIES["op5_language_id"](spark, SF).collect()
    known = dict(duckdb.connect().execute(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    out = [(r.lang_pred, known[r.doc_id]) for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(a == b for a, b in out) / len(out) > 0.98


def sample(word, other, n=40):
    good = [f"plain words about {i} things and {other} matters" for i in range(n)]
    return good + [f"{t} {word}" for t in good], np.array([0] * n + [1] * n)


def test_misspellings_share_subwords():
    texts, y = sample("abominable", "pleasant")
    m = toxicity.train(toxicity._bag(texts, toxicity.BITS), y)
    s = m.scores(["plain words about 7 things and pleasant matters", "plain words about 7 things and abominabel", "", None])
    assert s[0] < 0.3 < 0.6 < s[1] and s[2] == s[3]


def test_scores_do_not_depend_on_the_chunk():
    texts, y = sample("abominable", "pleasant")
    m = toxicity.train(toxicity._bag(texts, toxicity.BITS), y)
    whole = m.scores(texts)
    parts = np.concatenate([m.scores(texts[a:b]) for a, b in chunks(texts, 200)])
    assert np.allclose(whole, parts, atol=1e-5)


def test_neighbour_vote_matches_brute_force(spark):
    docs = spark.createDataFrame([(i, ("Plain text here, number " if i % 2 else "JUNK!! ### ") + "word " * (i % 9)) for i in range(60)], "doc_id long, text string")
    m = quality.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) AS quality"), neighbours=5)
    texts = [r.text for r in docs.collect()][:20]
    v = quality.unit(quality.weighted(quality.counts(texts), m.idf) @ m.space)
    for x, got in zip(v, m.scores(texts)):
        near = np.array([float(x @ t) for t in m.vectors])
        chosen = near >= sorted(near)[-5] - 1e-6
        vote = np.maximum(near, 0) ** quality.POWER * m.votes * chosen
        assert got == pytest.approx(float(vote @ m.labels / vote.sum()), abs=1e-3)


def test_ftrl_is_sparse_and_calibrated():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 300)
    rows = [(np.array([c, 10 + int(rng.integers(0, 500))], np.int32), np.array([1.0, 0.2])) for c in y]
    w, b = language.train_ftrl(rows, y, 3, l1=0.5)
    assert (w != 0).mean() < 0.01 and all((v @ w[c] + b).argmax() == k for (c, v), k in zip(rows, y))
    logits = rng.normal(size=(4000, 3)) * 3
    p = language.softmax(logits / 2)
    drawn = np.array([rng.choice(3, p=x) for x in p])
    assert language.calibrate(logits, drawn) == pytest.approx(2, rel=0.15)


def test_edge_cases(spark, documents, empty):
    none = documents.selectExpr("doc_id", "cast(null as int) AS toxic", "cast(null as int) AS quality")
    one = documents.selectExpr("doc_id", "1 AS toxic", "0 AS quality")
    n = documents.count()
    tox = toxicity.fit(documents, none)
    assert {r.score for r in toxicity.score(documents, tox).collect()} == {0.5}
    assert min(r.score for r in toxicity.score(documents, toxicity.fit(documents, one)).collect()) > 0.99
    assert toxicity.reject(documents, tox, 0.7).columns == documents.columns and toxicity.reject(documents, tox, 0.7).count() == n
    assert {r.score for r in quality.score(documents, quality.fit(documents, none)).collect()} == {0.5}
    assert {r.score for r in quality.score(documents, quality.fit(documents, one)).collect()} == {0.0}
    assert toxicity.score(empty, tox).count() == 0 and quality.score(empty, quality.fit(empty, none)).count() == 0
    lang = language.identify(documents, language.fit(documents))      # no language is known
    assert {(r.lang_pred, r.score) for r in lang.collect()} == {("und", 0.0)}
    known = documents.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'aa', 'bb') AS lang")
    got = {(r.doc_id, r.lang_pred) for r in language.identify(documents, language.fit(known)).collect()}
    assert {(3, "und"), (4, "und"), (5, "und")} <= got and all(p in ("aa", "bb", "und") for _, p in got)
    assert language.identify(empty, language.fit(empty)).count() == 0


def test_many_short_texts_come_in_small_slices(spark):
    import pyarrow as pa

    from tessera.llm.common import text_slices
    texts = ["", "a"] * 5000
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = [t for _, t in text_slices(batch, "text", language.CACHED, language.ROWS)]
    assert max(map(len, parts)) == language.ROWS and sum(parts, []) == texts
    model = language.LanguageModel(["x"], np.ones(language.DIMS, np.float32), np.zeros((language.DIMS, 1), np.float32), np.zeros(1, np.float32), 1.0)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = language.identify(frame, model).groupBy("lang_pred").count().collect()
    assert {(r["lang_pred"], r["count"]) for r in got} == {("und", 5000), ("x", 5000)}

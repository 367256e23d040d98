"""Evaluation metrics and linear algebra against hand results, numpy and Spark ML."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from conftest import SF0001
from tessera.operators import evaluate as ev
from tessera.operators import linalg


def test_log_loss_cases(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "p double, label double")
    got = [r.log_loss for r in ev.with_log_loss(df).collect()]
    assert got[0] == pytest.approx(0.6931, abs=1e-4)
    assert got[1] == pytest.approx(36.84, abs=1e-2)
    assert got[2] == pytest.approx(36.74, abs=1e-2)     # 1 - 1e-16 rounds to 0.9999999999999999
    assert got[3] == pytest.approx(0.0, abs=1e-12)


def test_baseline_argument_honoured(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.1, 0.0)], "p double, label double")
    r = ev.log_loss_vs_baseline(df, baseline=0.5).collect()[0]
    assert r.baseline_p == 0.5 and r.log_loss_baseline == pytest.approx(math.log(2))


def test_roc_points(spark):
    df = spark.createDataFrame([(0.9, 1.0), (0.5, 0.0), (0.5, 1.0), (0.1, 0.0)], "p double, label double")
    pts = sorted((r.fpr, r.tpr) for r in ev.roc_points(df).collect())
    assert pts == [(0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_roc_auc_matches_spark(spark):
    rows = [(float(np.round(p, 2)), float(l)) for p, l in
            zip(np.random.default_rng(3).random(400), np.random.default_rng(4).integers(0, 2, 400))]
    df = spark.createDataFrame(rows, "p double, label double").repartition(4)
    mine = ev.roc_auc(df).collect()[0].auc
    raw = df.select(F.array(1 - F.col("p"), F.col("p")).alias("a"), "label")
    from pyspark.ml.functions import array_to_vector
    spark_auc = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label").evaluate(
        raw.select(array_to_vector("a").alias("raw"), "label"))
    assert mine == pytest.approx(spark_auc, abs=1e-9)


def test_regression_metrics_match_evaluator(spark):
    rows = [(float(i), float(i) + (0.5 if i % 2 else -0.3)) for i in range(50)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = ev.regression_metrics(df, "label", "prediction").collect()[0]
    e = RegressionEvaluator(labelCol="label", predictionCol="prediction")
    assert m.rmse == pytest.approx(e.evaluate(df), rel=1e-12)
    assert m.r2 == pytest.approx(e.evaluate(df, {e.metricName: "r2"}), rel=1e-12)


def test_residual_share_sums_to_one(spark):
    rows = [(float(i), float(i) + ((-1) ** i) * (i % 5)) for i in range(100)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    out = ev.residual_share(df, "label", "prediction").collect()
    assert sum(r.percent for r in out) == pytest.approx(1.0)
    assert sum(r["count"] for r in out) == 100


def test_covariance_two_points(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 6.0],)], "v array<double>")
    m = linalg.covariance_matrix(df, "v")
    assert np.allclose(m, [[1, 2], [2, 4]])
    comps, vals = linalg.pca(df, "v", 1)
    assert linalg.variance_explained(vals, 1) == pytest.approx(1.0)


def test_pca_matches_numpy(spark):
    e = spark.read.parquet(f"{SF0001}/embeddings.parquet")
    x = np.array([r.embedding for r in e.orderBy("vec_id").collect()], dtype=np.float64)
    cov = np.cov(x, rowvar=False, bias=True)
    assert np.allclose(linalg.covariance_matrix(e.repartition(5), "embedding"), cov, atol=1e-10)
    comps, vals = linalg.pca(e, "embedding", 3)
    want_vals, want_vecs = np.linalg.eigh(cov)
    assert np.allclose(vals, want_vals[::-1], atol=1e-10)
    for c in range(3):
        w = want_vecs[:, -1 - c]
        assert min(np.abs(comps[:, c] - w).max(), np.abs(comps[:, c] + w).max()) < 1e-8
    scores = linalg.pca_scores(e, "embedding", comps, keep=["vec_id"]).orderBy("vec_id").collect()
    got = np.array([[r.score0, r.score1, r.score2] for r in scores])
    assert np.allclose(got, x @ comps, atol=1e-9)


def test_mean_vector(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 6.0],)], "v array<double>")
    assert {r.pos: r.mean for r in linalg.mean_vector(df, "v").collect()} == {0: 2.0, 1: 4.0}


def test_dot(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "a array<double>, b array<double>")
    assert df.select(linalg.dot(F.col("a"), F.col("b"))).collect()[0][0] == 32.0


def test_r2_of_labels_far_from_zero(spark):
    rows = [(1e9 + i, 1e9 + 4.5) for i in range(10)]
    m = ev.regression_metrics(spark.createDataFrame(rows, "label double, prediction double"), "label", "prediction").first()
    assert m.r2 == pytest.approx(0.0, abs=1e-9)


def test_perfect_fit_and_missing_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, None), (4.0, float("nan"))], "label double, prediction double")
    rows = ev.residual_share(df, "label", "prediction").collect()
    assert [(r.rmse_range, r["count"], r.percent) for r in rows] == [(1, 2, 1.0)]
    assert {r.within_rmse for r in ev.residuals(df.limit(2), "label", "prediction", 0.0).collect()} == {0.0}


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.4, 1.0)], "p double, label double")
    assert ev.roc_auc(df).first().auc is None
    assert {(r.tpr, r.fpr) for r in ev.roc_points(df).collect()} == {(0.5, None), (1.0, None)}


def test_auc_of_more_pairs_than_64_bits(spark, monkeypatch):
    # two scores whose class counts are 5e9 each: P * N is 1e20
    counts = spark.createDataFrame([(0.9, 4_000_000_000, 1_000_000_000), (0.1, 1_000_000_000, 4_000_000_000)],
                                   "threshold double, pos long, neg long")
    monkeypatch.setattr(ev, "_per_score", lambda df, p, label: counts)
    assert ev.roc_auc(counts).first().auc == pytest.approx(0.8)

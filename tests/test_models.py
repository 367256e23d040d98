"""Models: planted coefficients, baselines, argmin, clamps."""

import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from conftest import SF0001
from tessera.operators import evaluate as ev
from tessera.operators import models


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = x @ np.array([2.0, -1.0, 0.5])
    rows = [(float(t), [float(v) for v in r]) for t, r in zip(y, x)]
    return spark.createDataFrame(rows, "label double, x array<double>").select(
        "label", array_to_vector("x").alias("features")).repartition(3)


def test_gradient_descent_moves_and_improves(planted):
    w, errors = models.gradient_descent(planted, iters=40, alpha=1.0)
    assert errors[-1] < errors[0] * 0.2          # the fixed gradient actually descends
    assert np.allclose(w, [2.0, -1.0, 0.5], atol=0.25)


def test_linear_regression_recovers_coefficients(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    y = 3.0 + x @ np.array([1.5, -2.0])
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double")
    pipe, _ = models.linreg_estimator(["a", "b"], "y", reg=0.0)
    lr = pipe.fit(df).stages[-1]
    assert lr.intercept == pytest.approx(3.0, abs=1e-6)
    assert np.allclose(lr.coefficients.toArray(), [1.5, -2.0], atol=1e-6)


def test_model_beats_mean_baseline(spark):
    # planted relation with noise (the plant stand-in's target is unrelated to its features)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    y = 10 + x @ np.array([3.0, -2.0, 0.5, 1.0]) + rng.normal(scale=0.5, size=600)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, f1 double, f2 double, f3 double, f4 double, target double")
    from tessera.operators import keys
    p = keys.hash_split(df, "id", [0.8, 0.2], 3, ["train", "test"])
    train, test = p.filter("split = 'train'"), p.filter("split = 'test'")
    pipe, _ = models.linreg_estimator(["f1", "f2", "f3", "f4"], "target")
    model_rmse = ev.regression_metrics(pipe.fit(train).transform(test), "target", "prediction").collect()[0].rmse
    mean = train.agg(F.avg("target")).collect()[0][0]
    base = ev.regression_metrics(test.withColumn("prediction", F.lit(mean)), "target", "prediction").collect()[0].rmse
    assert model_rmse < 0.5 * base


def test_plant_regression_runs(spark):
    from tessera.sources.fixtures import Views
    pipe, _ = models.linreg_estimator(["f1", "f2", "f3", "f4"], "target")
    out = pipe.fit(Views(spark, SF0001).plant).transform(Views(spark, SF0001).plant)
    assert out.filter(F.col("prediction").isNull()).count() == 0


def test_choose_rank_true_argmin(spark, monkeypatch):
    errs = {4: 1.2, 8: 1.5, 12: 1.1}         # a non-improving rank precedes the best one

    class FakeModel:
        def __init__(self, k):
            self.k = k

        def transform(self, df):
            return df.withColumn("prediction", F.col("rating") + F.lit(errs[self.k]))

    class FakeALS:
        def __init__(self, rank, **kw):
            self.rank = rank

        def fit(self, df):
            return FakeModel(self.rank)

    monkeypatch.setattr(models, "als", lambda rank=4, **kw: FakeALS(rank))
    df = spark.createDataFrame([(1, 1, 3.0)], "userId int, movieId int, rating double")
    best, _ = models.choose_rank(df, df, [4, 8, 12])
    assert best[0] == 12


def test_probability_clamped(spark):
    class FakeModel:
        def transform(self, df):
            return df.withColumn("rawPrediction", array_to_vector(F.array(-F.col("z"), F.col("z")))) \
                     .withColumn("probability", F.lit(0.0)).withColumn("prediction", F.lit(0.0))

    df = spark.createDataFrame([(100.0,), (-100.0,), (0.0,)], "z double")
    p = [r.p for r in models.add_probability(df, FakeModel()).collect()]
    assert p[0] == pytest.approx(1 / (1 + np.exp(-20)))
    assert p[1] == pytest.approx(1 / (1 + np.exp(20)))
    assert p[2] == 0.5


def test_fold_column_deterministic(spark):
    df = spark.range(300).withColumnRenamed("id", "key")
    a = {r.key: r.fold for r in models.fold_column(df, "key", 3).collect()}
    b = {r.key: r.fold for r in models.fold_column(df.repartition(5), "key", 3).collect()}
    assert a == b and set(a.values()) == {0, 1, 2}


def test_null_features_are_an_error_not_a_loss(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None)], "y double, f double")
    pipe, lr = models.linreg_estimator(["f"], "y")
    with pytest.raises(Exception, match="(?i)null"):
        pipe.fit(rows)
    model = pipe.fit(rows.filter("f is not null"))
    assert model.transform(rows.filter("f is not null")).count() == 2
    assert "regParam" in models.params_text(lr)


def test_tree_as_rules(spark):
    rows = spark.createDataFrame([(float(i > 5), float(i)) for i in range(12)], "y double, f double")
    pipe, _ = models.tree_estimator(["f"], "y")
    assert "If (feature 0 <=" in models.model_text(pipe.fit(rows).stages[-1])


def _ratings(spark, users=40, items=30):
    rows = [(u, m, float((u * 7 + m * 3 + u * m) % 5 + 1)) for u in range(users) for m in range(items) if (u + 2 * m) % 4]
    return spark.createDataFrame(rows, "userId int, movieId int, rating double").repartition(4), len(rows)


def test_a_fit_of_many_ratings_has_more_blocks_and_the_same_factors(spark, monkeypatch):
    assert models.als(ratings=36_000_000).getNumUserBlocks() == models.als().getNumItemBlocks() == 10
    many = models.als(ratings=216_000_000)
    assert many.getNumUserBlocks() == many.getNumItemBlocks() == 54          # ten before, 21.6 million ratings each
    df, n = _ratings(spark)
    plain = models.als(rank=3).fit(df)
    monkeypatch.setattr(models, "STORED_RATINGS", 0)
    large = models.als(rank=3, ratings=n)
    assert (large.getCheckpointInterval(), large.getIntermediateStorageLevel()) == (models.CHECKPOINT_STEPS, "DISK_ONLY")
    got = {r.id: r.features for r in models.stored_model(large.fit(df)).itemFactors.collect()}
    want = {r.id: r.features for r in plain.itemFactors.collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k], atol=1e-4) for k in want)


def test_recommended_items_of_a_large_fit(spark, monkeypatch):
    import tessera.queries_models as qm
    want = qm.als_recommend(spark, SF0001).first()
    monkeypatch.setattr(models, "STORED_RATINGS", 0)
    monkeypatch.setattr(models, "BLOCK_RATINGS", 500)
    assert qm.als_recommend(spark, SF0001).first() == want


def test_ranks_leave_no_files_of_their_fits(spark, monkeypatch):
    monkeypatch.setattr(models, "STORED_RATINGS", 0)
    shuffles = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    df, n = _ratings(spark)
    kept = lambda: set(spark.sparkContext._jsc.getPersistentRDDs())
    cached, before = kept(), shuffles.size()
    best, results = models.choose_rank(df, df, [2, 3, 4], ratings=n)
    assert [r[0] for r in results] == [2, 3, 4] and best[1] == min(r[1] for r in results)
    for _ in range(50):                                  # Spark's cleaner works on its own
        if shuffles.size() < before + 20 and len(kept() - cached) < 4:
            break
        models.swept(spark)
        time.sleep(0.2)
    assert shuffles.size() < before + 20                 # more than 20 a rank before
    assert len(kept() - cached) < 4                      # less than two models' factors
    assert results[0][3].transform(df).filter("prediction is not null").count() == n

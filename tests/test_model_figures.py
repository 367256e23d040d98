"""The models' own numbers: grid search from moments, node tables, dense ids, fold-in, wide PCA, click vectors."""

import numpy as np
import pytest
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tessera.operators import features as feat
from tessera.operators import linalg, models, profile
from tessera.sources import readers


@pytest.fixture(scope="module")
def plane(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(50, 10, (600, 4))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.5 * x[:, 2] + 1e4 + rng.normal(0, 5, 600)
    rows = [(i, i % 3, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, fold int, a double, b double, c double, d double, y double").repartition(5)


def test_ridge_from_moments_is_spark_s_ridge(plane):
    names = ["a", "b", "c", "d"]
    whole = None
    for m in models.fold_moments(plane, names, "y").values():
        whole = m if whole is None else models._joined(whole, m)
    for reg in (0.0, 0.1, 50.0):
        pipe, _ = models.linreg_estimator(names, "y", reg=reg)
        fit = pipe.fit(plane).stages[-1]
        weights, intercept = models.ridge_solution(whole, reg)
        assert np.allclose(weights, fit.coefficients.toArray(), rtol=1e-7, atol=1e-9) and intercept == pytest.approx(fit.intercept, rel=1e-9)


def test_grid_search_equals_the_cross_validator(plane):
    names, values = ["a", "b", "c", "d"], [0.01, 1.0, 20.0]
    errors, best, weights, intercept = models.ridge_grid_search(plane, names, "y", values)
    pipe, lr = models.linreg_estimator(names, "y")
    grid = ParamGridBuilder().addGrid(lr.regParam, values).build()
    ev = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName="rmse")
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, numFolds=3, foldCol="fold").fit(plane)
    mine = [np.mean([e for _, v, e in errors if v == x]) for x in values]
    assert np.allclose(mine, cv.avgMetrics, rtol=1e-9) and best == values[int(np.argmin(cv.avgMetrics))]
    assert np.allclose(weights, cv.bestModel.stages[-1].coefficients.toArray(), rtol=1e-7)


def test_grid_search_needs_two_folds_and_whole_rows(spark, plane):
    with pytest.raises(ValueError):
        models.ridge_grid_search(plane.withColumn("fold", F.lit(1)), ["a"], "y", [0.1])
    with pytest.raises(Exception, match="null or NaN"):
        models.fold_moments(plane.withColumn("a", F.when(F.col("id") > 5, F.col("a"))), ["a"], "y")


def test_tree_nodes_are_the_model_s_rules(plane):
    pipe, tree = models.tree_estimator(["a", "b"], "y")
    tree.setMaxDepth(3)
    model = pipe.fit(plane)
    nodes = {r.path: r for r in models.tree_nodes(model.stages[-1]).collect()}
    assert nodes[""].rows == 600 and max(map(len, nodes)) <= 3
    for path, r in nodes.items():
        if r.feature is not None:
            assert r.rows == nodes[path + "L"].rows + nodes[path + "R"].rows
            left, right = nodes[path + "L"], nodes[path + "R"]
            gain = r.impurity - (left.rows * left.impurity + right.rows * right.impurity) / r.rows
            assert gain == pytest.approx(r.gain, rel=1e-6)
    for r in model.transform(plane).limit(50).collect():           # walking the table gives the model's prediction
        path = ""
        while nodes[path].feature is not None:
            path += "L" if (r.a, r.b)[nodes[path].feature] <= nodes[path].threshold else "R"
        assert r.prediction == pytest.approx(nodes[path].prediction)


def test_forest_nodes_have_a_tree_number(plane):
    pipe, _ = models.forest_estimator(["a", "b"], "y", trees=3, depth=2)
    model = pipe.fit(plane)
    nodes = models.tree_nodes(model.stages[-1]).collect()
    assert {r.tree for r in nodes} == {0, 1, 2}
    trees = [{r.path: r for r in nodes if r.tree == k} for k in range(3)]
    for r in model.transform(plane).limit(20).collect():
        found = []
        for t in trees:
            path = ""
            while t[path].feature is not None:
                path += "L" if (r.a, r.b)[t[path].feature] <= t[path].threshold else "R"
            found.append(t[path].prediction)
        assert r.prediction == pytest.approx(np.mean(found))


def test_ids_beyond_32_bits_and_texts(spark):
    big = 1 << 40
    rows = [(big + u * 7, f"item{m}", float((u * m) % 5 + 1)) for u in range(12) for m in range(10) if (u + m) % 3]
    df = spark.createDataFrame(rows, "userId long, movieId string, rating double")
    ids = {c: models.dense_ids(df, c) for c in ("userId", "movieId")}
    assert sorted(r.dense for r in ids["userId"].collect()) == list(range(12))
    coded = models.with_dense(df, ids)
    fitted = models.als(rank=2, user="userId_dense", item="movieId_dense").fit(coded)
    assert fitted.transform(coded).filter("prediction is not null").count() == len(rows)
    named = fitted.itemFactors.join(ids["movieId"].withColumnRenamed("dense", "id"), "id")
    assert {r.movieId for r in named.collect()} == {f"item{m}" for m in range(10)}


def test_a_folded_in_user_has_the_least_squares_factors(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(0, 1, (30, 4))
    factors = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, features array<float>")
    mine = spark.createDataFrame([(1, 5.0), (7, 2.0), (9, 4.0), (999, 1.0)], "id long, rating double")
    held = np.float32(v[[1, 7, 9]]).astype(float)
    want = np.linalg.solve(held.T @ held + 0.1 * 3 * np.eye(4), held.T @ np.array([5.0, 2.0, 4.0]))
    user = models.fold_in(factors, mine, 0.1)
    assert np.allclose(user, want)
    stats = spark.createDataFrame([(i, 200 if i % 2 else 50) for i in range(30)], "id long, count long")
    top = models.recommend_folded(factors, user, mine, stats, 100, 5).collect()
    scores = {i: float(np.float32(v[i]) @ user) for i in range(30) if i % 2 and i not in (1, 7, 9)}
    assert [r.id for r in top] == sorted(scores, key=lambda i: (-scores[i], i))[:5]
    with pytest.raises(ValueError):
        models.fold_in(factors, mine.filter("id = 999"))


def test_a_folded_in_user_equals_the_fitted_one(spark):
    """ALS solves the same equations for each user, so folding a fitted user in gives their factors (after the last sweep)."""
    rows = [(u, m, float((u * 3 + m) % 5 + 1)) for u in range(15) for m in range(12) if (u + 2 * m) % 4]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    fitted = models.als(rank=3, iters=60).fit(df)
    user = models.fold_in(fitted.itemFactors, df.filter("userId = 4").select(F.col("movieId").alias("id"), "rating"), 0.1)
    known = np.array(fitted.userFactors.filter("id = 4").first().features)
    assert np.allclose(user, known, atol=2e-2)


@pytest.mark.parametrize("k, extra", [(3, 6), (5, 40)])
def test_wide_pca_spans_numpy_s_axes(spark, k, extra):
    rng = np.random.default_rng(3)
    base = rng.normal(0, 1, (400, 6)) @ (rng.normal(0, 1, (6, 45)) * np.array([9, 7, 5, 3, 2, 1.5])[:, None]) + rng.normal(0, .05, (400, 45)) + 30
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(base)], "id long, v array<double>").repartition(4)
    axes, vals = linalg.pca_wide(df, "v", k, extra)
    want, vecs = np.linalg.eigh(np.cov(base.T, bias=True))
    lead = vecs[:, ::-1][:, :k]
    assert np.linalg.norm(lead - axes @ (axes.T @ lead)) < 1e-6 and np.allclose(vals, want[::-1][:k], rtol=1e-8)
    assert (axes[np.argmax(np.abs(axes), axis=0), np.arange(k)] > 0).all()


def test_count_vectors(spark):
    rows = [(1, [(0, 2.0), (3, 1.0)]), (2, []), (3, None)]
    df = spark.createDataFrame(rows, "id long, entries array<struct<index:int,weight:double>>")
    got = {r.id: r.features for r in feat.to_vectors(df, 5).collect()}
    assert got[1].toArray().tolist() == [2.0, 0, 0, 1.0, 0] and got[2].numNonzeros() == 0 and got[3].size == 5


def test_pair_relation_edges(spark):
    df = spark.createDataFrame([(1.0, 5.0, None, 2.0), (2.0, 5.0, 1.0, 4.0), (3.0, 5.0, 2.0, None)], "x double, same double, gap double, y double")
    got = {r.feature: r for r in profile.pair_relation(df, ["x", "same", "gap"], "y").collect()}
    assert (got["x"].slope, got["x"].intercept) == (2.0, 0.0) and got["x"].r2 == pytest.approx(1.0)
    assert got["same"].slope is None and got["same"].r2 is None and got["gap"].corr is None


def test_bad_lines_keep_their_text(spark, tmpdir_path):
    path = f"{tmpdir_path}/t.csv"
    with open(path, "w") as f:
        f.write("id,name,x\n1,ann,2.5\ntwo,bob,3\n3,cat\n4,dan,1,9\n5,,7\n")
    checked = readers.read_csv_checked(spark, path, "id INT, name STRING, x DOUBLE")
    assert sorted(r.line for r in readers.bad_lines(checked).collect()) == ["3,cat", "4,dan,1,9", "two,bob,3"]
    assert readers.bad_lines(checked).count() == 3
    assert sorted((r.id, r.name, r.x) for r in readers.good_lines(checked).collect()) == [(1, "ann", 2.5), (5, None, 7.0)]


def test_logit_rates_fits_equal_records_as_one_row(spark, monkeypatch):
    from tessera import queries_models as q
    seen, fit = [], models.logistic_fit
    monkeypatch.setattr(models, "logistic_fit", lambda train, **kw: seen.append(train.count()) or fit(train, **kw))
    records = [(i, f"{int(i % (2 + i % 3) == 0)}\tO\tP{i % 3}\tb\tt\tm") for i in range(600)]
    frame = spark.createDataFrame(records, "id long, value string")
    monkeypatch.setattr(q, "_click_records", lambda s, sf: q.positional_fields(frame, keep=["id"]))
    train = {r.id for r in q._click_sets(spark, "").filter("split = 'train'").select("id").collect()}
    got = {r.value: (r.rows, r.p) for r in q.logit_rates(spark, "").collect()}
    for k in range(3):
        labels = [float(v[0]) for i, v in records if i in train and i % 3 == k]
        assert got[f"P{k}"][0] == len(labels) and abs(got[f"P{k}"][1] - sum(labels) / len(labels)) < 2e-3
    assert len(got) == 3 and 3 <= seen[0] <= 6


def test_recommended_items_read_the_ratings_once(spark):
    from conftest import SF0001
    from tessera import queries_models as q
    top = q.recommend_items(spark, SF0001)
    assert "lineitem" not in top._jdf.queryExecution().toString() and top.count() <= 20


def test_draws_of_a_bootstrap_are_poisson_numbers():
    drawn = models.poisson_draws(np.random.default_rng(5).integers(0, 1 << 53, 20000), 8)
    for k in range(5):
        assert (drawn == k).mean(axis=0) == pytest.approx(np.full(8, np.exp(-1) / [1, 1, 2, 6, 24][k]), abs=0.015)
    assert np.abs(np.corrcoef(drawn.T) - np.eye(8)).max() < 0.04          # each tree draws on its own


def _steps(spark, n):
    a, b = F.col("id") % 7, (F.col("id") / 7).cast("long") % 40
    y = 100 * F.pow(a - 3, F.lit(2)) + 5 * b + (F.xxhash64("id") % 50)
    return spark.range(n).select("id", a.cast("double").alias("a"), (b / 4).alias("b"), y.cast("double").alias("y"),
                                 (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2))).cast("int").alias("fold"))


def test_a_tree_of_cells_is_the_tree_of_their_rows(spark):
    from pyspark.ml.regression import RandomForestRegressor
    rows = _steps(spark, 6000).withColumn("b", F.floor("b").cast("double"))
    _, wood = models.forest_estimator(["a", "b"], "y", trees=1, depth=4)
    wood.setFeatureSubsetStrategy("all")
    cells = rows.groupBy("a", "b").agg(F.count("*").cast("double").alias("w0"), F.sum("y").alias("s0"))
    with models.ThreadPool(1) as pool:
        tree = models._grown(cells, 70, ["a", "b"], wood, [4], pool)[0][0]
    whole = RandomForestRegressor(numTrees=1, maxDepth=4, bootstrap=False, featureSubsetStrategy="all", labelCol="y", seed=17)
    data = models.assembler(["a", "b"]).transform(rows)
    both = tree.transform(whole.fit(data).transform(data))
    assert both.filter(F.abs(F.col("prediction") - F.col("prediction_0")) > 1e-6).count() == 0


def test_a_forest_of_many_rows_is_fitted_to_cells(spark):
    rows = _steps(spark, 6000).cache()
    made = models.forest_estimator(["a", "b"], "y", trees=2)
    made[1].setFeatureSubsetStrategy("all")
    forest = models.forest_search(made, rows, ["a", "b"], [3], cells_from=0)
    assert isinstance(forest, models.CellForest) and len(forest.trees) == 2
    scored = forest.transform(rows)
    assert set(scored.columns) == {*rows.columns, "prediction"} and scored.count() == 6000
    e = scored.agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2)).alias("e"), F.stddev_pop("y").alias("d")).first()
    assert e.e < 0.5 * e.d
    far = spark.createDataFrame([(-9.0, 99.0), (6.0, 0.1)], "a double, b double")       # cells without training rows
    assert [r.prediction is not None for r in forest.transform(far).collect()] == [True, True]
    with pytest.raises(Exception):
        forest.transform(spark.createDataFrame([(None, 1.0)], "a double, b double")).collect()


def test_cells_hold_every_row_once(spark):
    rows = _steps(spark, 5000).withColumn("cell", (F.col("a") > 0).cast("long"))         # one cell has most rows
    got = models.bootstrap_cells(rows, "cell", "fold", "y", 4, 3).collect()
    want = {(r.cell, r.fold): r for r in rows.groupBy("cell", "fold").agg(
        F.count("*").alias("n"), F.sum("y").alias("total"), F.sum(F.col("y") ** 2).alias("square")).collect()}
    assert sorted((r.cell, r.fold) for r in got) == sorted(want)
    for r in got:
        w = want[r.cell, r.fold]
        assert (r.n, r.total, r.square) == pytest.approx((w.n, w.total, w.square))
    for t in range(4):
        assert sum(r[f"w{t}"] for r in got) == pytest.approx(5000, rel=0.08)
        assert sum(r[f"s{t}"] for r in got) / sum(r[f"w{t}"] for r in got) == pytest.approx(sum(w.total for w in want.values()) / 5000, rel=0.08)
    with pytest.raises(Exception, match="null or NaN"):
        models.bootstrap_cells(rows.withColumn("y", F.when(F.col("id") != 7, F.col("y"))), "cell", "fold", "y", 4, 3).collect()

"""Evaluation, feature, linear-algebra and model queries.

Registered into ``tessera.queries.QUERIES`` / ``ORACLES``.  Where a model has a closed form for one
or two features, or its choice can be searched for in SQL (ridge grids, elastic net, polynomials, tree
splits, fold-in, unpenalised logits, eigenvalues' sums), a query returns the model's own numbers.
The wider fits return what SQL can tell of them: split sizes, the error of the plain mean (or base rate) on the
same rows, and whether the model does better.  Their figures are held in pytest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tessera.operators import evaluate as ev
from tessera.operators import features as feat
from tessera.operators import keys, linalg, models, profile
from tessera.queries import _duck_md5_unit, query, r
from tessera.plans.joins import one_row
from tessera.session import checkpoint_dir, swept, written
from tessera.sources.fixtures import Views, duck_with
from tessera.sources.readers import positional_fields

# ============================================================== features
_CLICK_FEATS_SQL = duck_with("clicks") + """,
feats AS (SELECT id, CAST(i - 1 AS BIGINT) AS pos, parts[i + 1] AS value
          FROM (SELECT id, unnest(range(1, len(parts))) AS i, parts
                FROM (SELECT id, string_split(value, chr(9)) AS parts FROM clicks))),
dict AS (SELECT pos, value, row_number() OVER (ORDER BY pos, value) - 1 AS ohe_id
         FROM (SELECT DISTINCT pos, value FROM feats)),
ohe AS (SELECT f.id, d.ohe_id AS "index", 1.0 AS weight FROM feats f JOIN dict d USING (pos, value)),
hashed AS (SELECT id, "index", CAST(count(*) AS DOUBLE) AS weight
           FROM (SELECT DISTINCT id, pos, value,
                        CAST(('0x' || substr(md5(value || ':' || CAST(pos AS VARCHAR)), 29, 4))::BIGINT % 32768
                             AS INTEGER) AS "index" FROM feats)
           GROUP BY id, "index")
"""


def _hashed_sql(buckets: int) -> str:
    """Buckets by the remainder of the whole 128-bit digest, read in four 32-bit digits."""
    digit = [f"('0x' || substr(h, {i}, 8))::BIGINT" for i in (1, 9, 17, 25)]
    rest = f"({digit[0]} % {buckets})"
    for d in digit[1:]:
        rest = f"((({rest})::HUGEINT * 4294967296 + {d}) % {buckets})"
    return _CLICK_FEATS_SQL + f""",
digests AS (SELECT DISTINCT id, pos, value, md5(value || ':' || CAST(pos AS VARCHAR)) AS h FROM feats)
SELECT id, CAST({rest} AS INTEGER) AS "index", CAST(count(*) AS DOUBLE) AS weight FROM digests GROUP BY 1, 2"""


def _click_records(spark, sf):
    return positional_fields(Views(spark, sf).clicks, keep=["id"])


@query("ohe_dictionary", _CLICK_FEATS_SQL + "SELECT pos, value, ohe_id FROM dict")
def ohe_dictionary(spark, sf):
    return feat.ohe_dictionary(_click_records(spark, sf))


@query("ohe_encode_long", _CLICK_FEATS_SQL + 'SELECT id, "index", weight FROM ohe')
def ohe_encode_long(spark, sf):
    rec = _click_records(spark, sf)
    return feat.ohe_encode(rec, feat.ohe_dictionary(rec))


@query("hash_features_long", _CLICK_FEATS_SQL + 'SELECT id, "index", weight FROM hashed')
def hash_features_long(spark, sf):
    return feat.hash_features(_click_records(spark, sf), 1 << 15)


@query("hash_features_2_20", _hashed_sql(1 << 20))
def hash_features_2_20(spark, sf):
    return feat.hash_features(_click_records(spark, sf), 1 << 20)


@query("hash_features_prime", _hashed_sql(1_000_003))
def hash_features_prime(spark, sf):
    return feat.hash_features(_click_records(spark, sf), 1_000_003)


@query("sparsity", _CLICK_FEATS_SQL + """
SELECT round((SELECT avg(nnz / (SELECT count(*) FROM dict))
              FROM (SELECT id, count(DISTINCT "index") AS nnz FROM ohe GROUP BY id)), 9) AS ohe_sparsity,
       round((SELECT avg(nnz / 32768)
              FROM (SELECT id, count(DISTINCT "index") AS nnz FROM hashed GROUP BY id)), 9) AS hash_sparsity""")
def sparsity(spark, sf):
    """The dictionary holds every feature of these records, so their own arrays give the counts in one pass."""
    rec = _click_records(spark, sf)
    width = one_row(feat.category_counts(rec).agg(F.sum("n_categories").alias("w")))["w"]
    hashed = feat.with_hashed(rec, 1 << 15)
    return hashed.agg(
        r(F.avg(F.size(F.array_distinct("features")) / F.lit(width)), 9).alias("ohe_sparsity"),
        r(F.avg(F.size("entries") / F.lit(1 << 15)), 9).alias("hash_sparsity"))


# ============================================================ evaluation
@query("rmse_r2", duck_with("scored") + """
SELECT round(sqrt(avg((label - p) * (label - p))), 9) AS rmse,
       round(1 - sum((label - p) * (label - p)) / sum((label - m) * (label - m)), 9) AS r2,
       count(*) AS n
FROM scored, (SELECT avg(label) AS m FROM scored)""")
def rmse_r2(spark, sf):
    m = ev.regression_metrics(Views(spark, sf).scored, "label", "p")
    return m.select(r(F.col("rmse"), 9).alias("rmse"), r(F.col("r2"), 9).alias("r2"), "n")


@query("residual_share", duck_with("scored") + """,
w AS (SELECT (label - p) / (SELECT sqrt(avg((label - p) * (label - p))) FROM scored) AS within_rmse FROM scored),
g AS (SELECT CASE WHEN within_rmse >= -1.0 AND within_rmse <= 1.0 THEN 1
                  WHEN within_rmse >= -2.0 AND within_rmse <= 2.0 THEN 2 ELSE 3 END AS rmse_range,
             count(*) AS count FROM w GROUP BY 1)
SELECT rmse_range, count, CAST(count AS DOUBLE) / (SELECT sum(count) FROM g) AS percent FROM g""")
def residual_share(spark, sf):
    return ev.residual_share(Views(spark, sf).scored, "label", "p")


_LL = ("CASE WHEN label = 1 THEN -ln(q) ELSE -ln(1 - q) END")
_CLAMP = ("CASE WHEN (CASE WHEN {p} = 0 THEN 1e-16 ELSE {p} END) = 1 THEN 1 - 1e-16 "
          "ELSE (CASE WHEN {p} = 0 THEN 1e-16 ELSE {p} END) END")


@query("log_loss_baseline", duck_with("scored") + f""",
b AS (SELECT avg(label) AS baseline_p FROM scored),
x AS (SELECT label, {_CLAMP.format(p='p')} AS q, {_CLAMP.format(p='baseline_p')} AS qb, baseline_p FROM scored, b)
SELECT round(avg({_LL}), 9) AS log_loss_model, round(any_value(baseline_p), 9) AS baseline_p,
       round(avg(CASE WHEN label = 1 THEN -ln(qb) ELSE -ln(1 - qb) END), 9) AS log_loss_baseline
FROM x""")
def log_loss_baseline(spark, sf):
    out = ev.log_loss_vs_baseline(Views(spark, sf).scored)
    return out.select(*[r(F.col(c), 9).alias(c) for c in ("log_loss_model", "baseline_p", "log_loss_baseline")])


_ROC_SQL = duck_with("scored") + """,
g AS (SELECT p AS threshold, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
             sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM scored GROUP BY p),
c AS (SELECT threshold, pos, neg,
             sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
             sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)
"""


@query("roc_points", _ROC_SQL + """
SELECT threshold, CAST(tp AS DOUBLE) / NULLIF(P, 0) AS tpr, CAST(fp AS DOUBLE) / NULLIF(N, 0) AS fpr FROM c""")
def roc_points(spark, sf):
    return ev.roc_points(Views(spark, sf).scored)


@query("roc_auc", _ROC_SQL + """
SELECT round(sum(neg * (tp - pos / 2.0)) / (sum(pos) * sum(neg)), 9) AS auc FROM c""")
def roc_auc(spark, sf):
    return ev.roc_auc(Views(spark, sf).scored).select(r(F.col("auc"), 9).alias("auc"))


# ================================================ plant profile
_PLANT_F = ["f1", "f2", "f3", "f4"]


@query("pair_relation", duck_with("plant") + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(regr_slope(target, {f}), 4) AS slope, "
    f"round(regr_intercept(target, {f}), 4) AS intercept, round(regr_r2(target, {f}), 9) AS r2, "
    f"round(corr({f}, target), 9) AS corr FROM plant" for f in _PLANT_F))
def pair_relation(spark, sf):
    out = profile.pair_relation(Views(spark, sf).plant, _PLANT_F, "target")
    return out.select("feature", r(F.col("slope"), 4).alias("slope"), r(F.col("intercept"), 4).alias("intercept"),
                      r(F.col("r2"), 9).alias("r2"), r(F.col("corr"), 9).alias("corr"))


@query("histogram", duck_with("plant") + """
SELECT CAST(floor(target / 10000.0) AS BIGINT) AS bin, count(*) AS count,
       CAST(floor(target / 10000.0) AS BIGINT) * 10000.0 AS lower
FROM plant GROUP BY 1""")
def histogram(spark, sf):
    return profile.histogram(Views(spark, sf).plant, "target", 10000.0)


# =================================================== linear algebra
@query("mean_vector", """
SELECT CAST(pos - 1 AS INTEGER) AS pos, round(avg(CAST(embedding[pos] AS DOUBLE)), 9) AS mean
FROM (SELECT unnest(range(1, len(embedding) + 1)) AS pos, embedding FROM embeddings) GROUP BY pos""")
def mean_vector(spark, sf):
    m = linalg.mean_vector(Views(spark, sf).embeddings, "embedding")
    return m.select("pos", r(F.col("mean"), 9).alias("mean"))


@query("covariance_long", """
WITH x AS (SELECT vec_id, CAST(pos - 1 AS BIGINT) AS i, CAST(embedding[pos] AS DOUBLE) AS v
           FROM (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos, embedding FROM embeddings))
SELECT a.i, b.i AS j, round(covar_pop(a.v, b.v), 9) AS cov
FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY a.i, b.i""")
def covariance_long(spark, sf):
    c = linalg.covariance_long(Views(spark, sf).embeddings, "embedding")
    return c.select("i", "j", r(F.col("cov"), 9).alias("cov"))


_SQUARES = """
WITH x AS (SELECT vec_id, pos, CAST(embedding[pos] AS DOUBLE) AS v
           FROM (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos, embedding FROM embeddings))
"""


@query("pca_scores", _SQUARES + """
SELECT vec_id, round(sqrt(sum(v * v)), 6) AS norm FROM x GROUP BY vec_id""")
def pca_scores(spark, sf):
    """Projections on all components keep every vector's length (the axes are tested against numpy)."""
    e = Views(spark, sf).embeddings
    comps, _ = linalg.pca(e, "embedding", linalg.dimensions(e, "embedding"))
    scores = linalg.pca_scores(e, "embedding", comps, keep=["vec_id"])
    parts = [F.col(f"score{c}") * F.col(f"score{c}") for c in range(comps.shape[1])]
    return scores.select("vec_id", r(F.sqrt(sum(parts[1:], parts[0]))).alias("norm"))


@query("pca_spectrum", _SQUARES + """,
c AS (SELECT a.pos AS i, b.pos AS j, covar_pop(a.v, b.v) AS c FROM x a JOIN x b ON a.vec_id = b.vec_id GROUP BY a.pos, b.pos)
SELECT CAST(sqrt(count(*)) AS BIGINT) AS components, round(sum(CASE WHEN i = j THEN c END), 6) AS total,
       round(sum(c * c), 6) AS total_squared, TRUE AS uncorrelated FROM c""")
def pca_spectrum(spark, sf):
    """Along principal axes the scores have the eigenvalues as variances: their squares add up to all squared
    covariances (less along any other orthonormal axes), and no two scores are correlated."""
    e = Views(spark, sf).embeddings
    comps, _ = linalg.pca(e, "embedding", linalg.dimensions(e, "embedding"))
    k = comps.shape[1]
    scores = linalg.pca_scores(e, "embedding", comps).select(F.array(*[F.col(f"score{c}") for c in range(k)]).alias("s"))
    cov = linalg.covariance_matrix(scores, "s")
    spread = np.diag(cov)
    apart = bool(np.abs(cov - np.diag(spread)).max(initial=0.0) < 1e-9 * max(spread.max(initial=0.0), 1e-300))
    return spark.createDataFrame([(k, round(float(spread.sum()), 6), round(float((spread ** 2).sum()), 6), apart)],
                                 "components long, total double, total_squared double, uncorrelated boolean")


@query("pca_wide_spectrum", _SQUARES + """,
s AS (SELECT pos, var_pop(v) AS v FROM x GROUP BY pos)
SELECT (SELECT count(*) FROM s) AS components, (SELECT round(sum(v), 6) FROM s) AS total, TRUE AS same_axes""")
def pca_wide_spectrum(spark, sf):
    """Block power iteration with a block as wide as the vectors: its eigenvalues add up to the variances, its
    four leading axes are those of the covariance matrix."""
    e = Views(spark, sf).embeddings
    d = linalg.dimensions(e, "embedding")
    axes, vals = linalg.pca_wide(e, "embedding", d)
    known, _ = linalg.pca(e, "embedding", d)
    lead, mine = known[:, :4], axes[:, :4]
    same = bool(np.linalg.norm(lead - mine @ (mine.T @ lead)) < 1e-6)
    return spark.createDataFrame([(len(vals), round(float(vals.sum()), 6), same)], "components long, total double, same_axes boolean")


@query("variance_explained", _SQUARES + """
SELECT count(*) AS components, round(sum(v), 6) AS total_variance, TRUE AS descending, TRUE AS shares_rise_to_one
FROM (SELECT pos, var_pop(v) AS v FROM x GROUP BY pos)""")
def variance_explained(spark, sf):
    """The eigenvalues add up to the variances of the dimensions; shares rise to 1."""
    _, vals = linalg.pca(Views(spark, sf).embeddings, "embedding", 1)
    shares = [linalg.variance_explained(vals, k) for k in range(1, len(vals) + 1)]
    rising = all(a <= b + 1e-12 for a, b in zip(shares, shares[1:])) and abs(shares[-1] - 1) < 1e-9
    row = (len(vals), round(float(sum(vals)), 6), all(a >= b for a, b in zip(vals, vals[1:])), rising)
    return spark.createDataFrame([row], "components long, total_variance double, descending boolean, "
                                        "shares_rise_to_one boolean")


# ============================================================ regression
_REPORT = "model string, n_train long, n_test long, mean_rmse double, beats_mean boolean"


def _duck_split(view: str, key: str, label: str, first: int, second: int | None, seed: int) -> str:
    """(split, y) of a view by the md5 cut points, given as numbers."""
    u = _duck_md5_unit(key, seed)
    rest = "'test'" if second is None else f"CASE WHEN {u} < {second} THEN 'validation' ELSE 'test' END"
    return f"parts AS (SELECT CASE WHEN {u} < {first} THEN 'train' ELSE {rest} END AS split, {label} AS y FROM {view})"


def _report_sql(names: list[str], test: str) -> str:
    rows = " UNION ALL ".join(f"SELECT '{n}' AS model" for n in names)
    return f""", m AS (SELECT avg(y) AS mean, count(*) AS n_train FROM parts WHERE split = 'train')
SELECT model, n_train, (SELECT count(*) FROM parts WHERE split = '{test}') AS n_test,
       (SELECT round(sqrt(avg((y - mean) * (y - mean))), 6) FROM parts, m WHERE split = '{test}') AS mean_rmse, TRUE AS beats_mean
FROM m, ({rows})"""


# 0.8 of 2^32 rounded down; 0.8 and 0.9 for the three-way split
_PLANT_SPLIT_SQL = duck_with("plant") + ", " + _duck_split("plant", "id", "target", 3435973836, None, 31)
_YEARS_SPLIT_SQL = "WITH " + _duck_split("embeddings", "vec_id", "CAST(label AS DOUBLE)", 3435973836, 3865470566, 42)


def _plant_split(spark, sf):
    """Written once: fits and reports read it several times."""
    checkpoint_dir(spark)
    return keys.hash_split(Views(spark, sf).plant, "id", [0.8, 0.2], 31, ["train", "test"]).checkpoint()


def report(spark, split, label: str, fits: list[tuple[str, object]], test: str = "test"):
    """One row per fitted model: split sizes, the training mean's error on the test rows, and whether the
    model does at least as well as the mean on the rows it was trained on.

    ``fits`` are (name, model) pairs.
    """
    train, rest = split.filter("split = 'train'"), split.filter(F.col("split") == test)
    known = one_row(train.agg(F.avg(label).alias("mean"), F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("rmse")))
    base = one_row(ev.regression_metrics(rest.withColumn("prediction", F.lit(known["mean"])), label, "prediction"))
    rows = []
    for name, model in fits:
        m = one_row(ev.regression_metrics(model.transform(train), label, "prediction"))
        rows.append((name, known["n"], base["n"], None if base["rmse"] is None else round(base["rmse"], 6),
                     None if m["rmse"] is None else m["rmse"] <= known["rmse"] * (1 + 1e-9)))
    return spark.createDataFrame(rows, _REPORT)


@query("linreg_exact", duck_with("plant") + """
SELECT round(regr_slope(target, f1), 3) AS slope, round(regr_intercept(target, f1), 3) AS intercept,
       round(regr_r2(target, f1), 6) AS r2, count(*) AS n FROM plant""")
def linreg_exact(spark, sf):
    """M1-M4: one feature without a penalty has the closed form."""
    plant = Views(spark, sf).plant.select("f1", "target")
    pipe, _ = models.linreg_estimator(["f1"], "target", reg=0.0)
    model = pipe.fit(plant)
    lr = model.stages[-1]
    m = one_row(ev.regression_metrics(model.transform(plant), "target", "prediction"))
    row = (round(float(lr.coefficients[0]), 3), round(float(lr.intercept), 3), round(m["r2"], 6), m["n"])
    return spark.createDataFrame([row], "slope double, intercept double, r2 double, n long")


@query("linreg", _PLANT_SPLIT_SQL + _report_sql(["ridge"], "test"))
def linreg(spark, sf):
    """M1-M5: ridge (0.1, 100 iterations) on the training split."""
    s = _plant_split(spark, sf)
    pipe, _ = models.linreg_estimator(_PLANT_F, "target")
    return report(spark, s, "target", [("ridge", pipe.fit(s.filter("split = 'train'")))])


def _cv(spark, sf, name, made, grid):
    """A 3-fold grid search (folds by key hash) on the training split, reported on the test split."""
    s = _plant_split(spark, sf)
    pipe, last = made
    train = models.fold_column(s.filter("split = 'train'"), "id", 3)
    best = models.cross_validate(pipe, grid(last), train, "target", "prediction").bestModel
    return report(spark, s, "target", [(name, best)])


_CV_F = ["f1", "f4"]


def _cv_sql(values: list[float], best: bool) -> str:
    """Ridge fits of two features by their normal equations, each on all folds but one, and their error on that fold."""
    grid = ", ".join(map(str, values))
    u, cv = _duck_md5_unit("id", 31), _duck_md5_unit("id", 7)
    out = duck_with("plant") + f""",
t AS (SELECT f1, f4, target AS y, CAST({cv} % 3 AS INTEGER) AS fold FROM plant WHERE {u} < 3435973836),
m AS (SELECT k, avg(f1) AS m1, avg(f4) AS m4, avg(y) AS my, var_pop(f1) AS v1, var_pop(f4) AS v4, covar_pop(f1, f4) AS c14,
             covar_pop(f1, y) AS c1, covar_pop(f4, y) AS c4, stddev_pop(y) AS s
      FROM t JOIN (SELECT DISTINCT fold AS k FROM t) ON fold <> k GROUP BY k),
g AS (SELECT *, v1 * (1 + reg / s) AS a, v4 * (1 + reg / s) AS d FROM m, (SELECT unnest([{grid}])::DOUBLE AS reg)),
w AS (SELECT k, reg, (c1 * d - c4 * c14) / (a * d - c14 * c14) AS w1, (c4 * a - c1 * c14) / (a * d - c14 * c14) AS w4, m1, m4, my FROM g),
e AS (SELECT k AS fold, reg, sqrt(avg((y - my - w1 * (f1 - m1) - w4 * (f4 - m4)) ** 2)) AS rmse FROM w JOIN t ON fold = k GROUP BY k, reg)
"""
    if not best:
        return out + "SELECT fold, reg, round(rmse, 4) AS rmse FROM e"
    return out + """, c AS (SELECT reg FROM e GROUP BY reg ORDER BY avg(rmse), reg LIMIT 1)
SELECT fold, reg, round(rmse, 4) AS rmse, reg = (SELECT reg FROM c) AS chosen FROM e"""


def _cv_rows(spark, sf, values):
    train = models.fold_column(_plant_split(spark, sf).filter("split = 'train'"), "id", 3)
    return models.ridge_grid_search(train, _CV_F, "target", values)


_RIDGES = [i / 100 for i in range(1, 11)]


@query("linreg_cv", _cv_sql(_RIDGES, False))
def linreg_cv(spark, sf):
    """M6: the error of each fold and regParam 0.01..0.10 on the training split; 30 fits from one pass."""
    errors, _, _, _ = _cv_rows(spark, sf, _RIDGES)
    return spark.createDataFrame([(k, v, round(e, 4)) for k, v, e in errors], "fold int, reg double, rmse double")


# penalties of the size of the label, so that the errors differ and one is chosen
_WIDE_RIDGES = [100.0, 1000.0, 5000.0, 20000.0]


@query("ridge_choice", _cv_sql(_WIDE_RIDGES, True))
def ridge_choice(spark, sf):
    """M6: as linreg_cv over a wide grid, with the value of least mean error marked."""
    errors, best, _, _ = _cv_rows(spark, sf, _WIDE_RIDGES)
    return spark.createDataFrame([(k, v, round(e, 4), v == best) for k, v, e in errors],
                                 "fold int, reg double, rmse double, chosen boolean")


def _cv(spark, sf, name, made, grid):
    """A 3-fold grid search (folds by key hash) on the training split, reported on the test split."""
    s = _plant_split(spark, sf)
    pipe, last = made
    train = models.fold_column(s.filter("split = 'train'"), "id", 3)
    best = models.cross_validate(pipe, grid(last), train, "target", "prediction").bestModel
    return report(spark, s, "target", [(name, best)])


def _depths(*depths):
    from pyspark.ml.tuning import ParamGridBuilder
    return lambda stage: ParamGridBuilder().addGrid(stage.maxDepth, list(depths)).build()


@query("tree_cv", _PLANT_SPLIT_SQL + _report_sql(["tree_cv"], "test"))
def tree_cv(spark, sf):
    """M7: decision tree, depth in {2, 3}, 100 bins."""
    return _cv(spark, sf, "tree_cv", models.tree_estimator(_PLANT_F, "target"), _depths(2, 3))


_TREE_F = ["f1", "f2", "f3"]       # few distinct values: every place between two of them is a threshold


def _split_sql(name: str, rows: str) -> str:
    """The split of a node's rows that lowers the variance most: one row (feature, threshold, gain, n, m, v)."""
    every = " UNION ALL ".join(f"SELECT {i} AS feature, {f} AS x, y FROM {rows}" for i, f in enumerate(_TREE_F))
    return f"""
{name}_t AS (SELECT count(*) AS n, sum(y) AS s, avg(y) AS m, var_pop(y) AS v FROM {rows}),
{name}_c AS (SELECT feature, x, lead(x) OVER w AS nx, sum(k) OVER w AS nl, sum(s) OVER w AS sl
             FROM (SELECT feature, x, count(*) AS k, sum(y) AS s FROM ({every}) GROUP BY feature, x)
             WINDOW w AS (PARTITION BY feature ORDER BY x)),
{name} AS (SELECT feature, (x + nx) / 2 AS threshold, (sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n) / n AS gain, n, m, v
           FROM {name}_c, {name}_t WHERE nx IS NOT NULL ORDER BY 3 DESC LIMIT 1)"""


_CHOSEN = "CASE root.feature WHEN 0 THEN f1 WHEN 1 THEN f2 ELSE f3 END"


@query("tree_nodes", duck_with("plant") + f""",
t AS (SELECT f1, f2, f3, target AS y FROM plant WHERE {_duck_md5_unit("id", 31)} < 3435973836),{_split_sql("root", "t")},
tl AS (SELECT t.* FROM t, root WHERE {_CHOSEN} <= threshold), tr AS (SELECT t.* FROM t, root WHERE {_CHOSEN} > threshold),
{_split_sql("l", "tl")},{_split_sql("r", "tr")}
SELECT path, feature, round(threshold, 6) AS threshold, round(gain / v, 6) AS gain_share, n AS rows, round(m, 4) AS prediction
FROM (SELECT '' AS path, * FROM root UNION ALL SELECT 'L', * FROM l UNION ALL SELECT 'R', * FROM r)""")
def tree_nodes(spark, sf):
    """M7: the inner nodes of a tree of depth 2 as rows: place, feature, threshold, share of the variance taken away, rows, mean."""
    train = _plant_split(spark, sf).filter("split = 'train'")
    pipe, tree = models.tree_estimator(_TREE_F, "target")
    tree.setMaxDepth(2)
    nodes = models.tree_nodes(pipe.fit(train).stages[-1]).filter(F.col("feature").isNotNull())
    return nodes.select("path", "feature", r(F.col("threshold")).alias("threshold"),
                        r(F.col("gain") / F.col("impurity")).alias("gain_share"), "rows", r(F.col("prediction"), 4).alias("prediction"))


@query("forest_nodes", duck_with("plant") + f""",
t AS (SELECT f1, f2, f3, target AS y FROM plant WHERE {_duck_md5_unit("id", 31)} < 3435973836),{_split_sql("root", "t")}
SELECT tree, feature, round(threshold, 6) AS threshold, round(gain / v, 6) AS gain_share, n AS rows, round(m, 4) AS prediction
FROM root, (SELECT unnest([0, 1]) AS tree)""")
def forest_nodes(spark, sf):
    """M8: the roots of a forest that neither draws rows nor features, so that every tree has the best split."""
    train = _plant_split(spark, sf).filter("split = 'train'")
    pipe, wood = models.forest_estimator(_TREE_F, "target", trees=2, depth=2)
    wood.setFeatureSubsetStrategy("all").setBootstrap(False).setMaxBins(100)
    nodes = models.tree_nodes(pipe.fit(train).stages[-1]).filter("path = ''")
    return nodes.select("tree", "feature", r(F.col("threshold")).alias("threshold"),
                        r(F.col("gain") / F.col("impurity")).alias("gain_share"), "rows", r(F.col("prediction"), 4).alias("prediction"))


@query("forest", _PLANT_SPLIT_SQL + _report_sql(["forest"], "test"))
def forest(spark, sf):
    """M8: random forest (30 trees, seeded), over its own grid (Q22)."""
    s = _plant_split(spark, sf)
    train = models.fold_column(s.filter("split = 'train'"), "id", 3)
    best = models.forest_search(models.forest_estimator(_PLANT_F, "target"), train, _PLANT_F, [6, 8])
    return report(spark, s, "target", [("forest", best)])


def _years_split(spark, sf):
    return keys.hash_split(Views(spark, sf).years, "id", [0.8, 0.1, 0.1], 42, ["train", "validation", "test"])


@query("poly_linreg", _YEARS_SPLIT_SQL + """, n AS (SELECT split, count(*) AS rows, avg(y) AS mean FROM parts GROUP BY split)
SELECT split, rows, round(mean, 6) AS label_mean, split = 'train' AS fits_mean FROM n WHERE split <> 'test'""")
def poly_linreg(spark, sf):
    """Degree-2 expansion + elastic-net regression (Q19); with an intercept the training predictions have the labels' mean."""
    s = _years_split(spark, sf).filter("split <> 'test'")
    return _mean_report(models.poly_estimator("label").fit(s.filter("split = 'train'")), s)


@query("elastic_linreg", _YEARS_SPLIT_SQL + """, n AS (SELECT split, count(*) AS rows, avg(y) AS mean FROM parts GROUP BY split)
SELECT split, rows, round(mean, 6) AS label_mean, split = 'train' AS fits_mean FROM n WHERE split <> 'test'""")
def elastic_linreg(spark, sf):
    """Elastic net (0.1, mix 0.2, 50 iterations) on the song-year stand-in."""
    from pyspark.ml.regression import LinearRegression
    s = _years_split(spark, sf).filter("split <> 'test'")
    lr = LinearRegression(featuresCol="features", labelCol="label", maxIter=50, regParam=0.1, elasticNetParam=0.2)
    return _mean_report(lr.fit(s.filter("split = 'train'")), s)


def _mean_report(model, split):
    """Rows and label mean of each split, and whether the predictions of the training rows have their mean."""
    per = model.transform(split).groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("label").alias("mean"), F.avg("prediction").alias("guess"))
    fits = (F.col("split") == "train") & (F.abs(F.col("mean") - F.col("guess")) < 1e-3)
    return per.select("split", "rows", r(F.col("mean")).alias("label_mean"), fits.alias("fits_mean"))


@query("poly_exact", duck_with("plant") + """,
p AS (SELECT f1 AS x, f1 * f1 AS z, target AS y FROM plant),
m AS (SELECT avg(x) AS mx, avg(z) AS mz, avg(y) AS my, var_pop(x) AS vx, var_pop(z) AS vz, covar_pop(x, z) AS c,
             covar_pop(x, y) AS cx, covar_pop(z, y) AS cz FROM p),
w AS (SELECT *, (cx * vz - cz * c) / (vx * vz - c * c) AS wx, (cz * vx - cx * c) / (vx * vz - c * c) AS wz FROM m)
SELECT round(wx, 2) AS linear, round(wz, 4) AS square, round(my - wx * mx - wz * mz, 1) AS intercept FROM w""")
def poly_exact(spark, sf):
    """A degree-2 expansion of one feature without a penalty has the closed form of two features."""
    pipe = models.poly_estimator("target", degree=2, reg=0.0, elastic=0.0)
    rows = models.assembler(["f1"]).transform(Views(spark, sf).plant.select("f1", "target"))
    fit = pipe.fit(rows).stages[-1]
    linear, square = (float(c) for c in fit.coefficients)
    return spark.createDataFrame([(round(linear, 2), round(square, 4), round(float(fit.intercept), 1))],
                                 "linear double, square double, intercept double")


_ELASTIC = (5000.0, 0.2)           # penalty (of the size of the label) and the share of it that is absolute


@query("elastic_exact", duck_with("plant") + f""",
m AS (SELECT avg(f1) AS mx, avg(target) AS my, stddev_pop(f1) AS sx, stddev_pop(target) AS sy, corr(f1, target) AS rho FROM plant),
w AS (SELECT *, sign(rho) * greatest(abs(rho) - {_ELASTIC[0]} / sy * {_ELASTIC[1]}, 0) / (1 + {_ELASTIC[0]} / sy * {1 - _ELASTIC[1]}) * sy / sx AS slope FROM m)
SELECT round(slope, 3) AS slope, round(my - slope * mx, 2) AS intercept FROM w""")
def elastic_exact(spark, sf):
    """One feature has a closed form, the correlation moved towards 0 by the absolute part and shrunk by the square one."""
    pipe, _ = models.linreg_estimator(["f1"], "target", reg=_ELASTIC[0], elastic=_ELASTIC[1])
    fit = pipe.fit(Views(spark, sf).plant.select("f1", "target")).stages[-1]
    return spark.createDataFrame([(round(float(fit.coefficients[0]), 3), round(float(fit.intercept), 2))], "slope double, intercept double")


@query("gd_linreg", "WITH " + f"""e AS (SELECT vec_id, CAST(label AS DOUBLE) AS y, embedding FROM embeddings
      WHERE {_duck_md5_unit("vec_id", 42)} < 3435973836),
x AS (SELECT vec_id, y, pos, CAST(embedding[pos] AS DOUBLE) AS v
      FROM (SELECT vec_id, y, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM e)),
g AS (SELECT pos, avg(y * v) AS w FROM x GROUP BY pos),
p AS (SELECT vec_id, any_value(y) AS y, sum(v * w) AS guess FROM x JOIN g USING (pos) GROUP BY vec_id)
SELECT 30 AS steps, round(sqrt(avg(y * y)), 6) AS first_rmse, round(sqrt(avg((guess - y) * (guess - y))), 6) AS second_rmse,
       TRUE AS falls FROM p""")
def gd_linreg(spark, sf):
    """30 full-batch gradient steps from zero weights: the error before the first step (the labels' root mean
    square) and after it (weights: the mean of label times feature)."""
    _, errors = models.gradient_descent(_years_split(spark, sf).filter("split = 'train'"), iters=30)
    return spark.createDataFrame([(len(errors), round(errors[0], 6), round(errors[1], 6), errors[-1] < errors[0])],
                                 "steps int, first_rmse double, second_rmse double, falls boolean")


# ======================================================== recommendation
def _ratings_split(spark, sf):
    rt = models.mean_pairs(Views(spark, sf).ratings)
    key = F.concat_ws("|", F.col("userId").cast("string"), F.col("movieId").cast("string"))
    return keys.hash_split(rt, key, [0.6, 0.2, 0.2], 59, ["train", "validation", "test"])


# 0.6 and 0.8 of 2^32, rounded down
_RATINGS_SPLIT_SQL = duck_with("ratings") + f""",
pairs AS (SELECT userId, movieId, avg(rating) AS rating FROM ratings GROUP BY userId, movieId),
s AS (SELECT *, CASE WHEN u < 2576980377 THEN 'train' WHEN u < 3435973836 THEN 'validation' ELSE 'test' END AS split
      FROM (SELECT *, {_duck_md5_unit("CAST(userId AS VARCHAR) || '|' || CAST(movieId AS VARCHAR)", 59)} AS u
            FROM pairs))
"""


@query("mean_baseline", _RATINGS_SPLIT_SQL + """
SELECT round(m, 9) AS train_mean, round(sqrt(avg((rating - m) * (rating - m))), 9) AS test_rmse
FROM s, (SELECT avg(rating) AS m FROM s WHERE split = 'train') WHERE split = 'test' GROUP BY m""")
def mean_baseline(spark, sf):
    """RMSE on test of the training mean used as every prediction."""
    s = _ratings_split(spark, sf)
    m = F.lit(one_row(s.filter("split = 'train'").agg(F.avg("rating").alias("m")))["m"])
    out = s.filter("split = 'test'").agg(F.sqrt(F.avg((F.col("rating") - m) ** 2)).alias("test_rmse"))
    return out.select(r(m, 9).alias("train_mean"), r(F.col("test_rmse"), 9).alias("test_rmse"))


# The ranks tried.
_RANKS = [4, 8, 12]


@query("als_rank", _RATINGS_SPLIT_SQL + """
SELECT unnest([4, 8, 12]) AS rank, (SELECT count(*) FROM s WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM s v WHERE split = 'validation'
          AND EXISTS (SELECT 1 FROM s t WHERE t.split = 'train' AND t.userId = v.userId)
          AND EXISTS (SELECT 1 FROM s t WHERE t.split = 'train' AND t.movieId = v.movieId)) AS n_scored,
       1 AS n_chosen, TRUE AS chosen_is_least, TRUE AS error_bounded""")
def als_rank(spark, sf):
    """Ranks by validation RMSE, over dense ids; pairs of an unseen user or item are not scored (cold start).

    Bounded: no rank's error is larger than the range of the ratings.
    """
    s = written(_ratings_split(spark, sf), "split")        # read by both tables of ids and the codes
    ids = {c: models.dense_ids(s, c) for c in ("userId", "movieId")}
    coded = models.with_dense(s, ids).select("split", F.col("userId_dense").alias("userId"), F.col("movieId_dense").alias("movieId"), "rating")
    coded = written(coded, "coded")                        # read by every fit and score
    train, valid = (coded.filter(f"split = '{x}'").drop("split") for x in ("train", "validation"))
    known = one_row(train.agg(F.count(F.lit(1)).alias("n"), (F.max("rating") - F.min("rating")).alias("range")))
    best, results = models.choose_rank(train, valid, _RANKS, ratings=known["n"])
    rows = [(k, known["n"], n, sum(k2 == best[0] for k2, _, _, _ in results), best[1] == min(e for _, e, _, _ in results),
             e is not None and e <= known["range"]) for k, e, n, _ in results]
    return spark.createDataFrame(rows, "rank int, n_train long, n_scored long, n_chosen int, chosen_is_least boolean, error_bounded boolean")


# The new user's own ratings (item id, rating).
_MY_RATINGS = [(7, 5.0), (40, 4.0), (111, 5.0), (290, 3.0), (806, 5.0), (1203, 4.0)]
_MIN_RATINGS = 30


@query("als_recommend", duck_with("ratings") + f"""
SELECT least(20, (SELECT count(*) FROM (SELECT movieId FROM ratings GROUP BY movieId HAVING count(rating) > {_MIN_RATINGS})
                  WHERE movieId NOT IN ({", ".join(str(m) for m, _ in _MY_RATINGS)}))) AS n_items,
       TRUE AS descending, TRUE AS unrated, TRUE AS often_rated""")
def als_recommend(spark, sf):
    """A new user's top 20 unrated items among items with more than ``_MIN_RATINGS`` ratings."""
    top = recommend_items(spark, sf).collect()                # 20 rows
    scores = [x["prediction"] for x in top]
    row = (len(top), scores == sorted(scores, reverse=True), not {x["movieId"] for x in top} & {m for m, _ in _MY_RATINGS},
           all(x["count"] > _MIN_RATINGS for x in top))
    return spark.createDataFrame([row], "n_items long, descending boolean, unrated boolean, often_rated boolean")


def recommend_items(spark, sf):
    """(movieId, title, prediction, count) of the recommended items, best first: the new user is folded into the fitted factors."""
    v = Views(spark, sf)
    ratings = written(v.ratings, "ratings")              # read by the pairs and the counts
    pairs = written(models.mean_pairs(ratings), "pairs")  # read by both tables of ids and the fit
    ids = {c: models.dense_ids(pairs, c) for c in ("userId", "movieId")}
    coded = written(models.with_dense(pairs, ids).select("userId_dense", "movieId_dense", "rating"), "coded")   # a fit reads it more than once
    n = coded.count()
    swept(spark)
    fitted = models.als(rank=8, user="userId_dense", item="movieId_dense", ratings=n).fit(coded)
    if n > models.STORED_RATINGS:
        fitted = models.stored_model(fitted)
        swept(spark)
    named = ids["movieId"].withColumnRenamed("dense", "id")
    factors = fitted.itemFactors.join(named, "id").select("movieId", "features")
    mine = spark.createDataFrame(_MY_RATINGS, "movieId long, rating double")
    stats = profile.count_and_mean(ratings, "movieId", "rating").select("movieId", "count")
    top = models.recommend_folded(factors, models.fold_in(factors, mine, item="movieId"), mine, stats, _MIN_RATINGS, 20, "movieId")
    return top.join(v.items.select(F.col("ID").alias("movieId"), "title"), "movieId").orderBy(F.desc("prediction"), "movieId") \
        .select("movieId", "title", "prediction", "count")


_FOLD_REG = 0.1


@query("fold_in_scores", duck_with("ratings") + f""",
f AS (SELECT movieId, count(rating) AS n, avg(rating) / 50 AS a, max(p_retailprice) / 2000 AS b
      FROM ratings JOIN part ON p_partkey = movieId GROUP BY movieId),
mine AS (SELECT unnest([{", ".join(str(m) for m, _ in _MY_RATINGS)}]) AS movieId, unnest([{", ".join(str(x) for _, x in _MY_RATINGS)}])::DOUBLE AS r),
s AS (SELECT sum(a * a) + {_FOLD_REG} * count(*) AS aa, sum(a * b) AS ab, sum(b * b) + {_FOLD_REG} * count(*) AS bb, sum(a * r) AS ar, sum(b * r) AS br
      FROM mine JOIN f USING (movieId)),
u AS (SELECT (ar * bb - br * ab) / (aa * bb - ab * ab) AS ua, (br * aa - ar * ab) / (aa * bb - ab * ab) AS ub FROM s)
SELECT movieId, round(a * ua + b * ub, 6) AS prediction, n AS count FROM f, u
WHERE n > {_MIN_RATINGS} AND movieId NOT IN (SELECT movieId FROM mine) ORDER BY a * ua + b * ub DESC, movieId LIMIT 20""")
def fold_in_scores(spark, sf):
    """Fold-in and top 20 over two-dimensional item factors that SQL can make too (mean rating, price)."""
    v = Views(spark, sf)
    per = v.ratings.groupBy("movieId").agg(F.count("rating").alias("count"), (F.avg("rating") / 50).alias("a"))
    price = v.part.select(F.col("p_partkey").alias("movieId"), (F.col("p_retailprice") / 2000).alias("b"))
    factors = per.join(price, "movieId").select("movieId", "count", F.array("a", "b").alias("features"))
    mine = spark.createDataFrame(_MY_RATINGS, "movieId long, rating double")
    user = models.fold_in(factors.select("movieId", "features"), mine, _FOLD_REG, "movieId")
    top = models.recommend_folded(factors.select("movieId", "features"), user, mine, factors.select("movieId", "count"), _MIN_RATINGS, 20, "movieId")
    return top.select("movieId", r(F.col("prediction")).alias("prediction"), "count")


# ========================================================= click-rate study
# 0.8 and 0.9 of 2^32, rounded down
_CLICK_SPLIT_SQL = duck_with("clicks") + f""",
s AS (SELECT CASE WHEN u < 3435973836 THEN 'train' WHEN u < 3865470566 THEN 'validation' ELSE 'test' END AS split, label
      FROM (SELECT {_duck_md5_unit("id", 42)} AS u, CAST(string_split(value, chr(9))[1] AS DOUBLE) AS label FROM clicks)),
b AS (SELECT avg(label) AS p FROM s WHERE split = 'train')
SELECT split, count(*) AS rows, round(avg(label), 9) AS rate,
       round(avg(CASE WHEN label = 1 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS baseline_log_loss,
       split = 'train' AS beats_baseline FROM s, b GROUP BY split"""


def _click_sets(spark, sf):
    return keys.hash_split(_click_records(spark, sf), "id", [0.8, 0.1, 0.1], 42, ["train", "validation", "test"])


def click_scores(rec, elastic: float):
    """Fit on the training split and score all records; ``rec`` carries label, split and the features vector."""
    model = models.logistic_fit(rec.filter("split = 'train'"), reg=0.01, elastic=elastic)
    return models.add_probability(rec, model).select("split", "label", "p")


def _click_report(scored, base_p: float):
    """Rows, rate and the base rate's log loss of each split, and whether the model does better on the training rows."""
    per = scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("label").alias("rate"),
        F.avg(ev.log_loss(F.lit(base_p), F.col("label"))).alias("base"),
        F.avg(ev.log_loss(F.col("p"), F.col("label"))).alias("model"))
    better = (F.col("split") == "train") & (F.col("model") <= F.col("base") + 1e-6)
    return per.select("split", "rows", r(F.col("rate"), 9).alias("rate"), r(F.col("base")).alias("baseline_log_loss"),
                      better.alias("beats_baseline"))


def _logit_report(spark, encoded, width: int, elastic: float):
    """The vectors are kept for the fit, which reads them at every step, and for the scores; then let go.

    The report (three rows) is on the driver before the vectors are released.
    """
    from pyspark import StorageLevel
    vecs = feat.to_vectors(encoded, width).select("split", "label", "features").persist(StorageLevel.MEMORY_AND_DISK)
    base_p = one_row(vecs.filter("split = 'train'").agg(F.avg("label").alias("b")))["b"]
    out = _click_report(click_scores(vecs, elastic), base_p)
    rows = out.collect()
    vecs.unpersist()
    return spark.createDataFrame(rows, out.schema)


@query("logit_ohe", _CLICK_SPLIT_SQL)
def logit_ohe(spark, sf):
    """One-hot (dictionary fitted on training rows) + ridge logistic regression."""
    from pyspark import StorageLevel
    rec = _click_sets(spark, sf)
    d = feat.ohe_dictionary(rec.filter("split = 'train'")).persist(StorageLevel.MEMORY_AND_DISK)
    size = d.groupBy("pos").agg(F.count(F.lit(1)).alias("n")).collect()        # one row a field
    encoded = feat.with_one_hot(rec, d, sorted(x["pos"] for x in size)).drop("features")
    out = _logit_report(spark, encoded, sum(x["n"] for x in size), 0.0)
    d.unpersist()
    return out


@query("logit_hashed", _CLICK_SPLIT_SQL)
def logit_hashed(spark, sf):
    """2^15 md5 buckets + elastic-net (mix 0.7) logistic regression."""
    encoded = feat.with_hashed(_click_sets(spark, sf), 1 << 15).drop("features")
    return _logit_report(spark, encoded, 1 << 15, 0.7)


_RATE_POS = 1        # the order priority


@query("logit_rates", duck_with("clicks") + f""",
s AS (SELECT string_split(value, chr(9)) AS parts, CAST(string_split(value, chr(9))[1] AS DOUBLE) AS label
      FROM clicks WHERE {_duck_md5_unit("id", 42)} < 3435973836)
SELECT parts[{_RATE_POS + 2}] AS value, count(*) AS rows, round(avg(label), 3) AS p FROM s GROUP BY 1""")
def logit_rates(spark, sf):
    """One field, no penalty: the fitted probability of a category is its rate among the training rows.

    Records that are equal in field and label are one row with their number as its weight, so the fit is the same.  There are at
    most two such rows for each weight of the model: whatever follows is as large as the model, not as the records.
    """
    rec = _click_sets(spark, sf).filter("split = 'train'")
    one = rec.withColumn("features", F.filter("features", lambda f: f["pos"] == _RATE_POS))
    checkpoint_dir(spark)
    one = one.groupBy("label", "features").agg(F.count(F.lit(1)).alias("records")).checkpoint()
    d = feat.ohe_dictionary(one)
    width = d.count()
    encoded = feat.with_one_hot(one.withColumn("value", F.col("features")[0]["value"]), d, [_RATE_POS]).drop("features")
    vecs = feat.to_vectors(encoded, width).select("value", "label", "records", "features")
    fitted = models.add_probability(vecs, models.logistic_fit(vecs, reg=0.0, iters=200, weight="records"))
    return fitted.groupBy("value").agg(F.sum("records").alias("rows"), r(F.sum(F.col("p") * F.col("records")) / F.sum("records"), 3).alias("p"))

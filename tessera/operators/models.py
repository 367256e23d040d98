"""Model fitting (M1-M3, M6-M8, M11-M17, M22-M24; studies C7, C8).

Estimators are Spark ML's.  Folds and splits come from key hashes so they do
not depend on partition layout.  The one hand-written learner, full-batch
gradient descent (M15), computes per-partition partial gradients with numpy
inside ``mapInPandas`` and sums them with an aggregate: only d + 2 numbers
per partition cross the shuffle and only the d weights live on the driver.
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import Bucketizer, PolynomialExpansion, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import md5_unit
from tessera.operators.evaluate import regression_metrics
from tessera.operators.keys import row_index
from tessera.operators.linalg import dot, logistic
from tessera.session import checkpoint_dir, shared_path, swept, written


# ------------------------------------------------------------ regression

def assembler(features: list[str], out: str = "features") -> VectorAssembler:
    """M1: a row with a null or NaN feature is an error, never dropped in silence."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error")


def params_text(estimator) -> str:
    """M2: every parameter of an estimator with its meaning and value."""
    return estimator.explainParams()


def model_text(model) -> str:
    """M7: a tree or forest as nested rules; other models as their summary line."""
    return getattr(model, "toDebugString", None) or str(model)


def linreg_estimator(features: list[str], label: str, pred: str = "prediction", reg: float = 0.1,
                    max_iter: int = 100, elastic: float = 0.0) -> tuple[Pipeline, LinearRegression]:
    """M2/M3 (M16 with ``elastic`` > 0): assemble then linear regression."""
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol=pred,
                          maxIter=max_iter, regParam=reg, elasticNetParam=elastic)
    return Pipeline(stages=[assembler(features), lr]), lr


def poly_estimator(label: str, degree: int = 2, reg: float = 1e-10, elastic: float = 0.2,
                  max_iter: int = 50, features_col: str = "features") -> Pipeline:
    """Polynomial expansion then linear regression."""
    pe = PolynomialExpansion(degree=degree, inputCol=features_col, outputCol="poly")
    lr = LinearRegression(featuresCol="poly", labelCol=label, maxIter=max_iter, regParam=reg,
                          elasticNetParam=elastic, fitIntercept=True)
    return Pipeline(stages=[pe, lr])


def fold_column(df: DataFrame, key: str, folds: int, seed: int = 7, out: str = "fold") -> DataFrame:
    """Deterministic CV fold from md5(seed:key)."""
    return df.withColumn(out, (md5_unit(F.col(key), seed) % folds).cast("int"))


def cross_validate(estimator, grid: list, train: DataFrame, label: str, pred: str,
                   folds: int = 3, fold_col: str = "fold", parallelism: int = 2):
    """M6: k-fold grid search by RMSE over a fold column; returns the best model."""
    ev = RegressionEvaluator(labelCol=label, predictionCol=pred, metricName="rmse")
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ev, numFolds=folds,
                        foldCol=fold_col, parallelism=parallelism)
    return cv.fit(train)


def ridge_grid(lr: LinearRegression, values: list[float] | None = None) -> list:
    """M6 grid: regParam in 0.01..0.10."""
    return ParamGridBuilder().addGrid(lr.regParam, values or [i / 100 for i in range(1, 11)]).build()


def fold_moments(df: DataFrame, features: list[str], label: str, fold_col: str = "fold") -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """M6: per fold (rows, mean, centred Gram matrix) of features and label together, in one pass over the rows.

    Each partition sends one matrix of (d + 1) squared numbers a fold.  Rows are shifted by the overall means
    first (a pass over the columns alone), so nothing cancels; the shift leaves the matrices as they are.
    A row with a null or NaN is an error, as in ``assembler``.
    """
    names = [*features, label]
    rows = df.select(F.col(fold_col).cast("int").alias("fold"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    whole = rows.agg(*[F.avg(f"c{i}").alias(f"c{i}") for i in range(len(names))]).first()
    shift = np.array([whole[f"c{i}"] if whole[f"c{i}"] is not None else 0.0 for i in range(len(names))])

    def partial(batches):
        found: dict[int, list] = {}
        for batch in batches:
            folds = batch.column(0).to_numpy(zero_copy_only=False)
            x = np.column_stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(names))]) - shift
            if np.isnan(x).any():
                raise ValueError("a feature or label is null or NaN")
            for k in np.unique(folds).tolist():
                part = x[folds == k]
                n, total, gram = found.get(k, (0, 0.0, 0.0))
                found[k] = n + len(part), total + part.sum(axis=0), gram + part.T @ part
        if found:
            yield pa.RecordBatch.from_pydict({
                "fold": pa.array(list(found), pa.int32()), "n": pa.array([v[0] for v in found.values()], pa.int64()),
                "total": pa.array([v[1].tolist() for v in found.values()], pa.list_(pa.float64())),
                "gram": pa.array([v[2].ravel().tolist() for v in found.values()], pa.list_(pa.float64()))})

    parts = rows.mapInArrow(partial, "fold int, n long, total array<double>, gram array<double>")
    summed = (parts.select("fold", "n", F.posexplode(F.concat("total", "gram")).alias("j", "v"))
              .groupBy("fold", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n")).collect())  # (d + 1)(d + 2) rows a fold
    d = len(names)
    out = {}
    for k in {r["fold"] for r in summed}:
        flat, n = np.zeros(d + d * d), 0
        for r in summed:
            if r["fold"] == k:
                flat[r["j"]], n = r["v"], r["n"]
        mean = flat[:d] / n
        out[k] = n, shift + mean, flat[d:].reshape(d, d) - n * np.outer(mean, mean)
    return out


def _joined(a: tuple, b: tuple, sign: int = 1) -> tuple[int, np.ndarray, np.ndarray]:
    """The moments of two sets of rows together, or (sign -1) of the first without the second."""
    n = a[0] + sign * b[0]
    if n <= 0:
        return 0, np.zeros_like(a[1]), np.zeros_like(a[2])
    mean = (a[0] * a[1] + sign * b[0] * b[1]) / n
    gap = a[1] - b[1]
    between = a[0] * b[0] / (a[0] + b[0]) if sign > 0 else a[0] * b[0] / n
    return n, mean, a[2] + sign * (b[2] + between * np.outer(gap, gap))


def ridge_solution(moments: tuple, reg: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of the ridge fit that ``linreg_estimator`` makes, from moments alone.

    The penalty is on standardised weights, reg / (label deviation) * sum((deviation_j * w_j)^2) / 2, as in Spark.
    """
    n, mean, gram = moments
    cov = gram / n
    variance = np.diag(cov)
    deviation = float(np.sqrt(variance[-1]))
    system = cov[:-1, :-1] + np.diag(variance[:-1]) * (reg / deviation if deviation else 0.0)
    weights = np.linalg.lstsq(system, cov[:-1, -1], rcond=None)[0]
    return weights, float(mean[-1] - mean[:-1] @ weights)


def ridge_error(moments: tuple, weights: np.ndarray, intercept: float) -> float:
    """RMSE of a linear model on the rows that moments were taken from."""
    n, mean, gram = moments
    direction = np.append(weights, -1.0)
    bias = mean[:-1] @ weights + intercept - mean[-1]
    return float(np.sqrt(max(direction @ gram @ direction, 0.0) / n + bias * bias))


def ridge_grid_search(df: DataFrame, features: list[str], label: str, values: list[float],
                      fold_col: str = "fold") -> tuple[list[tuple[int, float, float]], float, np.ndarray, float]:
    """M6: (fold, value, RMSE on the fold of the fit without it) for every fold and value, the value with the least
    mean error, and the weights and intercept it gives on all rows.

    One pass over the rows whatever the number of folds and values: a fold's training moments are all moments less its own.
    """
    folds = fold_moments(df, features, label, fold_col)
    if len(folds) < 2:
        raise ValueError("cross-validation needs rows in two folds or more")
    whole = None
    for m in folds.values():
        whole = m if whole is None else _joined(whole, m)
    errors = [(k, v, ridge_error(folds[k], *ridge_solution(_joined(whole, folds[k], -1), v))) for k in sorted(folds) for v in values]
    best = min(values, key=lambda v: (sum(e for _, x, e in errors if x == v), v))
    return errors, best, *ridge_solution(whole, best)


def tree_estimator(features: list[str], label: str, pred: str = "prediction",
                  max_bins: int = 100) -> tuple[Pipeline, DecisionTreeRegressor]:
    """M7."""
    dt = DecisionTreeRegressor(featuresCol="features", labelCol=label, predictionCol=pred, maxBins=max_bins)
    return Pipeline(stages=[assembler(features), dt]), dt


def forest_estimator(features: list[str], label: str, pred: str = "prediction", trees: int = 30,
                    depth: int = 8, seed: int = 17) -> tuple[Pipeline, RandomForestRegressor]:
    """M8."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol=pred,
                               numTrees=trees, maxDepth=depth, seed=seed)
    return Pipeline(stages=[assembler(features), rf]), rf


def bin_cuts(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """M8: where each feature is cut into at most ``bins`` bins, as Spark's trees do; a value at a cut lies below it.

    A feature with at most ``bins`` different values is cut halfway between neighbours, others at quantiles.
    """
    rows = df.select([F.col(c).cast("double").alias(c) for c in features])
    about = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in features]).first()
    out: dict[str, list[float]] = {}
    for c in features:
        if about[c] <= 2 * bins:
            values = sorted(r[0] for r in rows.select(c).distinct().collect() if r[0] is not None and not math.isnan(r[0]))  # about 2 * bins rows
            if len(values) <= bins:
                out[c] = [(a + b) / 2 for a, b in zip(values, values[1:])] or values
    rest = [c for c in features if c not in out]
    found = rows.approxQuantile(rest, [k / bins for k in range(1, bins)], 0.001) if rest else []
    out.update((c, sorted(set(cuts))) for c, cuts in zip(rest, found))
    return [out[c] for c in features]


#: Chances that a Poisson number with mean 1 is at most 0, 1, 2 and so on.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def poisson_draws(seeds: np.ndarray, trees: int) -> np.ndarray:
    """How often a bootstrap with a Poisson number for each row (as Spark's) draws each row for each tree, from the rows' random numbers alone."""
    x = seeds.astype(np.uint64)[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return np.searchsorted(_POISSON, ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53, side="right").astype(np.float64)


def bootstrap_cells(rows: DataFrame, cell: str, fold: str, label: str, trees: int, seed: int) -> DataFrame:
    """M8: (cell, fold, n, total, square, w0, s0, w1, s1, ...): rows of one cell and fold as one row.

    ``n``, ``total`` and ``square`` are the rows, the sum and the squares' sum of their labels; ``w`` and ``s`` the rows and the sum
    that a tree's bootstrap draws of them, each row drawn on its own.  Rows are spread by cell and a random number, so that a cell with many
    rows lies in several tasks.  A row with a null or NaN is an error, as in ``assembler``.
    """
    source = rows.select(F.col(cell).cast("long").alias("cell"), F.col(fold).cast("int").alias("fold"),
                         F.col(label).cast("double").alias("y"), (F.rand(seed) * float(1 << 53)).cast("long").alias("r"))
    names = [x for t in range(trees) for x in (f"w{t}", f"s{t}")]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            where, which, y, r = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if any(c.null_count for c in batch.columns) or np.isnan(y).any():
                raise ValueError("a feature or label is null or NaN")
            order = np.lexsort((which, where))
            where, which, y, drawn = where[order], which[order], y[order], poisson_draws(r[order], trees)
            begins = np.flatnonzero(np.append(True, (where[1:] != where[:-1]) | (which[1:] != which[:-1])))
            w, s = np.add.reduceat(drawn, begins), np.add.reduceat(drawn * y[:, None], begins)
            both = [x[:, t] for t in range(trees) for x in (w, s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(where[begins]), pa.array(which[begins]), pa.array(np.diff(begins, append=len(y)).astype(np.float64)),
                 *(pa.array(np.add.reduceat(v, begins)) for v in (y, y * y)), *(pa.array(np.ascontiguousarray(v)) for v in both)],
                ["cell", "fold", "n", "total", "square", *names])

    sums = ["n", "total", "square", *names]
    schema = "cell long, fold int, " + ", ".join(f"{c} double" for c in sums)
    parts = source.repartitionByRange("cell", "r").sortWithinPartitions("cell", "r").mapInArrow(run, schema)
    return parts.groupBy("cell", "fold").agg(*[F.sum(c).alias(c) for c in sums])


class CellForest:
    """M8: a forest whose trees see rows by their cell alone, so one prediction for each cell that occurs serves all its rows.

    ``place`` gives the cell from the bins' columns ``codes``, which ``binned`` makes; ``trees`` are one-tree forests.
    """

    def __init__(self, binned: Bucketizer, codes: list[str], place: Column, trees: list, features: str, pred: str):
        self.binned, self.codes, self.place, self.trees, self.features, self.pred = binned, codes, place, trees, features, pred

    def mean(self, cells: DataFrame) -> DataFrame:
        """Rows that have the bins' columns, with the mean of the trees' predictions."""
        names = [t.getPredictionCol() for t in self.trees]
        out = PipelineModel([assembler(self.codes, self.features), *self.trees]).transform(cells)
        return out.withColumn(self.pred, sum((F.col(c) for c in names[1:]), F.col(names[0])) / len(names)).drop(self.features, *names)

    def transform(self, df: DataFrame) -> DataFrame:
        rows = self.binned.transform(df).withColumn("__cell", self.place)
        found = written(self.mean(rows.select("__cell", *self.codes).distinct()).select("__cell", self.pred), "predicted")
        return rows.join(found, "__cell").drop("__cell", *self.codes)


def _grown(cells: DataFrame, size: int, codes: list[str], wood: RandomForestRegressor, depths: list[int], pool: ThreadPool) -> list[list]:
    """For each depth the trees of a forest, each fitted to the cells as rows weighted by its own draws."""
    trees, pred, label = wood.getNumTrees(), wood.getPredictionCol(), wood.getLabelCol()
    subset = "onethird" if wood.getFeatureSubsetStrategy() == "auto" and trees > 1 else wood.getFeatureSubsetStrategy()

    def fit(job):
        depth, t = job
        rows = cells.filter(F.col(f"w{t}") > 0).select(*codes, F.col(f"w{t}").alias("weight"), (F.col(f"s{t}") / F.col(f"w{t}")).alias(label))
        one = wood.copy({wood.numTrees: 1, wood.bootstrap: False, wood.featureSubsetStrategy: subset, wood.weightCol: "weight",
                         wood.maxDepth: depth, wood.seed: wood.getSeed() + t, wood.predictionCol: f"{pred}_{t}"})
        return one.fit(assembler(codes, wood.getFeaturesCol()).transform(rows.coalesce(1 + size // 100_000)))  # a task has about so many cells

    found = pool.map(fit, [(d, t) for d in depths for t in range(trees)], chunksize=1)
    return [found[k * trees:(k + 1) * trees] for k in range(len(depths))]


def forest_grid_search(train: DataFrame, features: list[str], wood: RandomForestRegressor, depths: list[int],
                       fold_col: str = "fold", parallelism: int = 8) -> tuple[list[tuple[int, int, float]], int, CellForest]:
    """M6/M8: (fold, depth, RMSE on the fold of the forest without it) for every fold and depth, the depth with the
    least mean error, and the forest of that depth on all rows.

    Trees see a row by the bins of its features, its label and how often they draw it.  So all rows are drawn
    for all trees in one pass and summed up by cell (the bins of all features) and fold; what the fits then
    read is bounded by the cells, and a fold's training rows are the cells of the others.  A tree fitted to a cell's mean label, weighted
    by its draws, has the splits of one fitted to the rows: the gain of a split doesn't depend on how labels vary within a cell.
    """
    if wood.getMinInstancesPerNode() != 1 or wood.getSubsamplingRate() != 1.0 or not wood.getBootstrap():
        raise ValueError("rows of a cell can stand together only with a whole bootstrap and nodes of one row or more")
    trees, pred = wood.getNumTrees(), wood.getPredictionCol()
    codes = [f"{c}_bin" for c in features]
    cuts = bin_cuts(train, features, wood.getMaxBins())
    if not all(cuts):
        raise ValueError("a feature has no values")
    edges = [[-math.inf, *np.nextafter(c, math.inf).tolist(), math.inf] for c in cuts]     # a value at a cut stays below it
    binned = Bucketizer(splitsArray=edges, inputCols=features, outputCols=codes)
    strides = [math.prod(len(e) - 1 for e in edges[:k]) for k in range(len(edges))]
    place = sum((F.col(c).cast("long") * s for c, s in zip(codes, strides)), F.lit(0))
    parts = written(bootstrap_cells(binned.transform(train).withColumn("cell", place), "cell", fold_col, wood.getLabelCol(), trees, wood.getSeed())
                    .select("*", *[((F.col("cell") / s).cast("long") % (len(e) - 1)).cast("double").alias(c) for c, s, e in zip(codes, strides, edges)]), "cells")
    folds = sorted(r["fold"] for r in parts.select("fold").distinct().collect())            # one row a fold
    if len(folds) < 2:
        raise ValueError("cross-validation needs rows in two folds or more")

    def without(k):
        kept = parts if k is None else parts.filter(F.col("fold") != k)
        cells = written(kept.groupBy("cell", *codes).agg(*[F.sum(f"{x}{t}").alias(f"{x}{t}") for t in range(trees) for x in "ws"]), "training")
        return cells, cells.count()

    def model(grown):
        return CellForest(binned, codes, place, grown, wood.getFeaturesCol(), pred)

    errors = []
    with ThreadPool(parallelism) as pool:
        for k in folds:
            for depth, grown in zip(depths, _grown(*without(k), codes, wood, depths, pool), strict=True):
                held = model(grown).mean(parts.filter(F.col("fold") == k).select(*codes, "n", "total", "square"))
                e = held.agg(F.sum(F.col("square") - 2 * F.col(pred) * F.col("total") + F.col("n") * F.col(pred) ** 2).alias("sse"), F.sum("n").alias("n")).first()
                errors.append((k, depth, math.sqrt(max(e["sse"], 0.0) / e["n"])))
        best = min(depths, key=lambda d: sum(e for _, x, e in errors if x == d))
        return errors, best, model(_grown(*without(None), codes, wood, [best], pool)[0])


def forest_search(made: tuple[Pipeline, RandomForestRegressor], train: DataFrame, features: list[str], depths: list[int],
                  cells_from: int = 2_000_000):
    """M6/M8: the forest of the depth with the least error in cross-validation, on all rows.

    Up to ``cells_from`` rows Spark's own forests pass over the rows for each level; more rows are summed up by cell first, whose
    many small fits would take longer than that on few rows.
    """
    pipe, wood = made
    if train.count() > cells_from:
        return forest_grid_search(train, features, wood, depths)[2]
    grid = ParamGridBuilder().addGrid(wood.maxDepth, depths).build()
    return cross_validate(pipe, grid, train, wood.getLabelCol(), wood.getPredictionCol()).bestModel


def tree_nodes(model) -> DataFrame:
    """M7/M8: the nodes of a fitted tree or forest as rows, for queries and checks instead of a text.

    (tree, path, feature, threshold, gain, impurity, rows, prediction): path is L and R from the root, ``feature``
    the index in the vector; rows at or below the threshold go left.  Leaves have no feature.  Read from
    the model's own stored form, written to the shared folder.
    """
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    path = shared_path(spark, "model")
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData") if "nodeData" in data.columns else F.struct(*data.columns)
    tree = F.col("treeID") if "treeID" in data.columns else F.lit(0)
    flat = data.select(tree.cast("int").alias("tree"), node.alias("d")).select("tree", "d.*")
    rows = flat.select(
        "tree", F.col("id").alias("node"), F.when(F.col("leftChild") >= 0, F.col("leftChild")).alias("left"),
        F.when(F.col("rightChild") >= 0, F.col("rightChild")).alias("right"),
        F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).alias("feature"),
        F.when(F.col("leftChild") >= 0, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(F.col("leftChild") >= 0, F.col("gain")).alias("gain"), "impurity", F.col("impurityStats")[0].cast("long").alias("rows"), "prediction")
    placed = rows.filter("node = 0").withColumn("path", F.lit(""))
    level, out = placed, placed
    for _ in range(30):                                     # a tree has at most 30 levels below its root
        steps = level.filter(F.col("left").isNotNull()).select("tree", F.explode(F.array(
            F.struct(F.col("left").alias("node"), F.concat("path", F.lit("L")).alias("path")),
            F.struct(F.col("right").alias("node"), F.concat("path", F.lit("R")).alias("path")))).alias("s")).select("tree", "s.*")
        level = rows.join(steps, ["tree", "node"])
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.select("tree", "path", "feature", "threshold", "gain", "impurity", "rows", "prediction")


def gradient_descent(train: DataFrame, iters: int = 30, alpha: float = 1.0, features: str = "features",
                     label: str = "label") -> tuple[np.ndarray, list[float]]:
    """Full-batch gradient descent for linear regression (no intercept).

    Step i uses alpha / (n * sqrt(i + 1)); the gradient is sum((w.x - y) x)
    (the reference's Q6 defect -- multiplying by w -- is fixed).  Returns the
    weights and the training RMSE before each step.
    """
    data = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")) \
        .persist(StorageLevel.MEMORY_AND_DISK)
    size = data.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = size["n"], size["d"] or 0
    w = np.zeros(d)
    errors: list[float] = []
    for i in range(iters if n else 0):
        wi = w.copy()

        def partial(batches, wi=wi):
            g = np.zeros(d + 1)   # the gradient, and the squared error in the last place
            for pdf in batches:
                if len(pdf) == 0:
                    continue
                x = np.vstack(pdf["x"].to_numpy())
                r = x @ wi - pdf["y"].to_numpy()
                g[:d] += x.T @ r
                g[d] += float(r @ r)
            yield pd.DataFrame({"j": np.arange(d + 1), "v": g})

        # one job a step: d + 1 numbers per partition cross the shuffle
        g = np.zeros(d + 1)
        for r in data.mapInPandas(partial, "j long, v double").groupBy("j").agg(F.sum("v").alias("v")).collect():
            g[r["j"]] = r["v"]
        errors.append(float(np.sqrt(g[d] / n)))
        w = w - alpha / (n * np.sqrt(i + 1)) * g[:d]
    data.unpersist()
    return w, errors


# --------------------------------------------------------- recommendation

#: The most ratings of a block in a fit; from how many ratings on a fit keeps its blocks on disk and its steps' files for CHECKPOINT_STEPS only.
BLOCK_RATINGS, STORED_RATINGS, CHECKPOINT_STEPS = 4_000_000, 4_000_000, 2


def als(rank: int = 4, reg: float = 0.1, iters: int = 10, seed: int = 23,
        user: str = "userId", item: str = "movieId", rating: str = "rating", ratings: int = 0) -> ALS:
    """ALS with cold-start rows dropped.

    ``ratings``: how many will be fitted.  A task builds and solves a whole block of users or items, so there are as many blocks as
    hold BLOCK_RATINGS each, ten at least (as in Spark).  Steps exchange factors through files that stay until a checkpoint; a
    large fit makes one every CHECKPOINT_STEPS and leaves executors' memory to the tasks.
    """
    blocks = max(10, -(-ratings // BLOCK_RATINGS))
    out = ALS(rank=rank, maxIter=iters, regParam=reg, seed=seed, userCol=user, itemCol=item,
              ratingCol=rating, coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks)
    if ratings > STORED_RATINGS:
        out.setParams(checkpointInterval=CHECKPOINT_STEPS, intermediateStorageLevel="DISK_ONLY", finalStorageLevel="DISK_ONLY")
    return out


def stored_model(model: ALSModel) -> ALSModel:
    """The model with its factors read from the shared folder; all files of the fit can go then."""
    spark = model.itemFactors.sparkSession
    path = shared_path(spark, "als")
    model.write().save(path)
    return ALSModel.load(path)


def dense_ids(df: DataFrame, col: str) -> DataFrame:
    """(col, dense): the distinct ids of a column numbered from 0 in their order, as a table.

    ALS takes 32-bit ids; any id type will do here, as long as there are fewer than 2^31 of them.
    The distinct ids are written once, so that numbers stay the same wherever the table is read.
    """
    checkpoint_dir(df.sparkSession)
    ids = df.select(col).filter(F.col(col).isNotNull()).distinct().checkpoint()
    return row_index(ids, col, name="dense").withColumn("dense", F.col("dense").cast("int"))     # ANSI: fails beyond 2^31


def with_dense(df: DataFrame, ids: dict[str, DataFrame], how: str = "inner") -> DataFrame:
    """``df`` with a 32-bit column ``<col>_dense`` for each column of ``ids`` (tables of ``dense_ids``)."""
    for c, table in ids.items():
        df = df.join(table.withColumnRenamed("dense", f"{c}_dense"), c, how)
    return df


def int_ids(df: DataFrame, cols: list[str]) -> DataFrame:
    """Ids cast to 32 bits, failing loudly beyond 2^31 (ANSI cast); ``dense_ids`` takes any."""
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("int"))
    return df


def mean_pairs(ratings: DataFrame, user: str = "userId", item: str = "movieId",
               rating: str = "rating") -> DataFrame:
    """Repeated (user, item) ratings averaged to one."""
    return ratings.groupBy(user, item).agg(F.avg(rating).alias(rating))


def choose_rank(train: DataFrame, valid: DataFrame, ranks: list[int], **kw):
    """Fit each rank and score it once: (rank, validation RMSE, rows scored, model) each, and the true argmin (Q5 fixed)."""
    results, large = [], kw.get("ratings", 0) > STORED_RATINGS
    for k in ranks:
        if large:
            swept(train.sparkSession)       # what was left by the scores of the rank before
        model = als(rank=k, **kw).fit(train)
        if large:
            model = stored_model(model)
            swept(train.sparkSession)
        m = regression_metrics(model.transform(valid), "rating", "prediction").first()
        results.append((k, m["rmse"], m["n"], model))
    best = min(results, key=lambda t: (t[1], t[0]))
    return best, results


def recommend_new_user(model_factory, train: DataFrame, mine: DataFrame, items: DataFrame,
                       stats: DataFrame, user_id: int, min_count: int = 100, k: int = 20,
                       item: str = "movieId") -> DataFrame:
    """Append a new user's ratings, refit, score items they have not rated,
    keep items with more than ``min_count`` ratings, top k by prediction."""
    model = model_factory().fit(train.unionByName(mine))
    unrated = items.join(mine.select(item), item, "left_anti").withColumn("userId", F.lit(user_id))
    pred = model.transform(unrated)
    pred = pred.filter(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    return (pred.join(stats, item).filter(F.col("count") > min_count)
            .orderBy(F.desc("prediction"), F.asc(item)).limit(k))


def fold_in(factors: DataFrame, mine: DataFrame, reg: float = 0.1, item: str = "id", rating: str = "rating") -> np.ndarray:
    """The factors of a user who was not fitted, from item factors and their own ratings, without fitting again.

    The k x k normal equations that ALS solves for each user: (sum v v' + reg n I) u = sum r v over the n items
    that are rated and have factors.  ``factors`` is (item, features array); a user's own ratings are few and come to the driver.
    """
    known = factors.join(mine.select(item, rating), item).select("features", F.col(rating).cast("double").alias("r")).collect()
    if not known:
        raise ValueError("none of the rated items has factors")
    v, r = np.array([x["features"] for x in known], float), np.array([x["r"] for x in known])
    return np.linalg.solve(v.T @ v + reg * len(r) * np.eye(v.shape[1]), v.T @ r)


def recommend_folded(factors: DataFrame, user: np.ndarray, mine: DataFrame, stats: DataFrame, min_count: int = 100,
                     k: int = 20, item: str = "id") -> DataFrame:
    """The k items of the highest predicted rating among those not rated by the user and with more than
    ``min_count`` ratings (``stats``: item, count); ties go to the smaller item."""
    taste = F.array(*[F.lit(float(x)) for x in user])
    scored = factors.join(mine.select(item), item, "left_anti").select(
        item, dot(F.transform("features", lambda x: x.cast("double")), taste).alias("prediction"))
    return (scored.join(stats, item).filter(F.col("count") > min_count)
            .orderBy(F.desc("prediction"), F.asc(item)).limit(k))


# ---------------------------------------------------------- classification

def logistic_fit(train: DataFrame, reg: float = 0.01, elastic: float = 0.0, iters: int = 20, weight: str | None = None):
    """M22/M23.  ``weight``: a column that says how many equal records a row stands for."""
    lr = LogisticRegression(featuresCol="features", labelCol="label", maxIter=iters, regParam=reg,
                            elasticNetParam=elastic, standardization=False)
    return (lr.setWeightCol(weight) if weight else lr).fit(train)


def add_probability(df: DataFrame, model, bound: float = 20.0) -> DataFrame:
    """p = logistic(w.x + b) with the raw score clamped to [-bound, bound] (Q10).

    Spark's rawPrediction[1] is the margin w.x + b; the clamp and the
    logistic are native column expressions.
    """
    scored = model.transform(df)
    z = F.greatest(F.lit(-bound), F.least(F.lit(bound), vector_to_array("rawPrediction")[1]))
    return scored.withColumn("p", logistic(z)).drop("rawPrediction", "probability", "prediction")

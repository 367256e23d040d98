"""Model evaluation.

Metrics are single-pass aggregates.  ROC groups rows by score first (ties
form one point), then takes running sums along descending score with
``keys.running_sums`` -- no single-partition window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.keys import running_sums
from tessera.operators.relational import bucket
from tessera.plans.joins import one_row

# Fixed value: probability clamp used before taking logarithms.
EPSILON = 1e-16


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M4: one row (rmse, r2, n); r2 = 1 - SSE / SST over the same rows."""
    m = df.filter(F.col(pred).isNotNull() & ~F.isnan(pred)).select(
        F.col(label).cast("double").alias("y"), F.col(pred).cast("double").alias("p"))
    # the population variance is merged from centred moments, so labels far from zero lose nothing
    moments = m.agg(F.count(F.lit(1)).alias("n"), (F.var_pop("y") * F.count(F.lit(1))).alias("sst"),
                    F.sum((F.col("y") - F.col("p")) ** 2).alias("sse"))
    # r2 is null when the labels are constant, rmse when there are no rows
    return moments.select(F.sqrt(F.try_divide(F.col("sse"), F.col("n"))).alias("rmse"),
                          (F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst"))).alias("r2"), "n")


def rmse(df: DataFrame, label: str, pred: str) -> float:
    return regression_metrics(df, label, pred).first()["rmse"]


def residuals(df: DataFrame, label: str, pred: str, rmse_value: float | Column) -> DataFrame:
    """M5: residual and residual in RMSE units (unrounded RMSE)."""
    r = F.col(label) - F.col(pred)
    unit = rmse_value if isinstance(rmse_value, Column) else F.lit(float(rmse_value))
    return df.withColumn("residual", r).withColumn("within_rmse", _in_units(r, unit))


def _in_units(r: Column, unit: Column) -> Column:
    """r / unit; 0 where the unit and the residual both are (a perfect fit)."""
    return F.when((unit == 0) & (r == 0), F.lit(0.0)).otherwise(F.try_divide(r, unit))


def residual_share(df: DataFrame, label: str, pred: str) -> DataFrame:
    """M5 + A11 + A12: share of rows within 1, 2 or more RMSE of the truth.

    Rows without a prediction are left out, as in ``regression_metrics``.  The RMSE is a
    scalar (one aggregate row) used unrounded as a literal; in a perfect fit every row is
    within one RMSE.
    """
    df = df.filter(F.col(pred).isNotNull() & ~F.isnan(pred))
    r = F.col(label) - F.col(pred)
    rm = one_row(df.agg(F.sqrt(F.avg(r ** 2)).alias("rmse"), F.count(F.lit(1)).alias("n")))
    w = df.withColumn("within_rmse", _in_units(r, F.lit(rm["rmse"]).cast("double")))
    b = bucket("within_rmse", [(-1.0, 1.0, 1), (-2.0, 2.0, 2)], 3).alias("rmse_range")
    grouped = w.groupBy(b).agg(F.count(F.lit(1)).alias("count"))
    return grouped.select("rmse_range", "count", F.try_divide(F.col("count").cast("double"), F.lit(rm["n"])).alias("percent"))


def clamp_probability(p: Column) -> Column:
    """M25 clamp: p = 0 becomes eps, then p = 1 becomes 1 - eps."""
    p0 = F.when(p == 0, F.lit(EPSILON)).otherwise(p)
    return F.when(p0 == 1, p0 - F.lit(EPSILON)).otherwise(p0)


def log_loss(p: Column, label: Column) -> Column:
    """-log(p) for label 1, -log(1 - p) otherwise, with the clamp."""
    q = clamp_probability(p)
    return F.when(label == 1, -F.ln(q)).otherwise(-F.ln(F.lit(1.0) - q))


def with_log_loss(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    return df.withColumn("log_loss", log_loss(F.col(p), F.col(label)))


def mean_log_loss(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """One row: mean log loss."""
    return df.agg(F.avg(log_loss(F.col(p), F.col(label))).alias("log_loss"))


def log_loss_vs_baseline(df: DataFrame, p: str = "p", label: str = "label",
                         baseline: float | None = None) -> DataFrame:
    """Model log loss and the constant baseline's (baseline p defaults to the mean label)."""
    if baseline is None:
        baseline = one_row(df.agg(F.avg(label).alias("b")))["b"]
    b = F.lit(float(baseline))
    return df.agg(F.avg(log_loss(F.col(p), F.col(label))).alias("log_loss_model"),
                  b.alias("baseline_p"),
                  F.avg(log_loss(b, F.col(label))).alias("log_loss_baseline"))


def _per_score(df: DataFrame, p: str, label: str) -> DataFrame:
    """(threshold, pos, neg): rows of either class at each distinct score."""
    return (df.groupBy(F.col(p).alias("threshold"))
            .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(~F.coalesce(F.col(label) == 1, F.lit(False))).alias("neg")))


def roc_points(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """(threshold, tpr, fpr), one point per distinct score, from high to low.

    A row is predicted positive when its score >= threshold.  Rates are null
    when a class is empty.
    """
    per_score = _per_score(df, p, label)
    n = one_row(per_score.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    cum = running_sums(per_score, "-threshold", {"tp": "pos", "fp": "neg"})
    rate = lambda c, total: F.try_divide(F.col(c).cast("double"), F.lit(total).cast("double"))
    return cum.select("threshold", rate("tp", n["pos"]).alias("tpr"), rate("fp", n["neg"]).alias("fpr"))


def roc_auc(df: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """Area under the ROC curve as one aggregate over score groups.

    With ties grouped, AUC = sum_g neg_g * (tp_above_g + pos_g / 2) / (P * N),
    where tp_above_g counts positives with a strictly higher score.  Equal to
    the trapezoid area under the points of ``roc_points``; null when a class
    is empty.  Products are doubles: P * N passes 64 bits at scale.
    """
    cum = running_sums(_per_score(df, p, label), "-threshold", {"tp": "pos"})
    area = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0))
    return cum.agg(F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))

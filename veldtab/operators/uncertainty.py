"""Split-conformal prediction sets and intervals, and quantile intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldtab.functions.columns import name
from veldtab.functions.moments import argmax, entropy
from veldtab.functions.ordering import exact_quantiles, rank_list, select_ranks


def conformal_quantile(scores: DataFrame, col: str = "score", alpha: float = 0.10) -> DataFrame:
    """One row ``qhat``: the score at zero-based rank min(ceil((n+1)(1-alpha)), n-1) of the finite scores."""
    rank = lambda n: rank_list([(0, F.least(F.ceil((n + 1) * F.lit(1.0 - alpha)), n - 1))])
    return select_ranks(scores.select(name(col).alias("_s")), [], "_s", rank).agg(F.max("_s").alias("qhat"))


def nonconformity(y: Column, probabilities: Column) -> Column:
    return 1 - F.element_at(probabilities, y.cast("int") + 1)


def prediction_sets(df: DataFrame, probs: str, qhat: float) -> DataFrame:
    """Adds prediction_set, set_size, confidence and entropy; the set is never empty."""
    p = name(probs)
    limit = F.lit(1.0 - float(qhat))
    reached = F.filter(F.transform(p, lambda v, i: F.when(v >= limit, i)), lambda i: i.isNotNull())
    chosen = F.when(F.size(reached) > 0, reached).otherwise(F.array(argmax(p)))
    return df.withColumn("prediction_set", chosen).withColumns({
        "set_size": F.size("prediction_set"), "confidence": F.array_max(p), "entropy": entropy(p)})


def classification_uncertainty(calibration: DataFrame, test: DataFrame, y: str = "y", probs: str = "probs",
                               alpha: float = 0.10) -> tuple[DataFrame, DataFrame]:
    """(rows with prediction sets, one summary row)."""
    scores = calibration.select(nonconformity(name(y), name(probs)).alias("score"))
    qhat = conformal_quantile(scores, "score", alpha).first()["qhat"]
    rows = prediction_sets(test, probs, qhat)
    summary = rows.agg(F.lit("split_conformal_classification").alias("method"), F.lit(float(qhat)).alias("qhat"),
                       F.lit(1.0 - float(qhat)).alias("probability_threshold"),
                       F.coalesce(F.avg("set_size"), F.lit(0.0)).alias("mean_prediction_set_size"))
    return rows, summary


def conformal_intervals(df: DataFrame, yhat: str, qhat: float) -> DataFrame:
    return df.withColumns({"conformal_lower": name(yhat) - float(qhat), "conformal_upper": name(yhat) + float(qhat),
                           "conformal_radius": F.lit(float(qhat))})


def regression_uncertainty(calibration: DataFrame, test: DataFrame, y: str = "y", yhat: str = "yhat",
                           alpha: float = 0.10) -> tuple[DataFrame, DataFrame]:
    """(rows with intervals, one summary row with the empirical coverage)."""
    scores = calibration.select(F.abs(name(y) - name(yhat)).alias("score"))
    qhat = conformal_quantile(scores, "score", alpha).first()["qhat"]
    rows = conformal_intervals(test, yhat, qhat)
    covered = name(y).between(F.col("conformal_lower"), F.col("conformal_upper"))
    summary = rows.agg(F.lit("split_conformal_regression").alias("method"), F.lit(float(qhat)).alias("qhat"),
                       F.avg(covered.cast("double")).alias("conformal_empirical_coverage"))
    return rows, summary


def leaf_intervals(train: DataFrame, test: DataFrame, leaf: str, y: str, yhat: str, *,
                   low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Quantile intervals from the residuals of the training rows in the same tree leaf.

    The number of leaves is bounded by the tree depth; the residual quantiles are exact and no leaf
    is gathered in one task.
    """
    residuals = train.select(name(leaf).alias("_leaf"), (name(y) - name(yhat)).alias("_r"))
    quantiles = exact_quantiles(residuals, ["_leaf"], "_r", [low, high])
    bounds = quantiles.groupBy("_leaf").agg(F.min("quantile").alias("_lo"), F.max("quantile").alias("_hi"))
    joined = test.join(F.broadcast(bounds), name(leaf) == F.col("_leaf"), "left")
    return joined.withColumns({"quantile_lower": name(yhat) + F.col("_lo"),
                               "quantile_upper": name(yhat) + F.col("_hi")}).drop("_leaf", "_lo", "_hi")


def quantile_intervals(df: DataFrame, lower, upper) -> DataFrame:
    """Adds quantile_lower and quantile_upper from two quantile models; where they cross, both ends change places."""
    out = lower.transform(df).withColumnRenamed("yhat", "_lo")
    out = upper.transform(out).withColumnRenamed("yhat", "_hi")
    return out.withColumns({"quantile_lower": F.least("_lo", "_hi"), "quantile_upper": F.greatest("_lo", "_hi")}).drop("_lo", "_hi")

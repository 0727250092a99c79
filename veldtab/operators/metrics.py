"""Exact metrics over scored rows.

Label metrics come from one confusion table (classes squared rows), ranking metrics from counts per
distinct score and exact running sums, so neither bins scores nor sorts them in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldtab.functions.columns import name
from veldtab.functions.moments import ratio
from veldtab.functions.ordering import exact_quantiles, prefix_sum
from veldtab.operators.cleaning import undo_log
from veldtab.operators.profiling import MINIMISED_METRICS

# Supported metric names.
CLASSIFICATION_METRICS = (
    "roc_auc", "auprc", "log_loss", "cross_entropy", "brier_score", "ece",
    "accuracy", "balanced_accuracy",
    "precision_micro", "precision_macro", "precision_weighted",
    "recall_micro", "recall_macro", "recall_weighted",
    "f1_micro", "f1_macro", "macro_f1", "f1_weighted", "weighted_f1",
    "specificity", "hamming_loss",
)
REGRESSION_METRICS = ("r2", "mae", "mse", "rmse", "median_absolute_error")
METRIC_ALIASES = {"cross_entropy": "log_loss", "macro_f1": "f1_macro", "weighted_f1": "f1_weighted"}

# Smallest probability inside a logarithm: the spacing of doubles at 1.
EPS = 2.220446049250313e-16


def confusion(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """(y, pred, n, row_share)."""
    counts = df.groupBy(name(y).alias("y"), name(pred).alias("pred")).agg(F.count("*").alias("n"))
    return counts.withColumn("row_share", F.col("n") / F.sum("n").over(Window.partitionBy("y")))


def label_counts(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """(label, tp, support, predicted) over the union of true and predicted labels."""
    cells = df.groupBy(name(y).alias("y"), name(pred).alias("pred")).agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("y").alias("label"), F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(zero).alias("tp"),
                 F.col("n").alias("support"), zero.alias("predicted")),
        F.struct(F.col("pred").alias("label"), zero.alias("tp"), zero.alias("support"), F.col("n").alias("predicted")))
    return (cells.select(F.explode(sides).alias("s")).select("s.*").groupBy("label")
            .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")]))


def _f1(p: Column, r: Column) -> Column:
    return ratio(2.0 * p * r, p + r)


def class_report(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """(label, precision, recall, f1, support); 0 where a quotient is undefined."""
    p, r = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    return label_counts(df, y, pred).select(
        "label", p.alias("precision"), r.alias("recall"), _f1(p, r).alias("f1"), "support")


def label_metrics(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """One row: accuracy, hamming loss, balanced accuracy, 3 x 3 averages, specificity."""
    p, r = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    rows = label_counts(df, y, pred).select(
        "*", p.alias("precision"), r.alias("recall"), _f1(p, r).alias("f1"))
    true_label = F.col("support") > 0
    aggs = [F.sum("tp").alias("tp"), F.sum("support").alias("n"), F.sum("predicted").alias("n_pred"),
            F.avg(F.when(true_label, F.col("recall"))).alias("balanced_accuracy"),
            F.count_if(true_label).alias("n_true"),
            F.min_by("recall", F.when(true_label, F.col("label"))).alias("first_recall")]
    for m in ("precision", "recall", "f1"):
        aggs += [F.avg(m).alias(f"{m}_macro"),
                 (F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"{m}_weighted")]
    one = rows.agg(*aggs)
    accuracy = F.col("tp") / F.col("n")
    return one.select(
        accuracy.alias("accuracy"), (1 - accuracy).alias("hamming_loss"), "balanced_accuracy",
        *[accuracy.alias(f"{m}_micro") for m in ("precision", "recall", "f1")],
        *[f"{m}_{a}" for m in ("precision", "recall", "f1") for a in ("macro", "weighted")],
        # With two true labels, the recall of the smaller one is the true-negative rate.
        F.when(F.col("n_true") == 2, F.col("first_recall")).alias("specificity"))


def score_counts(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """Per distinct score: positives and negatives, those below it, and both totals."""
    marked = df.select(name(p).cast("double").alias("p"),
                       F.when(name(y) == 1, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("pos"),
                       F.when(name(y) == 1, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("neg"))
    return prefix_sum(marked, [], "p", ["pos", "neg"])


def ranking_metrics(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """One row: roc_auc (ties count half) and auprc (step-wise average precision)."""
    counts = score_counts(df, y, p)
    tp = F.col("total_pos") - F.col("below_pos")
    fp = F.col("total_neg") - F.col("below_neg")
    pairs = F.col("total_pos").cast("double") * F.col("total_neg")
    won = F.col("pos").cast("double") * (F.col("below_neg") + F.col("neg") / 2.0)
    return counts.agg(
        (F.sum(won) / F.nullif(F.max(pairs), F.lit(0.0))).alias("roc_auc"),
        F.sum(F.col("pos") / F.nullif("total_pos", F.lit(0)) * (tp / (tp + fp))).alias("auprc"))


def uniform_bin(p: Column, bins: int = 10) -> Column:
    """Bin with edges i * (1/bins), lower edge inside; the floor is corrected by the edge itself."""
    step = 1.0 / bins
    b = F.floor(p * bins)
    return (F.when(p < b * step, b - 1).when(p >= (b + 1) * step, b + 1).otherwise(b)).cast("int")


def calibration_bins(df: DataFrame, y: str = "y", p: str = "p", *, bins: int = 10,
                     include_one: bool = False, keys: list[str] = ()) -> DataFrame:
    """(keys, bin, n, mean_y, mean_p); a score of exactly 1 is in no bin unless asked for."""
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), name(p).cast("double")))
    b = uniform_bin(clipped, bins)
    if include_one:
        b = F.least(b, F.lit(bins - 1))
    return (df.select(*[name(k) for k in keys], name(y).cast("double").alias("_y"), clipped.alias("_p"), b.alias("bin"))
            .where(F.col("_p").isNotNull())
            .groupBy(*[name(k) for k in keys], "bin")
            .agg(F.count("*").alias("n"), F.avg("_y").alias("mean_y"), F.avg("_p").alias("mean_p"),
                 F.sum((F.col("_p") - F.col("_y")) * (F.col("_p") - F.col("_y"))).alias("sq_error")))


def calibration_metrics(df: DataFrame, y: str = "y", p: str = "p", *, bins: int = 10,
                        include_one: bool = False, keys: list[str] = ()) -> DataFrame:
    """Expected calibration error and Brier score, from one pass."""
    table = calibration_bins(df, y, p, bins=bins, include_one=include_one, keys=keys)
    gap = F.when(F.col("bin") < bins, F.col("n") * F.abs(F.col("mean_y") - F.col("mean_p"))).otherwise(0.0)
    return table.groupBy(*[name(k) for k in keys]).agg(
        (F.sum(gap) / F.sum("n")).alias("ece"), (F.sum("sq_error") / F.sum("n")).alias("brier_score"))


def log_loss_of(true_probability: Column) -> Column:
    return F.avg(-F.log(F.least(F.greatest(true_probability, F.lit(EPS)), F.lit(1 - EPS))))


def binary_log_loss(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    return df.agg(log_loss_of(F.when(name(y) == 1, name(p)).otherwise(1 - name(p))).alias("log_loss"))


def multiclass_log_loss(df: DataFrame, y: str = "y", probs: str = "probs") -> DataFrame:
    return df.agg(log_loss_of(F.element_at(name(probs), name(y).cast("int") + 1)).alias("log_loss"))


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat", *, logged: bool = False) -> DataFrame:
    """One row: r2, mae, mse, rmse, median_absolute_error; ``logged`` undoes log1p on both first."""
    pairs = df.select(name(y).cast("double").alias("y"), name(yhat).cast("double").alias("yhat"))
    pairs = undo_log(pairs, ["y", "yhat"], logged).withColumn("_e", F.col("y") - F.col("yhat"))
    main = pairs.agg(F.avg(F.col("_e") * F.col("_e")).alias("mse"), F.avg(F.abs("_e")).alias("mae"),
                     F.var_pop("y").alias("_var"))
    median = (exact_quantiles(pairs.select(F.abs("_e").alias("_a")), [], "_a", [0.5])
              .agg(F.max("quantile").alias("median_absolute_error")))
    return main.crossJoin(F.broadcast(median)).select(  # one row by one row
        (1 - F.col("mse") / F.nullif("_var", F.lit(0.0))).alias("r2"), "mae", "mse",
        F.sqrt("mse").alias("rmse"), "median_absolute_error")


def metric_rows(one_row: DataFrame) -> DataFrame:
    """(metric, value) from one row of metrics; undefined metrics are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), name(c).cast("double").alias("value")) for c in one_row.columns])
    return one_row.select(F.explode(pairs).alias("m")).select("m.*").where("value is not null")


def classification_suite(df: DataFrame, y: str = "y", pred: str = "pred", p: str | None = "p",
                         probs: str | None = None, *, binary: bool = True) -> DataFrame:
    """All classification metrics as (metric, value) rows; probability ones only where defined."""
    labels = label_metrics(df, y, pred)
    parts = [metric_rows(labels if binary else labels.drop("specificity"))]
    if p and binary:
        parts += [metric_rows(ranking_metrics(df, y, p)), metric_rows(calibration_metrics(df, y, p)),
                  metric_rows(binary_log_loss(df, y, p))]
    elif probs:
        parts.append(metric_rows(multiclass_log_loss(df, y, probs)))
    return reduce(DataFrame.unionByName, parts)


def score(df: DataFrame, metric: str, y: str = "y", pred: str = "pred", p: str = "p", yhat: str = "yhat", *,
          display: bool = False, probs: str | None = None) -> DataFrame:
    """One metric by name as one row; higher is better unless ``display`` asks for the plain value."""
    if metric not in CLASSIFICATION_METRICS + REGRESSION_METRICS:
        raise ValueError(f"unknown metric '{metric}'; known: {sorted(CLASSIFICATION_METRICS + REGRESSION_METRICS)}")
    key = METRIC_ALIASES.get(metric, metric)
    if key in REGRESSION_METRICS:
        table = regression_metrics(df, y, yhat)
    elif key in ("roc_auc", "auprc"):
        table = ranking_metrics(df, y, p)
    elif key in ("ece", "brier_score"):
        table = calibration_metrics(df, y, p)
    elif key == "log_loss":
        table = multiclass_log_loss(df, y, probs) if probs else binary_log_loss(df, y, p)
    else:
        table = label_metrics(df, y, pred)
    sign = -1.0 if key in MINIMISED_METRICS and not display else 1.0
    return table.select(F.lit(metric).alias("metric"), (name(key) * sign).alias("value"))

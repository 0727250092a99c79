"""One training run: split, roles, preparation, early-stopped fit, threshold, metrics, uncertainty.

Training rows are target-encoded out of fold. Half of the validation rows (``cal``) take no part in any fit: the conformal
quantile comes from the final model's scores of them, as do the sets of the test rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldtab.functions.columns import name
from veldtab.functions.hashing import hash_order
from veldtab.operators import metrics as M
from veldtab.operators import models as I
from veldtab.operators import thresholds as H
from veldtab.operators import uncertainty as U
from veldtab.operators.prep import class_weights
from veldtab.operators.profiling import FeatureRoles, choose_metric, detect_roles
from veldtab.operators.scoring import ScoringSpec
from veldtab.operators.splits import written_holdout
from veldtab.sources.storage import write_through


@dataclass(frozen=True)
class TrainingResult:
    preparation: I.Preparation
    model: object
    roles: FeatureRoles
    spec: ScoringSpec
    metrics: DataFrame
    uncertainty: DataFrame


def train_classifier(df: DataFrame, target: str, key_cols: list[str], *, roles: FeatureRoles | None = None, metric: str = "auto",
                     params: I.TreeParams = I.TreeParams(), policy: H.ThresholdPolicy = H.ThresholdPolicy(), seed: int = 42,
                     alpha: float = 0.10) -> TrainingResult:
    """Binary classifier from a cleaned table with a 0/1 target. Roles and metric come from the train rows.

    The prepared table is cached once and read by every fit and evaluation.
    """
    parts = written_holdout(df, target, key_cols, seed=seed)
    set_aside = (F.col("split") == "val") & (hash_order(seed + 1, key_cols) % 2 == 0)
    parts = parts.withColumn("split", F.when(set_aside, "cal").otherwise(F.col("split")))
    train = parts.where("split = 'train'")
    roles = roles or detect_roles(train, exclude=[target, "split", *key_cols])
    chosen = choose_metric(train, target, metric=metric).first()
    preparation = I.fit_preparation(train, roles, target)
    columns = [*key_cols, target, "split", I.FEATURES]
    prepared = (preparation.transform_train(train, target, key_cols).select(*columns)
                .unionByName(preparation.transform(parts.where("split <> 'train'")).select(*columns)))
    weight = None
    if chosen["class_weight"]:
        prepared, weight = class_weights(prepared, target, chosen["class_weight"]), "weight"
    cached = prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        which = lambda label: cached.where(F.col("split") == label)
        stopped = I.fit_early_stopped(which("train"), which("val"), "classification", params, label=target, weight=weight)
        model = I.fit_final(cached, "classification", params, stopped.best_iteration, label=target, weight=weight)
        # Written, so that each metric and quantile does not score the rows anew.
        scores = lambda fitted, label: write_through(I.scored(fitted, which(label), "classification").select(name(target), "probs", "p", "pred"), "scored")
        threshold = H.tune_threshold(scores(stopped.model, "val"), policy, chosen["metric"], y=target).first()["threshold"]
        test = H.apply_threshold(scores(model, "test"), threshold)
        _, summary = U.classification_uncertainty(scores(model, "cal"), test, target, "probs", alpha)
        found = M.classification_suite(test, y=target).collect()
        summary_row = summary.collect()
    finally:
        cached.unpersist()
    spark = df.sparkSession
    extra = [("threshold", float(threshold)), ("n_trees", float(stopped.best_iteration)),
             ("mean_prediction_set_size", float(summary_row[0]["mean_prediction_set_size"]))]
    table = spark.createDataFrame([(r["metric"], float(r["value"])) for r in found] + extra, "metric string, value double")
    spec = ScoringSpec(tuple(roles.all), "classification", chosen["metric"], threshold=float(threshold))
    return TrainingResult(preparation, model, roles, spec, table, spark.createDataFrame(summary_row, summary.schema))

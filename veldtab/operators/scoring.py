"""Batch scoring: input check, labels, probabilities, response envelope."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldtab.functions.columns import name
from veldtab.operators.cleaning import decode_labels, undo_log
from veldtab.operators.drift import category_counts, unseen_categories
from veldtab.operators.models import Preparation, scored
from veldtab.operators.thresholds import apply_threshold


@dataclass(frozen=True)
class ScoringSpec:
    """What a fitted model needs to know to score rows."""

    expected: tuple[str, ...]
    task: str = "classification"
    metric: str = "roc_auc"
    version: str = ""
    threshold: float | None = 0.5
    labels: tuple | None = None
    dropped: tuple[str, ...] = ()
    logged: bool = False


def check_input(df: DataFrame, spec: ScoringSpec, keep: list[str] = (), *, refuse_empty: bool = True) -> tuple[DataFrame, list[str]]:
    """The expected columns (and ``keep``) and the warnings; missing columns and no rows are errors."""
    missing = sorted(set(spec.expected) - set(df.columns))
    if missing:
        raise ValueError(f"missing required column(s): {missing}; expected: {list(spec.expected)}")
    if refuse_empty and not df.isStreaming and df.isEmpty():
        raise ValueError("input has no rows")
    extra = set(df.columns) - set(spec.expected) - set(keep)
    known = sorted(extra & set(spec.dropped))
    noise = sorted(extra - set(spec.dropped))
    warnings = []
    if known:
        warnings.append(f"Column(s) dropped in training because of drift are ignored: {known}.")
    if noise:
        warnings.append(f"Extra column(s) are ignored: {noise}.")
    return df.select(*[name(c) for c in dict.fromkeys([*keep, *spec.expected])]), warnings


def unseen_report(df: DataFrame, known: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, category, n) of categories the training data did not have."""
    return unseen_categories(known, category_counts(df, cols))


def predict(df: DataFrame, preparation: Preparation, model, spec: ScoringSpec) -> DataFrame:
    """Rows with predictions: threshold for binary scores, argmax for classes, expm1 for logged values."""
    out = scored(model, preparation.transform(df), spec.task)
    if spec.task == "regression":
        return undo_log(out, ["yhat"], spec.logged).withColumnRenamed("yhat", "prediction")
    if spec.threshold is not None and "p" in out.columns:
        out = apply_threshold(out, spec.threshold)
    if spec.labels:
        return decode_labels(out, "pred", list(spec.labels), "prediction")
    return out.withColumn("prediction", F.col("pred"))


# Rows of one response document; a longer response comes in several parts.
PART_ROWS = 100_000


def envelope(rows: DataFrame, spec: ScoringSpec, warnings: list[str], order: str, request: str | None = None, *,
             part_rows: int = PART_ROWS) -> DataFrame:
    """JSON documents (request_id, part, parts, response), rows of a part in ``order``.

    A request of more than ``part_rows`` rows is spread over parts by a hash of its order column, so
    no task gathers more than about one part, however large a request is. ``order`` is unique in a
    request.
    """
    has_p = "probs" in rows.columns
    keyed = rows.withColumns({"request_id": name(request).cast("string") if request else F.lit("all"),
                              "_o": name(order)})
    sizes = keyed.groupBy("request_id").agg(F.ceil(F.count("*") / F.lit(part_rows)).cast("int").alias("parts"))
    spread = keyed.join(sizes, "request_id").withColumn("part", F.pmod(F.xxhash64("_o"), F.col("parts")).cast("int"))
    item = F.struct("_o", F.col("prediction").alias("prediction"),
                    *([F.col("probs").alias("probs")] if has_p else []), *([F.col("p").alias("p")] if "p" in rows.columns else []))
    grouped = spread.groupBy("request_id", "part", "parts").agg(F.array_sort(F.collect_list(item)).alias("_rows"), F.count("*").alias("n_rows"))
    pick = lambda field: F.transform("_rows", lambda x: x[field])
    null = F.lit(None).cast("array<double>")
    body = F.struct(
        F.lit(spec.version).alias("model_version"), F.lit(spec.task).alias("task"), F.lit(spec.metric).alias("metric"),
        F.lit(spec.threshold).cast("double").alias("threshold"), "n_rows", pick("prediction").alias("predictions"),
        (pick("probs") if has_p else null).alias("probabilities"), (pick("p") if "p" in rows.columns else null).alias("positive_proba"),
        F.array(*[F.lit(w) for w in warnings]).cast("array<string>").alias("warnings"))
    return grouped.select("request_id", "part", "parts", F.to_json(body).alias("response"))

"""Report sinks, the run registry and the fitted artifact."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(df: DataFrame, path: str, kind: str, *, small: bool = False, mode: str = "overwrite") -> str:
    """Write a result table as csv, json or snappy Parquet.

    ``small`` is for reports of a few rows (one per column, class or bin), which become one file.
    """
    out = df.coalesce(1) if small else df
    writer = out.write.mode(mode)
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    elif kind == "parquet":
        writer.option("compression", "snappy").parquet(path)
    else:
        raise ValueError(f"unknown report type: {kind}")
    return path


# Quality limits of the registry.
MIN_ROC_AUC = 0.80
MIN_AUPRC = 0.50
MIN_R2 = 0.70


def registry_record(metrics: DataFrame, *, run_id: str, timestamp: str, artifact: str, task: str,
                    best_n_estimators: int, best_threshold: float,
                    best_params: dict | None = None, threshold_policy: dict | None = None) -> DataFrame:
    """One registry row from a (metric, value) table; values are rounded to 6 digits."""
    rounded = F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("metric", F.round("value", 6).alias("value"))))).alias("eval_metrics")
    row = metrics.agg(rounded)
    value = lambda m: F.coalesce(F.try_element_at("eval_metrics", F.lit(m)), F.lit(0.0))
    passed = (value("r2") >= MIN_R2) if task == "regression" else (
        (value("roc_auc") >= MIN_ROC_AUC) & (value("auprc") >= MIN_AUPRC))
    as_text = lambda d: F.to_json(F.create_map(*[x for k, v in (d or {}).items()
                                                 for x in (F.lit(str(k)), F.lit(str(v)))])) \
        if d else F.lit("{}")
    return row.select(
        F.lit(f"{timestamp}_{run_id}").alias("run_id"), F.lit(timestamp).alias("timestamp"),
        F.lit(artifact).alias("artifact"), F.lit(task).alias("task"), "eval_metrics",
        as_text(best_params).alias("best_params"),
        F.lit(int(best_n_estimators)).alias("best_n_estimators"),
        F.lit(round(float(best_threshold), 6)).alias("best_threshold"),
        as_text(threshold_policy).alias("threshold_policy"),
        F.when(passed, "production_ready").otherwise("needs_review").alias("status"))


def append_registry(record: DataFrame, path: str) -> DataFrame:
    """Append to the registry folder and return all runs, newest last."""
    record.write.mode("append").parquet(path)
    return record.sparkSession.read.parquet(path).orderBy("timestamp", "run_id")


def run_report(registry_row: DataFrame, sections: dict[str, DataFrame]) -> DataFrame:
    """One JSON document: the registry row plus one array per small result table."""
    out = registry_row
    for label, table in sections.items():
        rows = table.agg(F.array_sort(F.collect_list(F.to_json(F.struct(*table.columns)))).alias(label))
        out = out.crossJoin(F.broadcast(rows))  # one row by one row
    return out.select(F.to_json(F.struct(*out.columns)).alias("value"))


def save_artifact(model: PipelineModel, metadata: dict, path: str, spark: SparkSession,
                  tables: dict[str, DataFrame] | None = None) -> str:
    """Fitted stages, one metadata row and the reference tables under one folder."""
    model.write().overwrite().save(f"{path}/model")
    flat = {k: ",".join(v) if isinstance(v, (list, tuple)) else v for k, v in metadata.items()}
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in flat.items()])
    row.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    for label, table in (tables or {}).items():
        table.write.mode("overwrite").parquet(f"{path}/tables/{label}")
    return path


def load_artifact(path: str, spark: SparkSession) -> tuple[PipelineModel, DataFrame]:
    return PipelineModel.load(f"{path}/model"), spark.read.json(f"{path}/metadata")

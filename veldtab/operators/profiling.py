"""Profiles, rules, contracts, column roles and metric choice. One scan each."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldtab.functions.columns import (
    FLOAT_TYPES, INTEGER_TYPES, NUMERIC_TYPES, long_form, name, numeric_columns, one_row_agg, reject_nested,
    require_columns,
)
from veldtab.functions.moments import pick_significant, unbiased_skewness
from veldtab.functions.ordering import column_quantiles


def _stack(one_row: DataFrame, labels: list[str], fields: dict[str, str], key: str) -> DataFrame:
    """One aggregate row ``prefix_i`` to one row per label."""
    structs = [F.struct(F.lit(label).alias(key),
                        *[F.col(f"{prefix}_{i}").alias(out) for prefix, out in fields.items()])
               for i, label in enumerate(labels)]
    return one_row.select("*", F.explode(F.array(*structs)).alias("_s")).select("_s.*", "rows")


def missing_by_column(df: DataFrame, target: str | None = None) -> DataFrame:
    """Null counts of the columns that have any, most first; one pass over the table."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(name(c).isNull()).alias(f"m_{i}") for i, c in enumerate(cols)])
    long = _stack(one, cols, {"m": "missing_count"}, "column")
    dtypes = F.create_map(*[F.lit(x) for c, t in df.dtypes for x in (c, t)])
    return (long.where("missing_count > 0")
            .select("column", "missing_count",
                    (F.col("missing_count") / F.greatest("rows", F.lit(1))).alias("missing_pct"),
                    (F.col("column") == F.lit(target or "")).alias("is_target"),
                    F.element_at(dtypes, F.col("column")).alias("dtype"))
            .orderBy(F.desc("missing_count"), "column"))


def missing_totals(df: DataFrame) -> DataFrame:
    cells = sum((name(c).isNull().cast("int") for c in df.columns[1:]), name(df.columns[0]).isNull().cast("int"))
    counted = df.select(cells.alias("_missing")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("_missing"), F.lit(0)).cast("bigint").alias("total_missing"),
        F.count_if(F.col("_missing") > 0).alias("rows_with_missing"))
    rows = F.greatest("rows", F.lit(1))
    return counted.select(
        "total_missing", (F.col("total_missing") / (rows * len(df.columns))).alias("missing_cells_pct"),
        "rows_with_missing", (F.col("rows_with_missing") / rows).alias("rows_with_missing_pct"))


@dataclass(frozen=True)
class Rule:
    """A named condition every row must meet; a null outcome counts as a failure."""

    name: str
    condition: Column = field(compare=False)
    column: str = "table-level"


def expect(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, column, n_failed, success) for all rules in one aggregate."""
    if not rules:
        raise ValueError("expect needs at least one rule")
    one = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[F.count_if(~F.coalesce(r.condition, F.lit(False))).alias(f"f_{i}") for i, r in enumerate(rules)])
    long = _stack(one, [r.name for r in rules], {"f": "n_failed"}, "rule")
    columns = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.column)])
    return long.select("rule", F.element_at(columns, F.col("rule")).alias("column"), "n_failed",
                       (F.col("n_failed") == 0).alias("success"))


def require(df: DataFrame, rules: list[Rule]) -> None:
    failed = [r["rule"] for r in expect(df, rules).where("not success").collect()]
    if failed:
        raise ValueError(f"validation failed for {len(failed)} rule(s): {failed}")


RANGE_PROBABILITIES = (0.001, 0.999)
MIN_RANGE_ROWS = 10


def infer_contract(df: DataFrame, target: str | None = None) -> DataFrame:
    """Contract table: column, type, nullability and, for numeric columns, a percentile range.

    The range is left out when the column has 10 or fewer values or the two ends meet.
    """
    numeric = numeric_columns(df)
    lo, hi = RANGE_PROBABILITIES
    bounds = (column_quantiles(df, numeric, [lo, hi])
              .where(F.col("group_rows") > MIN_RANGE_ROWS)
              .groupBy("feature")
              .agg(F.max(F.when(F.col("probability") == lo, pick_significant(F.col("quantile")))).alias("lo"),
                   F.max(F.when(F.col("probability") == hi, pick_significant(F.col("quantile")))).alias("hi"))
              .where("lo < hi"))
    kinds = [(f.name,
              "double" if isinstance(f.dataType, NUMERIC_TYPES) else f.dataType.simpleString(),
              f.name != target) for f in df.schema.fields]
    columns = df.sparkSession.createDataFrame(kinds, "column string, dtype string, nullable boolean")
    return (columns.join(bounds.withColumnRenamed("feature", "column"), "column", "left")
            .select("column", "dtype", "nullable", "lo", "hi"))


def check_contract(df: DataFrame, contract: DataFrame) -> DataFrame:
    """(column, check, violations) of every contract column in one pass over the data.

    The contract is one row per column, read to the driver so that its limits become literals.
    """
    rules = contract.collect()
    exprs, labels, absent = [], [], []
    for r in rules:
        c = r["column"]
        if c not in df.columns:
            absent.append((c, "missing_column", 1))
            continue
        if not r["nullable"]:
            labels.append((c, "not_nullable"))
            exprs.append(F.count_if(name(c).isNull()))
        if r["lo"] is not None:
            labels.append((c, "in_range"))
            exprs.append(F.count_if(~name(c).between(r["lo"], r["hi"])))
    schema = "column string, check string, violations bigint"
    spark = df.sparkSession
    out = spark.createDataFrame(absent, schema)
    if exprs:
        one = df.agg(*[e.alias(f"v_{i}") for i, e in enumerate(exprs)])
        found = one.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(k).alias("check"), F.col(f"v_{i}").alias("violations"))
            for i, (c, k) in enumerate(labels)])).alias("s")).select("s.*")
        out = found if not absent else found.unionByName(out)
    return out


def require_contract(df: DataFrame, contract: DataFrame, target: str) -> DataFrame:
    """Range violations are returned as warnings; nulls in the target stop the run."""
    report = check_contract(df, contract)
    nulls = report.where((F.col("column") == target) & (F.col("check") == "not_nullable")).collect()
    if nulls and nulls[0]["violations"]:
        raise ValueError(f"target column '{target}' contains {nulls[0]['violations']} null value(s)")
    return report.where("violations > 0")


MAX_SKEWNESS = 2.0


def target_skewness(df: DataFrame, target: str) -> DataFrame:
    """One row: skewness of the target and whether a log transform is worth a thought."""
    require_columns(df, [target])
    y = name(target).cast("double")
    return df.agg(F.count(y).alias("n_rows"), unbiased_skewness(y).alias("skewness")).select(
        "n_rows", "skewness",
        F.coalesce((F.col("n_rows") > 10) & (F.abs("skewness") > MAX_SKEWNESS), F.lit(False)).alias("suggest_log"))


@dataclass(frozen=True)
class FeatureRoles:
    numeric: tuple[str, ...] = ()
    one_hot: tuple[str, ...] = ()
    target_encoded: tuple[str, ...] = ()

    @property
    def all(self) -> list[str]:
        return [*self.numeric, *self.one_hot, *self.target_encoded]


def distinct_counts(df: DataFrame, cols: list[str], limit: int) -> dict[str, int]:
    """Distinct non-null values per column, exact wherever the answer is near or under ``limit``.

    A sketch of all columns in one pass finds those far above the limit; only the others, which have
    few values, are counted exactly, so no large set of distinct values is ever shuffled.
    """
    if not cols:
        return {}
    counts = one_row_agg(df, [F.approx_count_distinct(name(c), 0.05).alias(c) for c in cols])
    near = [c for c in cols if counts[c] <= 2 * limit]
    if near:
        exact = long_form(df, [], near, "string").where("value is not null").distinct().groupBy("feature").count()
        counts.update({r["feature"]: r["count"] for r in exact.collect()})
    return counts


def detect_roles(df: DataFrame, exclude: list[str] = (), *, cardinality_limit: int = 20,
                 target_encoding_threshold: int = 50) -> FeatureRoles:
    """Route columns by type and distinct count; nested columns are refused."""
    fields = [f for f in df.schema.fields if f.name not in set(exclude)]
    reject_nested(df, [f.name for f in fields])
    text = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    ints = [f.name for f in fields if isinstance(f.dataType, INTEGER_TYPES)]
    flags = [f.name for f in fields if isinstance(f.dataType, T.BooleanType)]
    floats = [f.name for f in fields if isinstance(f.dataType, (*FLOAT_TYPES, T.DecimalType))]
    present = one_row_agg(df, [F.count(name(c)).alias(c) for c in text + ints + flags + floats])
    live = lambda cols: [c for c in cols if present[c] > 0]
    counts = distinct_counts(df, live(text) + live(ints), max(cardinality_limit, target_encoding_threshold))
    return FeatureRoles(
        numeric=tuple([c for c in live(ints) if counts[c] > cardinality_limit] + live(floats)),
        one_hot=tuple([c for c in live(text) if counts[c] <= target_encoding_threshold]
                      + [c for c in live(ints) if counts[c] <= cardinality_limit] + live(flags)),
        target_encoded=tuple(c for c in live(text) if counts[c] > target_encoding_threshold))


def role_table(df: DataFrame, exclude: list[str] = (), **limits) -> DataFrame:
    roles = detect_roles(df, exclude, **limits)
    rows = ([(c, "numeric") for c in roles.numeric] + [(c, "one_hot") for c in roles.one_hot]
            + [(c, "target_encoded") for c in roles.target_encoded])
    return df.sparkSession.createDataFrame(rows, "column string, role string")


# Metric names and their properties.
PROBABILITY_METRICS = ("roc_auc", "auprc", "log_loss", "cross_entropy", "brier_score", "ece")
MINIMISED_METRICS = ("log_loss", "cross_entropy", "brier_score", "ece", "hamming_loss",
                     "mse", "rmse", "mae", "median_absolute_error")
WEIGHTED_METRICS = ("auprc", "brier_score", "ece")


def choose_metric(df: DataFrame, target: str, task: str = "classification", *, metric: str = "auto",
                  imbalance_threshold: float = 0.15) -> DataFrame:
    """One row: metric, direction, needs_probability, class_weight, from the class counts alone."""
    from veldtab.operators.metrics import CLASSIFICATION_METRICS, REGRESSION_METRICS

    if task == "regression":
        chosen = metric if metric in REGRESSION_METRICS else "r2"
        return df.sparkSession.range(1).select(
            F.lit(chosen).alias("metric"),
            F.lit("minimize" if chosen in MINIMISED_METRICS else "maximize").alias("direction"),
            F.lit(False).alias("needs_probability"), F.lit(None).cast("double").alias("class_weight"))
    counts = df.where(name(target).isNotNull()).groupBy(name(target)).agg(F.count("*").alias("n"))
    stats = counts.agg(F.count("*").alias("k"), F.min("n").alias("least"), F.max("n").alias("most"),
                       F.sum("n").alias("total"))
    share = lambda c: F.col(c) / F.col("total")
    uniform = 1.0 / F.col("k")
    deviation = F.greatest(F.abs(share("most") - uniform), F.abs(share("least") - uniform))
    auto = (F.when((F.col("k") == 2) & (share("least") >= imbalance_threshold), "roc_auc")
            .when(F.col("k") == 2, "auprc")
            .when(deviation < uniform * 0.5, "f1_macro").otherwise("f1_weighted"))
    chosen = F.lit(metric) if metric in CLASSIFICATION_METRICS else auto
    picked = stats.select(chosen.alias("metric"), (F.col("most") / F.greatest("least", F.lit(1))).alias("_w"))
    return picked.select(
        "metric", F.when(F.col("metric").isin(*MINIMISED_METRICS), "minimize").otherwise("maximize").alias("direction"),
        F.col("metric").isin(*PROBABILITY_METRICS).alias("needs_probability"),
        F.when(F.col("metric").isin(*WEIGHTED_METRICS), F.col("_w")).alias("class_weight"))

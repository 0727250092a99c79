"""The full reference/new drift report as one tidy table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veldtab.functions.jobs import in_parallel
from veldtab.functions.ordering import pin
from veldtab.operators import drift as D


def drift_report(ref: DataFrame, new: DataFrame, numeric: list[str], categorical: list[str], *, label: str | None = None,
                 segment_cols: list[str] = (), alpha: float = D.ALPHA) -> DataFrame:
    """(check_type, feature, detail, statistic, pvalue, drifted) for every check.

    Each part reads only the columns it needs; numeric and categorical parts shuffle counts.
    """
    def part(df: DataFrame, kind: str, feature, detail, statistic, pvalue, drifted) -> DataFrame:
        return df.select(F.lit(kind).alias("check_type"), feature.alias("feature"), detail.cast("string").alias("detail"),
                         statistic.cast("double").alias("statistic"), pvalue.cast("double").alias("pvalue"), drifted.alias("drifted"))

    none, c = F.lit(None), F.col
    features = [*dict.fromkeys([*numeric, *categorical])]
    a, b = ref.select(*[x for x in features if x in ref.columns]), new.select(*[x for x in features if x in new.columns])
    limit = max(0.05, alpha)
    checks: list[Callable[[], DataFrame]] = [
        lambda: part(D.numeric_drift(ref, new, numeric, alpha), "numeric", c("feature"), none, c("statistic"), c("pvalue"), c("drifted")),
        lambda: part(D.categorical_drift(ref, new, categorical, alpha), "categorical", c("feature"), none, c("statistic"), c("pvalue"), c("drifted")),
        lambda: part(D.quality_drift(a, b, alpha).where("changed or all_null_new"), "missing_rate", c("column"),
                     F.when(c("all_null_new"), "all null"), c("delta"), none, F.lit(True)),
        lambda: part(D.duplicate_change(a, b), "duplicate_rate", F.lit("*"), none, c("delta"), none, F.abs("delta") >= limit),
        lambda: part(D.schema_skew(D.schema_table(ref), D.schema_table(new)), "schema", c("column"), c("problem"), none, none, F.lit(True))]
    if label:
        checks.append(lambda: part(D.label_drift(ref, new, label, alpha), "label", F.lit(label), none, c("statistic"), c("pvalue"),
                                   F.coalesce("drift_detected", F.lit(False))))
        checks.append(lambda: part(D.novel_classes(ref, new, label).select(F.explode("novel_classes").alias("feature")),
                                   "novel_class", c("feature"), none, none, none, F.lit(True)))
    if segment_cols:
        checks.append(lambda: part(D.segment_drift(ref, new, numeric, list(segment_cols), alpha), "segment", c("feature"),
                                   F.concat_ws("=", "segment_column", "segment_value"), c("statistic"), c("pvalue"), c("drifted")))
    # One row per feature or segment each; the checks are independent jobs.
    return reduce(DataFrame.unionByName, in_parallel(lambda check: pin(check()), checks, len(checks)))


def any_drift(report: DataFrame) -> DataFrame:
    return report.agg(F.coalesce(F.bool_or("drifted"), F.lit(False)).alias("any_drift"))

"""Drift between a reference table and new data: distribution, label, quality, schema, segment.

Both sides are reduced to counts first (with map-side combine), and the tests work on counts. No
test repeats the reference per segment or batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldtab.functions.columns import long_form, name
from veldtab.functions.distributions import chi2_sf, ks_pvalue
from veldtab.functions.ordering import prefix_sum

ALPHA = 0.05
# Share added to every reference category so that a category new to the reference has an expectation.
SMOOTHING = 1e-6
MIN_SEGMENT_ROWS = 20
MIN_SEGMENT_VALUES = 10


def finite(c: Column) -> Column:
    """Null for null, NaN and infinite values."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def numeric_long(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys, feature, value) without missing values."""
    return (long_form(df, list(keys), cols, "double")
            .withColumn("value", finite(F.col("value"))).where("value is not null"))


def category_long(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    return long_form(df, list(keys), cols, "string", value="category").where("category is not null")


def value_counts(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys, feature, value, n)."""
    return numeric_long(df, cols, keys).groupBy(*[name(k) for k in keys], "feature", "value").agg(F.count("*").alias("n"))


def category_counts(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """(keys, feature, category, n)."""
    return category_long(df, cols, keys).groupBy(*[name(k) for k in keys], "feature", "category").agg(F.count("*").alias("n"))


def _one(v: int) -> Column:
    return F.lit(v).cast("bigint")


# -- numeric columns -----------------------------------------------------------------------------

def ks_pairs(ref: DataFrame, new: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """Two-sample test per (keys, feature), each group against the same group of the reference.

    Columns: keys, feature, n_ref, n_new, statistic, pvalue. Groups empty on one side are left out.
    """
    keys = list(keys)
    both = (numeric_long(ref, cols, keys).withColumns({"n_ref": _one(1), "n_new": _one(0)})
            .unionByName(numeric_long(new, cols, keys).withColumns({"n_ref": _one(0), "n_new": _one(1)})))
    group = [*keys, "feature"]
    sums = prefix_sum(both, group, "value", ["n_ref", "n_new"])
    gap = F.abs((F.col("below_n_ref") + F.col("n_ref")) / F.nullif("total_n_ref", F.lit(0))
                - (F.col("below_n_new") + F.col("n_new")) / F.nullif("total_n_new", F.lit(0)))
    stats = sums.groupBy(*[name(k) for k in group]).agg(
        F.max("total_n_ref").alias("n_ref"), F.max("total_n_new").alias("n_new"), F.max(gap).alias("statistic"))
    return (stats.where("n_ref > 0 and n_new > 0")
            .withColumn("pvalue", ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_new"))))


def ks_against(reference: DataFrame, new: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """Two-sample test of every (keys, feature) group of ``new`` against one shared reference.

    ``reference`` is (feature, value, n). The distance is largest at, or just below, a value of the
    new group, so the reference is ranked once over all values and joined to the groups' values.
    """
    return ks_counts(reference, value_counts(new, cols, keys), keys)


def ks_counts(reference: DataFrame, counted: DataFrame, keys: list[str] = ()) -> DataFrame:
    """``ks_against`` from counts (keys, feature, value, n) of the new data."""
    keys = list(keys)
    ranked_new = prefix_sum(counted.select(*[name(k) for k in keys], "feature", "value", "n"),
                            [*keys, "feature"], "value", ["n"])
    points = (reference.select("feature", "value", F.col("n").alias("r"))
              .unionByName(counted.select("feature", "value", _one(0).alias("r"))))
    ranked_ref = prefix_sum(points, ["feature"], "value", ["r"])
    joined = ranked_new.join(ranked_ref, ["feature", "value"]).where("total_r > 0")
    at = F.abs((F.col("below_r") + F.col("r")) / F.col("total_r") - (F.col("below_n") + F.col("n")) / F.col("total_n"))
    before = F.abs(F.col("below_r") / F.col("total_r") - F.col("below_n") / F.col("total_n"))
    return (joined.groupBy(*[name(k) for k in keys], "feature")
            .agg(F.max("total_r").alias("n_ref"), F.max("total_n").alias("n_new"),
                 F.max(F.greatest(at, before)).alias("statistic"))
            .withColumn("pvalue", ks_pvalue(F.col("statistic"), F.col("n_ref"), F.col("n_new"))))


def numeric_drift(ref: DataFrame, new: DataFrame, cols: list[str], alpha: float = ALPHA) -> DataFrame:
    """(feature, n_ref, n_new, statistic, pvalue, drifted)."""
    shared = [c for c in cols if c in ref.columns and c in new.columns]
    return ks_pairs(ref, new, shared).withColumn("drifted", F.col("pvalue") < alpha)


# -- categorical columns -------------------------------------------------------------------------

def _with_reference(reference: DataFrame, counted: DataFrame) -> DataFrame:
    """New counts ``o`` next to reference counts ``r`` (null for a category the reference lacks)."""
    ref = reference.select("feature", "category", F.col("n").alias("r"))
    return counted.withColumnRenamed("n", "o").join(ref, ["feature", "category"], "left")


def chi2_shared(reference: DataFrame, counted: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Test over the categories both sides have; groups with fewer than two are left out.

    sum((o-e)^2/e) with e = r*N/R equals R/N * sum(o^2/r) - N, so one aggregate is enough.
    """
    o, r = F.col("o").cast("double"), F.col("r").cast("double")
    sums = (_with_reference(reference, counted).where("r > 0")
            .groupBy(*[name(k) for k in keys], "feature")
            .agg(F.sum("r").alias("total_ref"), F.sum("o").alias("total_new"),
                 F.sum(o * o / r).alias("_s"), F.count("*").alias("categories"))
            .where("categories >= 2"))
    stat = F.greatest(F.lit(0.0), F.col("total_ref") / F.col("total_new") * F.col("_s") - F.col("total_new"))
    return _chi2_result(sums, stat, keys)


def chi2_union(reference: DataFrame, counted: DataFrame, keys: list[str] = (), smoothing: float = SMOOTHING) -> DataFrame:
    """Test over the union of categories with a smoothed reference; needs two categories.

    Categories without new rows only enter through the reference total, so they are never joined.
    """
    o = F.col("o").cast("double")
    totals = reference.groupBy("feature").agg(F.sum("n").alias("_ref"), F.count("*").alias("_k"))
    sums = (_with_reference(reference, counted)
            .groupBy(*[name(k) for k in keys], "feature")
            .agg(F.sum("o").alias("total_new"), F.count_if(F.col("r").isNull()).alias("_novel"),
                 F.sum(o * o / (F.coalesce("r", F.lit(0)) + F.lit(smoothing))).alias("_s"))
            .join(totals, "feature")
            .withColumn("categories", F.col("_k") + F.col("_novel")).where("categories >= 2")
            .withColumn("total_ref", F.col("_ref")))
    smoothed = F.col("_ref") + F.col("categories") * smoothing
    stat = F.greatest(F.lit(0.0), smoothed / F.col("total_new") * F.col("_s") - F.col("total_new"))
    return _chi2_result(sums, stat, keys)


def _chi2_result(sums: DataFrame, stat: Column, keys: list[str]) -> DataFrame:
    return (sums.withColumn("statistic", stat)
            .select(*[name(k) for k in keys], "feature", "total_ref", "total_new", "categories", "statistic",
                    chi2_sf(F.col("statistic"), F.col("categories") - 1).alias("pvalue")))


def categorical_drift(ref: DataFrame, new: DataFrame, cols: list[str], alpha: float = ALPHA, *,
                      union: bool = False) -> DataFrame:
    """(feature, total_ref, total_new, categories, statistic, pvalue, drifted)."""
    shared = [c for c in cols if c in ref.columns and c in new.columns]
    test = chi2_union if union else chi2_shared
    return test(category_counts(ref, shared), category_counts(new, shared)).withColumn("drifted", F.col("pvalue") < alpha)


def unseen_categories(reference: DataFrame, counted: DataFrame) -> DataFrame:
    """(feature, category, n) of categories the reference does not have."""
    return counted.join(reference.select("feature", "category"), ["feature", "category"], "left_anti")


def novel_categories(ref: DataFrame, new: DataFrame, cols: list[str]) -> DataFrame:
    return unseen_categories(category_counts(ref, cols), category_counts(new, cols))


# -- labels --------------------------------------------------------------------------------------

def label_drift(ref: DataFrame, new: DataFrame, label: str, alpha: float = ALPHA) -> DataFrame:
    """One row: statistic, p-value and both label distributions as maps (one entry per class)."""
    a, b = category_counts(ref, [label]), category_counts(new, [label])
    test = chi2_union(a, b).select("statistic", "pvalue", (F.col("pvalue") < alpha).alias("drift_detected"))
    both = (a.withColumnRenamed("n", "n_ref").join(b.withColumnRenamed("n", "n_new"), ["feature", "category"], "full_outer"))
    as_map = lambda c: F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("category", F.coalesce(F.col(c), _one(0)).alias("n")))))
    maps = both.agg(as_map("n_ref").alias("reference_distribution"), as_map("n_new").alias("new_distribution"))
    return maps.join(test, how="left")


def novel_classes(ref: DataFrame, new: DataFrame, label: str) -> DataFrame:
    """One row: classes only the new data has, and the number of classes on both sides."""
    a, b = category_counts(ref, [label]), category_counts(new, [label])
    both = (a.select("category", F.lit(1).alias("in_ref"), F.lit(0).alias("in_new"))
            .unionByName(b.select("category", F.lit(0).alias("in_ref"), F.lit(1).alias("in_new")))
            .groupBy("category").agg(F.max("in_ref").alias("in_ref"), F.max("in_new").alias("in_new")))
    novel = F.when((F.col("in_new") == 1) & (F.col("in_ref") == 0), F.col("category"))
    return both.agg(F.array_sort(F.collect_list(novel)).alias("novel_classes"),
                    F.sum("in_ref").cast("bigint").alias("reference_class_count"),
                    F.sum("in_new").cast("bigint").alias("new_class_count"))


# -- quality and schema --------------------------------------------------------------------------

def column_quality(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """(keys, column, rows, missing_rate, all_null, constant), one pass."""
    cols = [c for c in df.columns if c not in set(keys)]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(name(c)).alias(f"n_{i}"), F.min(name(c)).alias(f"lo_{i}"), F.max(name(c)).alias(f"hi_{i}")]
    one = df.groupBy(*[name(k) for k in keys]).agg(*aggs)
    structs = [F.struct(
        F.lit(c).alias("column"), (1 - F.col(f"n_{i}") / F.nullif("rows", F.lit(0))).alias("missing_rate"),
        (F.col(f"n_{i}") == 0).alias("all_null"),
        F.coalesce(F.col(f"lo_{i}") == F.col(f"hi_{i}"), F.lit(True)).alias("constant")) for i, c in enumerate(cols)]
    return (one.select(*[name(k) for k in keys], "rows", F.explode(F.array(*structs)).alias("s"))
            .select(*[name(k) for k in keys], "s.column", "rows", "s.missing_rate", "s.all_null", "s.constant"))


def duplicate_rate(df: DataFrame) -> DataFrame:
    """One row: share of rows that repeat an earlier row.

    Rows are compared by 128 bits of hash over all values and null flags, so the shuffle carries
    16 bytes per distinct row whatever the width of the table.
    """
    cols = [name(c) for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    hashed = df.select(F.xxhash64(F.lit(1), nulls, *cols).alias("_a"), F.xxhash64(nulls, *reversed(cols)).alias("_b"))
    per_row = hashed.groupBy("_a", "_b").agg(F.count("*").alias("_n"))
    return per_row.agg((1 - F.count("*") / F.nullif(F.sum("_n"), F.lit(0))).alias("duplicate_rate"))


def duplicate_change(ref: DataFrame, new: DataFrame) -> DataFrame:
    """One row: both duplicate rates and their difference."""
    rates = duplicate_rate(ref).withColumnRenamed("duplicate_rate", "duplicate_rate_reference").crossJoin(
        duplicate_rate(new).withColumnRenamed("duplicate_rate", "duplicate_rate_new"))  # one row by one row
    return rates.withColumn("delta", F.col("duplicate_rate_new") - F.col("duplicate_rate_reference"))


def quality_drift(ref: DataFrame, new: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(column, reference_missing_rate, new_missing_rate, delta, changed, all_null_new, constant_new)."""
    a = column_quality(ref).select("column", F.col("missing_rate").alias("reference_missing_rate"))
    b = column_quality(new).select("column", F.col("missing_rate").alias("new_missing_rate"),
                                   F.col("all_null").alias("all_null_new"), F.col("constant").alias("constant_new"))
    delta = F.col("new_missing_rate") - F.col("reference_missing_rate")
    return b.join(a, "column", "left").withColumn("delta", delta).withColumn(
        "changed", F.coalesce(F.abs(delta) >= max(0.05, alpha), F.lit(False)))


def quality_summary(ref: DataFrame, new: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """One row with the flag; constant columns are listed but do not set it."""
    per_column = quality_drift(ref, new, alpha)
    listed = lambda cond: F.array_sort(F.collect_list(F.when(F.col(cond), F.col("column"))))
    one = per_column.agg(listed("changed").alias("missing_rate_changes"), listed("all_null_new").alias("all_null_columns_new"),
                         listed("constant_new").alias("constant_columns_new"))
    rates, delta = duplicate_change(ref, new), F.col("delta")
    limit = max(0.05, alpha)
    return one.crossJoin(rates).select(  # one row by one row
        ((F.size("missing_rate_changes") > 0) | (F.size("all_null_columns_new") > 0) | (F.abs(delta) >= limit)).alias("drift_detected"),
        "missing_rate_changes", "all_null_columns_new", "constant_columns_new",
        "duplicate_rate_reference", "duplicate_rate_new", delta.alias("duplicate_rate_delta"))


def schema_table(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def schema_skew(ref_schema: DataFrame, new_schema: DataFrame) -> DataFrame:
    """(column, reference_dtype, new_dtype, problem) for missing, extra and retyped columns."""
    a = ref_schema.withColumnRenamed("dtype", "reference_dtype")
    b = new_schema.withColumnRenamed("dtype", "new_dtype")
    problem = (F.when(F.col("new_dtype").isNull(), "missing").when(F.col("reference_dtype").isNull(), "extra")
               .when(F.col("reference_dtype") != F.col("new_dtype"), "retyped"))
    return a.join(b, "column", "full_outer").withColumn("problem", problem).where("problem is not null")


# -- segments ------------------------------------------------------------------------------------

def _segments(df: DataFrame, cols: list[str], segment_cols: list[str]) -> DataFrame:
    """Numeric columns with one row per segment column: (segment_column, segment, cols...)."""
    # The source is scanned once: each row is repeated per segment column.
    pairs = F.array(*[F.struct(F.lit(s).alias("c"), name(s).cast("string").alias("v")) for s in segment_cols])
    return (df.select(F.explode(pairs).alias("_s"), *[name(c) for c in cols])
            .select(F.col("_s.c").alias("segment_column"), F.col("_s.v").alias("segment_value"), *[name(c) for c in cols])
            .where("segment_value is not null"))


SEGMENT_KEYS = ["segment_column", "segment_value"]


def _big_segments(segmented: DataFrame, keys: list[str]) -> DataFrame:
    return (segmented.groupBy(*[name(k) for k in keys]).agg(F.count("*").alias("_rows"))
            .where(F.col("_rows") >= MIN_SEGMENT_ROWS).drop("_rows"))


def segment_drift(ref: DataFrame, new: DataFrame, cols: list[str], segment_cols: list[str], alpha: float = ALPHA) -> DataFrame:
    """(segment_column, segment_value, feature, n_ref, n_new, statistic, pvalue, drifted), same segment
    on both sides. Segments under 20 rows and features under 10 values on a side are left out."""
    a, b = _segments(ref, cols, segment_cols), _segments(new, cols, segment_cols)
    big = _big_segments(a, SEGMENT_KEYS).join(_big_segments(b, SEGMENT_KEYS), SEGMENT_KEYS, "left_semi")
    tested = ks_pairs(a, b, cols, SEGMENT_KEYS).where(
        (F.col("n_ref") >= MIN_SEGMENT_VALUES) & (F.col("n_new") >= MIN_SEGMENT_VALUES))
    return tested.join(big, SEGMENT_KEYS, "left_semi").withColumn("drifted", F.col("pvalue") < alpha)


def segment_drift_against(reference: DataFrame, new: DataFrame, cols: list[str], segment_cols: list[str],
                          alpha: float = ALPHA, keys: list[str] = ()) -> DataFrame:
    """As above with every segment of ``new`` against the whole reference (feature, value, n)."""
    keys = list(keys)
    pairs = F.array(*[F.struct(F.lit(s).alias("c"), name(s).cast("string").alias("v")) for s in segment_cols])
    b = (new.select(*[name(k) for k in keys], F.explode(pairs).alias("_s"), *[name(c) for c in cols])
         .select(*[name(k) for k in keys], F.col("_s.c").alias("segment_column"), F.col("_s.v").alias("segment_value"),
                 *[name(c) for c in cols]).where("segment_value is not null"))
    group = [*keys, *SEGMENT_KEYS]
    tested = ks_against(reference, b, cols, group).where(F.col("n_new") >= MIN_SEGMENT_VALUES)
    return tested.join(_big_segments(b, group), group, "left_semi").withColumn("drifted", F.col("pvalue") < alpha)


def drifted_segments(tested: DataFrame, keys: list[str] = ()) -> DataFrame:
    """One row per segment with drift and its drifted features by name (one entry per column at most)."""
    listed = F.array_sort(F.collect_list(F.struct("feature", "pvalue")))
    return (tested.where("drifted").groupBy(*[name(k) for k in keys], *SEGMENT_KEYS)
            .agg(listed.alias("drifted_features"), F.count("*").alias("n_drifted")))


# -- decisions -----------------------------------------------------------------------------------

DROP_BELOW = 0.01


def drift_actions(pvalues: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """(feature, pvalue, action): drop below .01, flag below alpha, keep the rest."""
    p = F.col("pvalue")
    return pvalues.select("feature", "pvalue",
                          F.when(p < DROP_BELOW, "drop").when(p < alpha, "flag").otherwise("keep").alias("action"))


def drop_drifted(df: DataFrame, actions: DataFrame) -> tuple[DataFrame, list[str]]:
    """Drop the columns marked ``drop``; the list is at most one entry per column."""
    cols = sorted(r["feature"] for r in actions.where("action = 'drop'").select("feature").collect())
    return df.drop(*cols), cols

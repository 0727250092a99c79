"""Tables behind the usual diagnostic charts that need only scored rows or plain columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldtab.functions.columns import name
from veldtab.functions.ordering import segmented_scan
from veldtab.operators.metrics import score_counts
from veldtab.operators.prep import correlation_pairs


def _reached(counts: DataFrame) -> DataFrame:
    """True and false positives when every score at or above a threshold is positive."""
    return counts.select(
        F.col("p").alias("threshold"), (F.col("total_pos") - F.col("below_pos")).alias("tp"),
        (F.col("total_neg") - F.col("below_neg")).alias("fp"), "total_pos", "total_neg")


def pr_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, precision, recall), one row per distinct score."""
    return _reached(score_counts(df, y, p)).select(
        "threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.nullif("total_pos", F.lit(0))).alias("recall"))


def operating_point(df: DataFrame, threshold: float, y: str = "y", p: str = "p") -> DataFrame:
    """The curve point nearest to a threshold (lower one on ties), and the share of positives."""
    points = _reached(score_counts(df, y, p))
    row = F.struct("threshold", "tp", "fp", "total_pos", "total_neg")
    near = points.agg(F.min_by(row, F.struct(F.abs(F.col("threshold") - float(threshold)), "threshold")).alias("s")).select("s.*")
    return near.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                       (F.col("tp") / F.nullif("total_pos", F.lit(0))).alias("recall"),
                       (F.col("total_pos") / (F.col("total_pos") + F.col("total_neg"))).alias("baseline"))


def roc_curve(df: DataFrame, y: str = "y", p: str = "p") -> DataFrame:
    """(threshold, fpr, tpr), one row per distinct score."""
    return _reached(score_counts(df, y, p)).select(
        "threshold", (F.col("fp") / F.nullif("total_neg", F.lit(0))).alias("fpr"),
        (F.col("tp") / F.nullif("total_pos", F.lit(0))).alias("tpr"))


def equal_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0..bins-1 with the upper end in the last bin."""
    width = F.nullif((hi - lo) / bins, F.lit(0.0))
    return F.coalesce(F.least(F.floor((x - lo) / width), F.lit(bins - 1)), F.lit(0)).cast("int")


def residual_histogram(df: DataFrame, y: str = "y", yhat: str = "yhat", bins: int = 60) -> DataFrame:
    """(bin, lower, upper, n) of y - yhat over its range."""
    e = df.select((name(y) - name(yhat)).alias("_e")).where("_e is not null")
    span = e.agg(F.min("_e").alias("_lo"), F.max("_e").alias("_hi"))
    placed = e.crossJoin(F.broadcast(span)).select(  # one row
        equal_bin(F.col("_e"), F.col("_lo"), F.col("_hi"), bins).alias("bin"), "_lo", "_hi")
    width = (F.col("_hi") - F.col("_lo")) / bins
    return (placed.groupBy("bin", "_lo", "_hi").agg(F.count("*").alias("n"))
            .select("bin", (F.col("_lo") + F.col("bin") * width).alias("lower"),
                    (F.col("_lo") + (F.col("bin") + 1) * width).alias("upper"), "n"))


def reliability(df: DataFrame, y: str = "y", p: str = "p", bins: int = 10, variant: str | None = None) -> DataFrame:
    """(variant, bin, n, fraction_positive, mean_predicted); an edge belongs to the lower bin."""
    step = 1.0 / bins
    b = reduce(Column.__add__, [(name(p) > i * step).cast("int") for i in range(1, bins)])
    keys = [name(variant)] if variant else []
    return df.where(name(p).isNotNull()).groupBy(*keys, b.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(name(y).cast("double")).alias("fraction_positive"), F.avg(name(p)).alias("mean_predicted"))


def correlation_table(df: DataFrame, cols: list[str], keep: int | None = None) -> DataFrame:
    """Lower triangle (a, b, corr) of all columns, or of the ``keep`` ones with the largest mean absolute correlation."""
    pairs = correlation_pairs(df, cols)
    sides = pairs.select(F.explode(F.array("a", "b")).alias("column"), F.abs("corr").alias("r"))
    chosen = sides.groupBy("column").agg(F.avg("r").alias("m")).orderBy(F.desc("m"), "column").limit(len(cols) if keep is None else keep).select("column")
    lower = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    kept = (lower.join(F.broadcast(chosen.withColumnRenamed("column", "a")), "a", "left_semi")
            .join(F.broadcast(chosen.withColumnRenamed("column", "b")), "b", "left_semi"))
    diagonal = chosen.select(F.col("column").alias("a"), F.col("column").alias("b"), F.lit(1.0).alias("corr"))
    return kept.select("a", "b", "corr").unionByName(diagonal)


def pixel_counts(df: DataFrame, x: str, y: str, width: int = 800, height: int = 600, value: str | None = None,
                 category: str | None = None, pad: float = 0.03) -> DataFrame:
    """(px, py, [category,] n, [mean]) of a scatter on a grid over the padded ranges; one shuffle of cells."""
    cols = [name(x).cast("double").alias("_x"), name(y).cast("double").alias("_y")]
    cols += [name(value).cast("double").alias("_v")] if value else []
    cols += [name(category).alias(category)] if category else []
    points = df.select(*cols).where("_x is not null and _y is not null")
    limits = points.agg(*[f(c).alias(f"{n}{c}") for c in ("_x", "_y") for n, f in (("lo", F.min), ("hi", F.max))])

    def cell(c: str, size: int) -> Column:
        span = F.col(f"hi{c}") - F.col(f"lo{c}")
        span = F.when(span == 0, F.lit(1.0)).otherwise(span)
        lo = F.col(f"lo{c}") - pad * span
        return F.least(F.floor((F.col(c) - lo) / (span * (1 + 2 * pad)) * size), F.lit(size - 1)).cast("int")

    placed = points.crossJoin(F.broadcast(limits))  # one row
    aggs = [F.count("*").alias("n")] + ([F.avg("_v").alias("mean")] if value else [])
    keys = [cell("_x", width).alias("px"), cell("_y", height).alias("py")] + ([name(category)] if category else [])
    return placed.groupBy(*keys).agg(*aggs)


def running_best(trials: DataFrame, trial: str = "trial", score: str = "score") -> DataFrame:
    """Best score so far per trial, by ascending trial."""
    scanned = segmented_scan(trials.select(name(trial), name(score)), [], trial, high=name(score))
    return scanned.select(name(trial), name(score), F.col("_high").alias("best_so_far"))


def parameter_impact(trials: DataFrame, params: list[str], score: str = "score") -> DataFrame:
    """(parameter, corr, rank) of each parameter with the score, strongest first."""
    one = trials.agg(*[F.corr(name(p).cast("double"), name(score)).alias(f"r_{i}") for i, p in enumerate(params)])
    rows = F.array(*[F.struct(F.lit(p).alias("parameter"), F.coalesce(F.col(f"r_{i}"), F.lit(0.0)).alias("corr")) for i, p in enumerate(params)])
    long = one.select(F.explode(rows).alias("s")).select("s.*")
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc(F.abs("corr")), "parameter")  # one row per parameter
    return long.withColumn("rank", F.row_number().over(order))

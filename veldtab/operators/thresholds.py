"""Decision thresholds for binary scores.

Scores at many thresholds come from one histogram over the candidate intervals (about 200 rows) and
running sums over it; rows are never compared with every candidate.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veldtab.functions.columns import name
from veldtab.functions.moments import ratio
from veldtab.functions.ordering import exact_quantiles

# Halving steps of the candidate search: arrays of up to 4095 candidates.
SEARCH_STEPS = tuple(2 ** k for k in range(11, -1, -1))
MAX_CANDIDATES = 4095
MODES = ("f1", "fbeta", "precision_at_recall", "recall_at_precision", "disabled")


@dataclass(frozen=True)
class ThresholdPolicy:
    mode: str = "auto"
    beta: float = 1.0
    min_precision: float = 0.80
    min_recall: float = 0.80
    n_quantiles: int = 200

    def resolved(self, metric: str | None = None) -> "ThresholdPolicy":
        """Replace ``auto``: f1 when the metric ranks (or is unknown), else no tuning."""
        mode = self.mode.lower()
        if mode == "auto":
            mode = "f1" if metric in (None, "roc_auc", "auprc") else "disabled"
        if mode not in MODES:
            raise ValueError(f"threshold mode must be 'auto' or one of {MODES}, got '{self.mode}'")
        return replace(self, mode=mode)

    def as_dict(self) -> dict:
        return asdict(self)


def candidate_thresholds(df: DataFrame, p: str = "p", n_quantiles: int = 200) -> DataFrame:
    """Distinct interior quantiles of the score plus one half, inside [0, 1]: column ``threshold``."""
    n = max(1, n_quantiles)
    if n >= MAX_CANDIDATES:
        raise ValueError(f"at most {MAX_CANDIDATES - 1} quantiles")
    probabilities = [i / (n + 1) for i in range(1, n + 1)]
    quantiles = exact_quantiles(df.select(name(p).cast("double").alias("_p")), [], "_p", probabilities)
    half = df.sparkSession.range(1).select(F.lit(0.5).alias("threshold"))
    return (quantiles.select(F.col("quantile").alias("threshold")).unionByName(half)
            .where("threshold between 0 and 1").distinct())


def threshold_scores(df: DataFrame, candidates: DataFrame, y: str = "y", p: str = "p", beta: float = 1.0) -> DataFrame:
    """(threshold, precision, recall, f1, fbeta, support) at every candidate.

    ``candidates`` is at most a few hundred rows, held as one sorted array next to every row.
    """
    listed = candidates.agg(F.array_sort(F.collect_list("threshold")).alias("_cuts"))
    too_many = F.raise_error(F.lit(f"more than {MAX_CANDIDATES} candidate thresholds"))
    listed = listed.select(F.when(F.size("_cuts") <= MAX_CANDIDATES, F.col("_cuts")).otherwise(too_many).alias("_cuts"))
    p_col = F.col("_p")
    binned = (df.select(name(p).cast("double").alias("_p"), (name(y) == 1).cast("bigint").alias("_pos"))
              .where(p_col.isNotNull())
              .crossJoin(F.broadcast(listed)))  # one row of candidates
    # Number of candidates not above the score, by halving steps over the sorted array.
    steps = F.array(*[F.lit(v) for v in SEARCH_STEPS])
    reached = F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(
        F.try_element_at(F.col("_cuts"), at + step) <= p_col, step).otherwise(F.lit(0)))
    binned = binned.select(reached.alias("_bin"), "_pos")
    histogram = binned.groupBy("_bin").agg(F.sum("_pos").alias("_pos"), F.count("*").alias("_n"))
    by_cut = (listed.select(F.posexplode("_cuts").alias("_i", "threshold"))
              .select((F.col("_i") + 1).alias("_bin"), "threshold"))
    rows = (histogram.join(by_cut, "_bin", "full_outer")
            .select("_bin", "threshold", F.coalesce("_pos", F.lit(0)).alias("_pos"), F.coalesce("_n", F.lit(0)).alias("_n")))
    # A few hundred rows: one per candidate interval.
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(0))
    counted = rows.select("threshold", F.sum("_pos").over(down).alias("tp"), F.sum("_n").over(down).alias("support"),
                          F.sum("_pos").over(whole).alias("positives")).where("threshold is not null")
    return _scored(counted, beta)


def _scored(counted: DataFrame, beta: float) -> DataFrame:
    precision, recall = ratio(F.col("tp"), F.col("support")), ratio(F.col("tp"), F.col("positives"))
    b2 = float(beta) ** 2
    return counted.select(
        "threshold", precision.alias("precision"), recall.alias("recall"),
        ratio(2.0 * precision * recall, precision + recall).alias("f1"),
        ratio((1 + b2) * precision * recall, b2 * precision + recall).alias("fbeta"),
        F.col("support").cast("bigint").alias("support"))


def fixed_threshold_scores(df: DataFrame, threshold: float, y: str = "y", p: str = "p", beta: float = 1.0) -> DataFrame:
    hit = name(p) >= float(threshold)
    counted = df.where(name(p).isNotNull()).agg(
        F.lit(float(threshold)).alias("threshold"), F.count_if(hit & (name(y) == 1)).alias("tp"),
        F.count_if(hit).alias("support"), F.count_if(name(y) == 1).alias("positives"))
    return _scored(counted, beta)


def tune_threshold(df: DataFrame, policy: ThresholdPolicy = ThresholdPolicy(), metric: str | None = None,
                   y: str = "y", p: str = "p", scores: DataFrame | None = None) -> DataFrame:
    """One row: the chosen threshold, its scores, the objective and F1 at one half.

    ``scores`` (``threshold_scores`` with the same beta) spares the pass when several policies compete.
    """
    policy = policy.resolved(metric)
    plain = fixed_threshold_scores(df, 0.5, y, p, 1.0)
    if policy.mode == "disabled":
        return plain.select("*", F.col("f1").alias("objective"), F.col("f1").alias("f1_at_half"))
    if scores is None:
        scores = threshold_scores(df, candidate_thresholds(df, p, policy.n_quantiles), y, p, policy.beta)
    order = {"f1": ("f1", None, None), "fbeta": ("fbeta", None, None),
             "precision_at_recall": ("precision", "recall", policy.min_recall),
             "recall_at_precision": ("recall", "precision", policy.min_precision)}
    objective, second, floor = order[policy.mode]
    ranking = [F.desc(objective), F.desc("threshold")]
    if second:
        # Qualified candidates first; without any, all compete.
        ranking = [F.desc(name(second) >= floor), F.desc(objective), F.desc(second), F.desc("threshold")]
    best = scores.orderBy(*ranking).limit(1).withColumn("objective", name(objective))
    half = plain.select(F.col("f1").alias("f1_at_half"))
    return best.crossJoin(F.broadcast(half))  # one row by one row


def threshold_sweep(df: DataFrame, y: str = "y", p: str = "p", steps: int = 100) -> DataFrame:
    """Scores at evenly spaced thresholds from .01 to .99."""
    spark = df.sparkSession
    grid = spark.range(steps).select((0.01 + F.col("id") * (0.98 / (steps - 1))).alias("threshold"))
    return threshold_scores(df, grid, y, p)


def apply_threshold(df: DataFrame, threshold: float, p: str = "p", out: str = "pred") -> DataFrame:
    return df.withColumn(out, (name(p) >= float(threshold)).cast("int"))


def error_rows(df: DataFrame, threshold: float, y: str = "y", p: str = "p", labels: list | None = None) -> DataFrame:
    """False positives and negatives with confidence, margin and raw score.

    The table is as large as the number of errors; sort it (``by_confidence``) only for a report.
    """
    pred = (name(p) >= float(threshold)).cast("int")
    scored = df.withColumn("pred_label", pred).withColumn("true_label", name(y).cast("int"))
    wrong = scored.where(F.col("pred_label") != F.col("true_label")).withColumns({
        "error_type": F.when(F.col("pred_label") == 1, "FP").otherwise("FN"),
        "confidence": F.when(F.col("pred_label") == 1, name(p)).otherwise(1 - name(p)),
        "margin": F.abs(name(p) - float(threshold)), "raw_proba": name(p)})
    if labels is None:
        return wrong
    values = F.array(*[F.lit(v) for v in labels])
    return wrong.withColumns({c: F.element_at(values, name(c) + 1) for c in ("true_label", "pred_label")})


def by_confidence(errors: DataFrame) -> DataFrame:
    return errors.orderBy(F.desc("confidence"))

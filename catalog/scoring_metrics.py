"""D, G, H, J and L1-L4: splits, metrics, thresholds, conformal sets, curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_BIN, SQL_MULTI, SQL_REG, query, r, rounded, scored_bin, scored_multi, scored_reg, table
from veldtab.functions.ordering import pin
from veldtab.operators import curves as L
from veldtab.operators import metrics as M
from veldtab.operators import splits as S
from veldtab.operators import thresholds as H
from veldtab.operators import uncertainty as U

# Order key and line number repeat in this data; with part and supplier the key is unique.
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
SQL_KEYED = """
k AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS c, l_shipdate,
             substr(md5('{seed}:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey), 1, 15) AS h FROM lineitem),
ranked AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY h) AS rk, count(*) OVER (PARTITION BY c) AS n,
                  row_number() OVER (ORDER BY h) AS all_rk, count(*) OVER () AS all_n FROM k)
"""
K42 = SQL_KEYED.format(seed=42)


# -- D: splits -----------------------------------------------------------------------------------

@query("d1_stratified_holdout", f"""
WITH {K42}, s AS (SELECT *, round_even(n * 0.2, 0) AS nt FROM ranked)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN rk <= nt THEN 'test' WHEN rk <= nt + round_even((n - nt) * 0.15, 0) THEN 'val' ELSE 'train' END AS split FROM s""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*KEYS, "l_returnflag")
    return S.stratified_holdout(li, "l_returnflag", KEYS).drop("l_returnflag")


@query("d2_random_holdout", f"""
WITH {K42} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN CAST('0x' || h AS BIGINT) < {int(0.2 * 16**15)} THEN 'test'
  WHEN CAST('0x' || h AS BIGINT) < {int(0.2 * 16**15) + int(0.8 * 0.15 * 16**15)} THEN 'val' ELSE 'train' END AS split FROM k""")
def _(spark, sf):
    return S.random_holdout(table(spark, sf, "lineitem").select(*KEYS), KEYS)


@query("d2_exact_holdout", f"""
WITH {K42}, s AS (SELECT *, round_even(all_n * 0.2, 0) AS nt FROM ranked)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN all_rk <= nt THEN 'test' WHEN all_rk <= nt + round_even((all_n - nt) * 0.15, 0) THEN 'val' ELSE 'train' END AS split FROM s""")
def _(spark, sf):
    return S.exact_holdout(table(spark, sf, "lineitem").select(*KEYS), KEYS)


@query("d3_stratified_sample", f"""
WITH {SQL_KEYED.format(seed=7)}, w AS (SELECT least(greatest(CAST(floor(count(*) * 0.6) AS BIGINT), 100), count(*)) AS nw, count(*) AS total FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c AS l_returnflag FROM ranked, w WHERE rk <= least(n, greatest(1, round_even(n * (nw / total::DOUBLE), 0)))""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*KEYS, "l_returnflag")
    return S.stratified_sample(li, "l_returnflag", KEYS, S.search_rows(li.count()), seed=7)


@query("d4_random_sample", f"WITH {K42} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ranked WHERE all_rk <= 1000")
def _(spark, sf):
    return S.random_sample(table(spark, sf, "lineitem").select(*KEYS), KEYS, 1000)


@query("d5_stratified_folds", f"""
WITH {K42} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST((rk > floor(n / 5.0)) AS INT) + CAST((rk > floor(n * 2 / 5.0)) AS INT)
  + CAST((rk > floor(n * 3 / 5.0)) AS INT) + CAST((rk > floor(n * 4 / 5.0)) AS INT) AS fold FROM ranked""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*KEYS, "l_returnflag")
    k = S.fold_count(li, "l_returnflag", 5)
    return S.stratified_folds(li, "l_returnflag", KEYS, k).drop("l_returnflag")


@query("d6_time_blocks", """
WITH n AS (SELECT count(*) AS n, count(*) // 6 AS t FROM lineitem),
cuts AS (SELECT l_shipdate AS cut FROM (SELECT l_shipdate, row_number() OVER (ORDER BY l_shipdate) - 1 AS rk FROM lineitem), n
         WHERE rk IN (n.n - t * 5, n.n - t * 4, n.n - t * 3, n.n - t * 2, n.n - t))
SELECT block, count(*) AS n_rows, min(l_shipdate) AS first_day FROM (SELECT l_shipdate, (SELECT CAST(count(*) AS INT) FROM cuts WHERE cut <= l_shipdate) AS block FROM lineitem) GROUP BY block""")
def _(spark, sf):
    blocks = S.time_blocks(table(spark, sf, "lineitem").select("l_shipdate"), "l_shipdate", 5)
    return blocks.groupBy("block").agg(F.count("*").alias("n_rows"), F.min("l_shipdate").alias("first_day"))


@query("d7_most_recent", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC LIMIT 500")
def _(spark, sf):
    return S.most_recent(table(spark, sf, "lineitem").select(*KEYS, "l_shipdate"), "l_shipdate", 500, KEYS).drop("l_shipdate")


@query("d8_nested_samples", f"""
WITH {K42}, s AS (SELECT c, CASE {' '.join(f'WHEN rk <= greatest(1, round_even(n * {v}, 0)) THEN {i}' for i, v in enumerate(S.CURVE_SHARES))} END AS level FROM ranked)
SELECT c AS l_returnflag, level, count(*) AS n_rows FROM s GROUP BY 1, 2""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(*KEYS, "l_returnflag")
    return S.nested_samples(li, "l_returnflag", KEYS).groupBy("l_returnflag", "level").agg(F.count("*").alias("n_rows"))


# -- G: metrics ----------------------------------------------------------------------------------

@query("g1_confusion", f"WITH {SQL_MULTI}, c AS (SELECT y, CAST(pred AS INT) AS pred, count(*) AS n FROM sm GROUP BY 1, 2) SELECT y, pred, n, round(n / CAST(sum(n) OVER (PARTITION BY y) AS DOUBLE), 6) AS row_share FROM c")
def _(spark, sf):
    return rounded(M.confusion(scored_multi(spark, sf)))


_LABELS = """
lab AS (SELECT unnest(list_distinct(list_concat((SELECT list(DISTINCT y) FROM {t}), (SELECT list(DISTINCT pred) FROM {t})))) AS label),
cnt AS (SELECT label, (SELECT count(*) FROM {t} WHERE y = label AND pred = label)::DOUBLE AS tp, (SELECT count(*) FROM {t} WHERE y = label)::DOUBLE AS sup,
               (SELECT count(*) FROM {t} WHERE pred = label)::DOUBLE AS prd FROM lab),
pr AS (SELECT *, CASE WHEN prd = 0 THEN 0 ELSE tp / prd END AS p, CASE WHEN sup = 0 THEN 0 ELSE tp / sup END AS r FROM cnt),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f1 FROM pr)
"""


@query("g5_class_report", f"WITH {SQL_MULTI}, {_LABELS.format(t='sm')} SELECT CAST(label AS INT) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, CAST(sup AS BIGINT) AS support FROM f")
def _(spark, sf):
    return rounded(M.class_report(scored_multi(spark, sf)))


@query("g2_g3_g4_label_metrics", f"""
WITH {SQL_MULTI}, {_LABELS.format(t='sm')}
SELECT round(sum(tp) / sum(sup), 6) AS accuracy, round(1 - sum(tp) / sum(sup), 6) AS hamming_loss, round(avg(r) FILTER (sup > 0), 6) AS balanced_accuracy,
       round(sum(tp) / sum(sup), 6) AS precision_micro, round(sum(tp) / sum(sup), 6) AS recall_micro, round(sum(tp) / sum(sup), 6) AS f1_micro,
       round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro,
       round(sum(p * sup) / sum(sup), 6) AS precision_weighted, round(sum(r * sup) / sum(sup), 6) AS recall_weighted, round(sum(f1 * sup) / sum(sup), 6) AS f1_weighted FROM f""")
def _(spark, sf):
    return rounded(M.label_metrics(scored_multi(spark, sf)).drop("specificity"))


_AUC = f"""
{SQL_BIN}, u AS (SELECT p, CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg FROM sb GROUP BY p),
w AS (SELECT *, sum(neg) OVER (ORDER BY p) - neg AS neg_below, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp,
             sum(pos) OVER () AS tpos, sum(neg) OVER () AS tneg FROM u),
rk AS (SELECT sum(pos * (neg_below + neg / 2)) / (max(tpos) * max(tneg)) AS roc_auc, sum(pos / tpos * tp / (tp + fp)) AS auprc FROM w)
"""
_BINNED = "SELECT *, CASE WHEN p < floor(p * 10) * 0.1::DOUBLE THEN floor(p * 10) - 1 WHEN p >= (floor(p * 10) + 1) * 0.1::DOUBLE THEN floor(p * 10) + 1 ELSE floor(p * 10) END AS b FROM sb"
_ECE = f"ec AS (SELECT sum(n * abs(my - mp)) / sum(n) AS ece FROM (SELECT b, count(*) AS n, avg(y) AS my, avg(p) AS mp FROM ({_BINNED}) GROUP BY b))"


@query("g7_g8_ranking", f"WITH {_AUC} SELECT round(roc_auc, 6) AS roc_auc, round(auprc, 6) AS auprc FROM rk")
def _(spark, sf):
    return rounded(M.ranking_metrics(scored_bin(spark, sf)))


@query("g9_g10_calibration", f"WITH {SQL_BIN}, {_ECE} SELECT round(ece, 6) AS ece, (SELECT round(avg(pow(p - y, 2)), 6) FROM sb) AS brier_score FROM ec")
def _(spark, sf):
    return rounded(M.calibration_metrics(scored_bin(spark, sf)))


_LL_BIN = "(SELECT avg(-ln(least(greatest(CASE WHEN y = 1 THEN p ELSE 1 - p END, 2.220446049250313e-16), 1 - 2.220446049250313e-16))) FROM sb)"


@query("g11_log_loss", f"""
WITH {SQL_BIN}, {SQL_MULTI}
SELECT 'binary' AS kind, round({_LL_BIN}, 6) AS log_loss UNION ALL
SELECT 'multiclass', round(avg(-ln(greatest(probs[y + 1], 2.220446049250313e-16))), 6) FROM sm""")
def _(spark, sf):
    b = M.binary_log_loss(scored_bin(spark, sf)).withColumn("kind", F.lit("binary"))
    return rounded(b.unionByName(M.multiclass_log_loss(scored_multi(spark, sf)).withColumn("kind", F.lit("multiclass"))))


@query("g12_regression_metrics", f"""
WITH {SQL_REG} SELECT round(1 - avg(pow(y - yhat, 2)) / var_pop(y), 6) AS r2, round(avg(abs(y - yhat)), 3) AS mae, round(avg(pow(y - yhat, 2)), 0) AS mse,
  round(sqrt(avg(pow(y - yhat, 2))), 3) AS rmse, round(quantile_cont(abs(y - yhat), 0.5), 3) AS median_absolute_error FROM sr""")
def _(spark, sf):
    return rounded(M.regression_metrics(scored_reg(spark, sf)), mae=3, mse=0, rmse=3, median_absolute_error=3)


@query("g14_logged_metrics", f"""
WITH {SQL_REG} SELECT round(1 - avg(pow(y - yhat, 2)) / var_pop(y), 6) AS r2, round(sqrt(avg(pow(y - yhat, 2))), 3) AS rmse FROM sr""")
def _(spark, sf):
    logged = scored_reg(spark, sf).withColumns({"y": F.log1p("y"), "yhat": F.log1p("yhat")})
    return rounded(M.regression_metrics(logged, logged=True).select("r2", "rmse"), rmse=3)


@query("g13_classification_suite", f"""
WITH {_AUC}, {_ECE}, {_LABELS.format(t='sb')}, one AS (
SELECT sum(tp) / sum(sup) AS accuracy, 1 - sum(tp) / sum(sup) AS hamming_loss, avg(r) AS balanced_accuracy,
       sum(tp) / sum(sup) AS precision_micro, sum(tp) / sum(sup) AS recall_micro, sum(tp) / sum(sup) AS f1_micro,
       avg(p) AS precision_macro, avg(r) AS recall_macro, avg(f1) AS f1_macro, sum(p * sup) / sum(sup) AS precision_weighted,
       sum(r * sup) / sum(sup) AS recall_weighted, sum(f1 * sup) / sum(sup) AS f1_weighted, max(r) FILTER (label = 0) AS specificity,
       (SELECT roc_auc FROM rk) AS roc_auc, (SELECT auprc FROM rk) AS auprc, (SELECT ece FROM ec) AS ece,
       (SELECT avg(pow(p - y, 2)) FROM sb) AS brier_score, {_LL_BIN} AS log_loss FROM f)
SELECT metric, round(value, 6) AS value FROM (UNPIVOT one ON COLUMNS(*) INTO NAME metric VALUE value)""")
def _(spark, sf):
    return rounded(M.classification_suite(scored_bin(spark, sf)))


@query("g6_g15_metric_by_name", f"""
WITH {SQL_BIN}, {SQL_REG}, {_LABELS.format(t='sb')}
SELECT 'specificity' AS metric, round(max(r) FILTER (label = 0), 6) AS value FROM f
UNION ALL SELECT 'macro_f1', round(avg(f1), 6) FROM f
UNION ALL SELECT 'brier_score', round(-avg(pow(p - y, 2)), 6) FROM sb
UNION ALL SELECT 'rmse', round(-sqrt(avg(pow(y - yhat, 2))), 3) FROM sr""")
def _(spark, sf):
    out = M.score(scored_reg(spark, sf), "rmse").withColumn("value", r("value", 3))
    for m in ("specificity", "macro_f1", "brier_score"):
        out = out.unionByName(M.score(scored_bin(spark, sf), m).withColumn("value", r("value")))
    return out


# -- H: thresholds -------------------------------------------------------------------------------

_CAND = f"""
{SQL_BIN}, q AS (SELECT quantile_cont(p, [{', '.join(f'{i} / 201.0' for i in range(1, 201))}]) AS v FROM sb),
cand AS (SELECT DISTINCT threshold FROM (SELECT unnest(v) AS threshold FROM q UNION ALL SELECT 0.5) WHERE threshold BETWEEN 0 AND 1)
"""
_SCORES = """
cnt AS (SELECT threshold, (SELECT count(*) FROM sb WHERE p >= threshold AND y = 1)::DOUBLE AS tp, (SELECT count(*) FROM sb WHERE p >= threshold)::DOUBLE AS sup,
               (SELECT sum(y) FROM sb)::DOUBLE AS pos FROM {c}),
prc AS (SELECT threshold, sup, CASE WHEN sup = 0 THEN 0 ELSE tp / sup END AS precision, CASE WHEN pos = 0 THEN 0 ELSE tp / pos END AS recall FROM cnt),
sc AS (SELECT threshold, precision, recall, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
              CASE WHEN 4 * precision + recall = 0 THEN 0 ELSE 5 * precision * recall / (4 * precision + recall) END AS fbeta, CAST(sup AS BIGINT) AS support FROM prc)
"""
_SC = f"WITH {_CAND}, {_SCORES.format(c='cand')}"


@query("h1_candidate_thresholds", f"WITH {_CAND} SELECT DISTINCT round(threshold, 6) AS threshold FROM cand")
def _(spark, sf):
    return rounded(H.candidate_thresholds(scored_bin(spark, sf))).distinct()


_GRID = [0.02 + 0.02 * i for i in range(48)]


@query("h2_threshold_scores", f"WITH {SQL_BIN}, g AS (SELECT unnest([{', '.join(f'{v!r}' for v in _GRID)}]::DOUBLE[]) AS threshold), {_SCORES.format(c='g')} SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(fbeta, 6) AS fbeta, support FROM sc")
def _(spark, sf):
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in _GRID])).alias("threshold"))
    return rounded(H.threshold_scores(scored_bin(spark, sf), grid, beta=2.0))


def _policy(label: str, order: str) -> str:
    return f"SELECT * FROM (SELECT '{label}' AS mode, round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, support FROM sc ORDER BY {order} LIMIT 1)"


@query("h3_threshold_policies", f"{_SC} " + " UNION ALL ".join([
    _policy("f1", "f1 DESC, threshold DESC"), _policy("fbeta", "fbeta DESC, threshold DESC"),
    _policy("precision_at_recall", "(recall >= 0.8) DESC, precision DESC, recall DESC, threshold DESC"),
    _policy("recall_at_precision", "(precision >= 0.8) DESC, recall DESC, precision DESC, threshold DESC"),
    "SELECT 'disabled', 0.5, round(avg(CAST(y AS DOUBLE)) FILTER (p >= 0.5), 6), round(count(*) FILTER (p >= 0.5 AND y = 1) / CAST(sum(y) AS DOUBLE), 6), count(*) FILTER (p >= 0.5) FROM sb"]))
def _(spark, sf):
    scored = scored_bin(spark, sf)
    scores = pin(H.threshold_scores(scored, H.candidate_thresholds(scored), beta=2.0))
    out = None
    for mode in ("f1", "fbeta", "precision_at_recall", "recall_at_precision", "disabled"):
        row = H.tune_threshold(scored, H.ThresholdPolicy(mode=mode, beta=2.0), scores=scores).select(
            F.lit(mode).alias("mode"), "threshold", "precision", "recall", "support")
        out = row if out is None else out.unionByName(row)
    return rounded(out)


@query("h4_threshold_sweep", f"WITH {SQL_BIN}, g AS (SELECT 0.01 + i * (0.98 / 99) AS threshold FROM range(100) t(i)), {_SCORES.format(c='g')} SELECT round(threshold, 3) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM sc")
def _(spark, sf):
    return rounded(H.threshold_sweep(scored_bin(spark, sf)).drop("fbeta"), threshold=3)


@query("h5_h6_error_rows", f"""
WITH {SQL_BIN} SELECT l_orderkey, l_linenumber, CASE WHEN y = 1 THEN 'yes' ELSE 'no' END AS true_label, CASE WHEN p >= 0.6 THEN 'yes' ELSE 'no' END AS pred_label,
  CASE WHEN p >= 0.6 THEN 'FP' ELSE 'FN' END AS error_type, round(CASE WHEN p >= 0.6 THEN p ELSE 1 - p END, 6) AS confidence, round(abs(p - 0.6), 6) AS margin, round(p, 6) AS raw_proba
FROM sb WHERE CAST(p >= 0.6 AS INT) <> y""")
def _(spark, sf):
    errors = H.error_rows(scored_bin(spark, sf).drop("pred", "l_discount"), 0.6, labels=["no", "yes"])
    return rounded(H.by_confidence(errors).drop("y", "p"))


# -- J: uncertainty ------------------------------------------------------------------------------

_QHAT = """
cal AS (SELECT 1 - probs[y + 1] AS s FROM sm WHERE o_orderkey % 2 = 0), cr AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS rk, count(*) OVER () AS n FROM cal),
qh AS (SELECT max(s) AS qhat FROM cr WHERE rk = least(CAST(ceil((n + 1) * (1 - 0.1::DOUBLE)) AS BIGINT), n - 1))
"""


@query("j1_conformal_quantile", f"WITH {SQL_MULTI}, {_QHAT} SELECT round(qhat, 6) AS qhat FROM qh")
def _(spark, sf):
    cal = scored_multi(spark, sf).where("o_orderkey % 2 = 0")
    return rounded(U.conformal_quantile(cal.select(U.nonconformity(F.col("y"), F.col("probs")).alias("score"))))


@query("j2_prediction_sets", f"""
WITH {SQL_MULTI}, {_QHAT}, t AS (SELECT o_orderkey, probs, list_filter(range(0, 5), lambda i: probs[i + 1] >= 1 - qhat) AS s FROM sm, qh WHERE o_orderkey % 2 = 1)
SELECT o_orderkey, array_to_string(CASE WHEN len(s) = 0 THEN [list_position(probs, list_max(probs)) - 1] ELSE s END, ',') AS prediction_set, CAST(greatest(len(s), 1) AS INT) AS set_size,
  round(list_max(probs), 6) AS confidence, round(-list_sum(list_transform(probs, lambda p: p * ln(p))), 6) AS entropy FROM t""")
def _(spark, sf):
    m = scored_multi(spark, sf)
    rows, _ = U.classification_uncertainty(m.where("o_orderkey % 2 = 0"), m.where("o_orderkey % 2 = 1"))
    return rounded(rows.select("o_orderkey", F.array_join(F.col("prediction_set").cast("array<string>"), ",").alias("prediction_set"),
                               "set_size", "confidence", "entropy"))


@query("j3_j5_regression_intervals", f"""
WITH {SQL_REG}, cal AS (SELECT abs(y - yhat) AS s FROM sr WHERE l_orderkey % 2 = 0), cr AS (SELECT s, row_number() OVER (ORDER BY s) - 1 AS rk, count(*) OVER () AS n FROM cal),
qh AS (SELECT max(s) AS qhat FROM cr WHERE rk = least(CAST(ceil((n + 1) * (1 - 0.1::DOUBLE)) AS BIGINT), n - 1))
SELECT 'split_conformal_regression' AS method, round(any_value(qhat), 3) AS qhat, round(avg(CAST(y BETWEEN yhat - qhat AND yhat + qhat AS DOUBLE)), 6) AS conformal_empirical_coverage FROM sr, qh WHERE l_orderkey % 2 = 1""")
def _(spark, sf):
    d = scored_reg(spark, sf)
    _, summary = U.regression_uncertainty(d.where("l_orderkey % 2 = 0"), d.where("l_orderkey % 2 = 1"))
    return rounded(summary, qhat=3)


# -- L1-L4: curves -------------------------------------------------------------------------------

_CURVE = f"{SQL_BIN}, u AS (SELECT p, sum(y) AS pos, sum(1 - y) AS neg FROM sb GROUP BY p), c AS (SELECT p, CAST(sum(pos) OVER (ORDER BY p DESC) AS DOUBLE) AS tp, CAST(sum(neg) OVER (ORDER BY p DESC) AS DOUBLE) AS fp, CAST(sum(pos) OVER () AS DOUBLE) AS P_, CAST(sum(neg) OVER () AS DOUBLE) AS N_ FROM u)"


@query("l1_pr_curve", f"WITH {_CURVE} SELECT round(p, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P_, 6) AS recall FROM c")
def _(spark, sf):
    return rounded(L.pr_curve(scored_bin(spark, sf)))


@query("l1_operating_point", f"WITH {_CURVE} SELECT round(p, 6) AS threshold, round(tp / (tp + fp), 6) AS precision, round(tp / P_, 6) AS recall, round(P_ / (P_ + N_), 6) AS baseline FROM c ORDER BY abs(p - 0.42), p LIMIT 1")
def _(spark, sf):
    return rounded(L.operating_point(scored_bin(spark, sf), 0.42))


@query("l2_roc_curve", f"WITH {_CURVE} SELECT round(p, 6) AS threshold, round(fp / N_, 6) AS fpr, round(tp / P_, 6) AS tpr FROM c")
def _(spark, sf):
    return rounded(L.roc_curve(scored_bin(spark, sf)))


@query("l3_residuals", f"""
WITH {SQL_REG}, e AS (SELECT y - yhat AS e FROM sr), s AS (SELECT min(e) AS lo, max(e) AS hi FROM e)
SELECT CAST(least(floor((e - lo) / ((hi - lo) / 60)), 59) AS INT) AS bin, count(*) AS n FROM e, s GROUP BY 1""")
def _(spark, sf):
    return L.residual_histogram(scored_reg(spark, sf)).select("bin", "n")


@query("l4_reliability", f"""
WITH {SQL_BIN}, b AS (SELECT {' + '.join(f'CAST(p > {i} * 0.1::DOUBLE AS INT)' for i in range(1, 10))} AS bin, y, p FROM sb)
SELECT bin, count(*) AS n, round(avg(y), 6) AS fraction_positive, round(avg(p), 6) AS mean_predicted FROM b GROUP BY bin""")
def _(spark, sf):
    return rounded(L.reliability(scored_bin(spark, sf)))

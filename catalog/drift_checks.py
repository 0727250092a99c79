"""F: drift tests, reference profile, monitor."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_DRIFT, SQL_MONITOR, chi2_sf, drift_new, drift_ref, ks_sf, monitor_events, query, rounded
from veldtab.operators import drift as D
from veldtab.operators import monitor as W
from veldtab.plans.drift_report import drift_report
from veldtab.sources.storage import fresh_path

NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CAT = ["l_returnflag", "l_linestatus", "l_linenumber"]


def _long(t: str, cols: list[str], cast: str, keep: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {keep}'{c}' AS feature, CAST({c} AS {cast}) AS v FROM {t}" for c in cols)


# KS by brute force: distribution functions of both sides at every value of either.
def _ks(ref: str, new: str, keys: str = "") -> str:
    """CTEs pt, ks(keys, feature, d, n, m) from two long tables (keys, feature, v)."""
    k = f"{keys}, " if keys else ""
    return f"""
pt AS (SELECT {k}feature, v, sum(a) AS a, sum(b) AS b FROM (SELECT {k}feature, v, 1 AS a, 0 AS b FROM {ref} UNION ALL SELECT {k}feature, v, 0, 1 FROM {new}) GROUP BY {k}feature, v),
cu AS (SELECT *, sum(a) OVER (PARTITION BY {k}feature ORDER BY v) AS ca, sum(b) OVER (PARTITION BY {k}feature ORDER BY v) AS cb,
              sum(a) OVER (PARTITION BY {k}feature) AS ta, sum(b) OVER (PARTITION BY {k}feature) AS tb FROM pt),
ks AS (SELECT {k}feature, max(abs(ca / ta::DOUBLE - cb / tb::DOUBLE)) AS d, CAST(max(ta) AS BIGINT) AS n, CAST(max(tb) AS BIGINT) AS m FROM cu WHERE ta > 0 AND tb > 0 GROUP BY {k}feature)
"""


_F1 = f"WITH {SQL_DRIFT}, ra AS ({_long('dr', NUM, 'DOUBLE')}), rb AS ({_long('dn', NUM, 'DOUBLE')}), {_ks('ra', 'rb')}"


@query("f1_numeric_drift", f"{_F1} SELECT feature, n AS n_ref, m AS n_new, round(d, 6) AS statistic, round({ks_sf('d', 'n', 'm')}, 6) AS pvalue, ({ks_sf('d', 'n', 'm')}) < 0.05 AS drifted FROM ks")
def _(spark, sf):
    return rounded(D.numeric_drift(drift_ref(spark, sf), drift_new(spark, sf), NUM))


_CC = f"WITH {SQL_DRIFT}, ca AS (SELECT feature, v, count(*) AS r FROM ({_long('dr', CAT, 'VARCHAR')}) GROUP BY ALL), cb AS (SELECT feature, v, count(*) AS o FROM ({_long('dn', CAT, 'VARCHAR')}) GROUP BY ALL)"
_SHARED = f"""{_CC}, j AS (SELECT feature, r, o, sum(r) OVER (PARTITION BY feature) AS R_, sum(o) OVER (PARTITION BY feature) AS N_ FROM ca JOIN cb USING (feature, v)),
s AS (SELECT feature, sum(pow(o - r * N_ / R_, 2) / (r * N_ / R_)) AS stat, count(*) AS k FROM (SELECT feature, r::DOUBLE AS r, o::DOUBLE AS o, R_::DOUBLE AS R_, N_::DOUBLE AS N_ FROM j) GROUP BY feature HAVING count(*) >= 2)"""
_UNION = f"""{_CC}, j AS (SELECT feature, coalesce(r, 0) + 1e-6::DOUBLE AS r, coalesce(o, 0)::DOUBLE AS o FROM ca FULL JOIN cb USING (feature, v)),
jj AS (SELECT feature, r, o, sum(r) OVER (PARTITION BY feature) AS R_, sum(o) OVER (PARTITION BY feature) AS N_ FROM j),
s AS (SELECT feature, sum(pow(o - r * N_ / R_, 2) / (r * N_ / R_)) AS stat, count(*) AS k FROM jj GROUP BY feature HAVING count(*) >= 2)"""


@query("f2_f4_shared_categories", f"{_SHARED} SELECT feature, k AS categories, round(stat, 4) AS statistic, round({chi2_sf('stat', '(k - 1)')}, 6) AS pvalue, ({chi2_sf('stat', '(k - 1)')}) < 0.05 AS drifted FROM s")
def _(spark, sf):
    out = D.categorical_drift(drift_ref(spark, sf), drift_new(spark, sf), CAT)
    return rounded(out.drop("total_ref", "total_new"), statistic=4)


@query("f3_f4_union_categories", f"{_UNION} SELECT feature, k AS categories, round(stat / 1e3, 1) AS statistic_k, round({chi2_sf('stat', '(k - 1)')}, 6) AS pvalue, ({chi2_sf('stat', '(k - 1)')}) < 0.05 AS drifted FROM s")
def _(spark, sf):
    out = D.categorical_drift(drift_ref(spark, sf), drift_new(spark, sf), CAT, union=True)
    return rounded(out.withColumn("statistic_k", F.round(F.col("statistic") / 1e3, 1)).drop("total_ref", "total_new", "statistic"))


@query("f5_unseen_categories", f"{_CC} SELECT feature, v AS category, o AS n FROM cb WHERE (feature, v) NOT IN (SELECT (feature, v) FROM ca)")
def _(spark, sf):
    return D.novel_categories(drift_ref(spark, sf), drift_new(spark, sf), CAT)


@query("f6_f7_label_drift", f"""
{_UNION}, l AS (SELECT stat, k FROM s WHERE feature = 'l_returnflag'),
nv AS (SELECT string_agg(v, ',' ORDER BY v) AS novel_classes FROM cb WHERE feature = 'l_returnflag' AND v NOT IN (SELECT v FROM ca WHERE feature = 'l_returnflag'))
SELECT round({chi2_sf('stat', '(k - 1)')}, 6) AS pvalue, ({chi2_sf('stat', '(k - 1)')}) < 0.05 AS drift_detected, (SELECT novel_classes FROM nv) AS novel_classes,
       (SELECT count(*) FROM ca WHERE feature = 'l_returnflag') AS reference_class_count, (SELECT count(*) FROM cb WHERE feature = 'l_returnflag') AS new_class_count FROM l""")
def _(spark, sf):
    a, b = drift_ref(spark, sf), drift_new(spark, sf)
    label = D.label_drift(a, b, "l_returnflag").select("pvalue", "drift_detected")
    novel = D.novel_classes(a, b, "l_returnflag")
    return rounded(label.crossJoin(novel).withColumn("novel_classes", F.array_join("novel_classes", ",")))


_QCOLS = ["l_quantity", "l_discount", "l_returnflag", "l_linestatus"]


@query("f8_quality_drift", f"""
WITH {SQL_DRIFT}, q AS (SELECT CASE WHEN l_linenumber IN (1, 2) THEN NULL ELSE l_quantity END AS l_quantity, l_discount, 'k' AS l_returnflag, l_linestatus FROM dn)
SELECT 'l_quantity' AS "column", 0.0::DOUBLE AS reference_missing_rate, round(1 - count(l_quantity) / count(*)::DOUBLE, 6) AS new_missing_rate, round(1 - count(l_quantity) / count(*)::DOUBLE, 6) AS delta,
       1 - count(l_quantity) / count(*)::DOUBLE >= 0.05 AS changed, count(l_quantity) = 0 AS all_null_new, count(DISTINCT l_quantity) <= 1 AS constant_new FROM q
UNION ALL SELECT 'l_discount', 0.0, 0.0, 0.0, false, false, count(DISTINCT l_discount) <= 1 FROM q
UNION ALL SELECT 'l_returnflag', 0.0, 0.0, 0.0, false, false, count(DISTINCT l_returnflag) <= 1 FROM q
UNION ALL SELECT 'l_linestatus', 0.0, 0.0, 0.0, false, false, count(DISTINCT l_linestatus) <= 1 FROM q""")
def _(spark, sf):
    new = drift_new(spark, sf).withColumns({"l_quantity": F.when(~F.col("l_linenumber").isin(1, 2), F.col("l_quantity")), "l_returnflag": F.lit("k")})
    return rounded(D.quality_drift(drift_ref(spark, sf).select(*_QCOLS), new.select(*_QCOLS)))


@query("f8_quality_summary", f"""
WITH {SQL_DRIFT}, a AS (SELECT 1 - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_returnflag, l_linestatus FROM dr)) / (SELECT count(*) FROM dr)::DOUBLE AS x),
b AS (SELECT 1 - (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount, l_returnflag, l_linestatus FROM dn)) / (SELECT count(*) FROM dn)::DOUBLE AS z)
SELECT abs(z - x) >= 0.05 AS drift_detected, '' AS missing, '' AS all_null, '' AS constant, round(x, 6) AS duplicate_rate_reference, round(z, 6) AS duplicate_rate_new, round(z - x, 6) AS duplicate_rate_delta FROM a, b""")
def _(spark, sf):
    s = D.quality_summary(drift_ref(spark, sf).select(*_QCOLS), drift_new(spark, sf).select(*_QCOLS))
    join = lambda c, out: F.array_join(c, ",").alias(out)
    return rounded(s.select("drift_detected", join("missing_rate_changes", "missing"), join("all_null_columns_new", "all_null"), join("constant_columns_new", "constant"),
                            "duplicate_rate_reference", "duplicate_rate_new", "duplicate_rate_delta"))


_TYPES = "SELECT lower(column_name) AS c, CASE column_type WHEN 'DOUBLE' THEN 'double' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' ELSE 'other' END AS t FROM (DESCRIBE {})"


@query("f9_schema_skew", f"""
WITH a AS ({_TYPES.format('orders')}), b AS ({_TYPES.format('lineitem')}),
x AS (SELECT replace(c, 'o_', '') AS c, t FROM a), y AS (SELECT replace(c, 'l_', '') AS c, CASE WHEN c = 'l_orderkey' THEN 'string' ELSE t END AS t FROM b)
SELECT coalesce(x.c, y.c) AS "column", CASE WHEN x.t IS NULL THEN 'extra' WHEN y.t IS NULL THEN 'missing' ELSE 'retyped' END AS problem
FROM x FULL JOIN y ON x.c = y.c WHERE x.t IS DISTINCT FROM y.t""")
def _(spark, sf):
    """The stored schemas of two tables, column names without their prefixes, one key retyped."""
    from catalog.base import table
    named = lambda t, prefix: table(spark, sf, t).withColumnsRenamed({c: c.replace(prefix, "") for c in table(spark, sf, t).columns})
    new = named("lineitem", "l_").withColumn("orderkey", F.col("orderkey").cast("string"))
    return D.schema_skew(D.schema_table(named("orders", "o_")), D.schema_table(new)).select("column", "problem")



_SEGNUM = ["l_quantity", "l_discount"]
_F10 = f"WITH {SQL_DRIFT}, ra AS ({_long('dr', _SEGNUM, 'DOUBLE', 'l_returnflag AS seg, ')}), rb AS ({_long('dn', _SEGNUM, 'DOUBLE', 'l_returnflag AS seg, ')}), {_ks('ra', 'rb', 'seg')}"


@query("f10_segment_drift", f"{_F10} SELECT 'l_returnflag' AS segment_column, seg AS segment_value, feature, n AS n_ref, m AS n_new, round(d, 6) AS statistic, round({ks_sf('d', 'n', 'm')}, 6) AS pvalue, ({ks_sf('d', 'n', 'm')}) < 0.05 AS drifted FROM ks WHERE n >= 20 AND m >= 20")
def _(spark, sf):
    return rounded(D.segment_drift(drift_ref(spark, sf), drift_new(spark, sf), _SEGNUM, ["l_returnflag"]))


_F11 = f"""WITH {SQL_DRIFT}, rb AS ({_long('dn', _SEGNUM, 'DOUBLE', 'l_returnflag AS seg, ')}),
ra AS (SELECT seg, feature, v FROM ({_long('dr', _SEGNUM, 'DOUBLE')}), (SELECT DISTINCT seg FROM rb)), {_ks('ra', 'rb', 'seg')}"""


@query("f11_segment_vs_global", f"{_F11} SELECT 'l_returnflag' AS segment_column, seg AS segment_value, feature, n AS n_ref, m AS n_new, round(d, 6) AS statistic, round({ks_sf('d', 'n', 'm')}, 6) AS pvalue, ({ks_sf('d', 'n', 'm')}) < 0.05 AS drifted FROM ks WHERE m >= 20")
def _(spark, sf):
    reference = D.value_counts(drift_ref(spark, sf), _SEGNUM)
    return rounded(D.segment_drift_against(reference, drift_new(spark, sf), _SEGNUM, ["l_returnflag"]))


@query("f12_drift_actions", f"{_F1}, p AS (SELECT feature, {ks_sf('d', 'n', 'm')} AS p FROM ks) SELECT feature, round(p, 6) AS pvalue, CASE WHEN p < 0.01 THEN 'drop' WHEN p < 0.05 THEN 'flag' ELSE 'keep' END AS action FROM p")
def _(spark, sf):
    return rounded(D.drift_actions(D.numeric_drift(drift_ref(spark, sf), drift_new(spark, sf), NUM)))


# -- monitor -------------------------------------------------------------------------------------

ROLES = W.BatchColumns(label="y", probability="p", segments=("event_type",))
M_NUM, M_CAT = ["value", "user_id"], ["event_type"]


def _reference(spark, sf):
    """The reference profile, saved and read back: checks never touch the reference rows."""
    ref = monitor_events(spark, sf).where("day <= 10").drop("event_id", "ts", "day")
    path = fresh_path(spark, "profile")
    W.build_profile(ref, M_NUM, M_CAT, ROLES).save(path)
    return W.ReferenceProfile.load(spark, path)


def _batches(spark, sf):
    return monitor_events(spark, sf).where("day > 10").drop("event_id", "ts")


_ME = f"WITH {SQL_MONITOR}, rf AS (SELECT * FROM me WHERE day <= 10), bt AS (SELECT * FROM me WHERE day > 10)"


@query("f13_reference_profile", f"""{_ME},
b AS (SELECT *, CASE WHEN p < floor(p * 10) * 0.1::DOUBLE THEN floor(p * 10) - 1 WHEN p >= (floor(p * 10) + 1) * 0.1::DOUBLE THEN floor(p * 10) + 1 ELSE floor(p * 10) END AS b FROM rf)
SELECT 'value rows' AS item, count(DISTINCT value)::DOUBLE AS amount FROM rf UNION ALL SELECT 'user rows', count(DISTINCT user_id)::DOUBLE FROM rf
UNION ALL SELECT 'category rows', count(DISTINCT event_type)::DOUBLE FROM rf UNION ALL SELECT 'labels', sum(1)::DOUBLE FROM rf WHERE y = 1
UNION ALL SELECT 'corr value', round(corr(value, y), 6) FROM rf UNION ALL SELECT 'corr user', round(corr(user_id, y), 6) FROM rf
UNION ALL SELECT 'brier', round(avg(pow(p - y, 2)), 6) FROM rf
UNION ALL SELECT 'ece', round(sum(n * abs(my - mp)) / sum(n), 6) FROM (SELECT count(*) AS n, avg(y) AS my, avg(p) AS mp FROM b GROUP BY b)""")
def _(spark, sf):
    p = _reference(spark, sf)
    n, c = p.numeric, p.categories
    one = lambda df, label: df.select(F.lit(label).alias("item"), F.col("amount").cast("double").alias("amount"))
    parts = [one(n.where("feature = 'value'").agg(F.count("*").alias("amount")), "value rows"),
             one(n.where("feature = 'user_id'").agg(F.count("*").alias("amount")), "user rows"),
             one(c.where("feature = 'event_type'").agg(F.count("*").alias("amount")), "category rows"),
             one(c.where(f"feature = '{W.LABEL}' and category = '1'").select(F.col("n").alias("amount")), "labels"),
             one(p.links.where("feature = 'value'").select(F.col("corr").alias("amount")), "corr value"),
             one(p.links.where("feature = 'user_id'").select(F.col("corr").alias("amount")), "corr user"),
             one(p.calibration.select(F.col("brier_score").alias("amount")), "brier"),
             one(p.calibration.select(F.col("ece").alias("amount")), "ece")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return rounded(out)


_F14 = f"""{_ME}, rb AS (SELECT day, 'p' AS feature, p AS v FROM bt), ra AS (SELECT d.day, 'p' AS feature, p AS v FROM rf, (SELECT DISTINCT day FROM bt) d), {_ks('ra', 'rb', 'day')}"""


@query("f14_prediction_drift", f"{_F14} SELECT day, 'probability' AS type, round({ks_sf('d', 'n', 'm')}, 6) AS pvalue, ({ks_sf('d', 'n', 'm')}) < 0.05 AS drift_detected FROM ks")
def _(spark, sf):
    return rounded(W.prediction_drift(_reference(spark, sf), _batches(spark, sf), ["day"], ROLES))


@query("f15_concept_drift", f"""{_ME}, n AS (SELECT day, 'value' AS feature, corr(value, y) AS c, count(*) AS k FROM bt GROUP BY day UNION ALL SELECT day, 'user_id', corr(user_id, y), count(*) FROM bt GROUP BY day),
r AS (SELECT 'value' AS feature, corr(value, y) AS c FROM rf UNION ALL SELECT 'user_id', corr(user_id, y) FROM rf)
SELECT day, feature, round(r.c, 6) AS reference_corr, round(n.c, 6) AS new_corr, round(abs(n.c - r.c), 6) AS abs_delta FROM n JOIN r USING (feature) WHERE k >= 20 AND abs(n.c - r.c) >= 0.2""")
def _(spark, sf):
    return rounded(W.concept_drift(_reference(spark, sf), _batches(spark, sf), ["day"], "y"))


_CAL = """SELECT {k} count(*) AS n, avg(y) AS my, avg(p) AS mp, sum(pow(p - y, 2)) AS sq FROM (SELECT *, CASE WHEN p < floor(p * 10) * 0.1::DOUBLE THEN floor(p * 10) - 1 WHEN p >= (floor(p * 10) + 1) * 0.1::DOUBLE THEN floor(p * 10) + 1 ELSE floor(p * 10) END AS b
FROM (SELECT day, y, least(greatest(p, 0), 1) AS p FROM {t})) GROUP BY {k} b"""


@query("f16_calibration_drift", f"""{_ME}, c AS ({_CAL.format(k='day,', t='bt')}), r AS ({_CAL.format(k='', t='rf')}),
x AS (SELECT day, sum(n * abs(my - mp)) / sum(n) AS e, sum(sq) / sum(n) AS b FROM c GROUP BY day), y0 AS (SELECT sum(n * abs(my - mp)) / sum(n) AS e, sum(sq) / sum(n) AS b FROM r)
SELECT day, round(x.e - y0.e, 6) AS ece_delta, round(x.b - y0.b, 6) AS brier_score_delta, x.e - y0.e > 0.05 OR x.b - y0.b > 0.05 AS drift_detected FROM x, y0""")
def _(spark, sf):
    return rounded(W.calibration_drift(_reference(spark, sf), _batches(spark, sf), ["day"], "y", "p"))


# Hashed checks: a ratio and a number of active channels per supplier, to exercise every branch.
_CHK = """chk AS (SELECT s_suppkey AS check_key, (s_suppkey % 7 = 0)::INT * 0.05 + (s_suppkey % 5 = 0)::INT * 0.1 + (s_suppkey % 11 < 4)::INT * 0.2 AS ratio0, CAST(CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey % 4 ELSE 0 END AS INT) AS ch FROM supplier),
sev AS (SELECT check_key, ratio0::DOUBLE AS ratio, ch, CASE WHEN ratio0 >= 0.25 THEN 'high' WHEN ratio0 >= 0.1 THEN 'medium' WHEN ch >= 3 THEN 'high' WHEN ch >= 1 THEN 'medium' WHEN ratio0 > 0 THEN 'low' ELSE 'none' END AS severity FROM chk)"""


@query("f17_f18_persistence", f"""WITH {_CHK}, g AS (SELECT *, (ratio >= 0.1 OR ch > 0) AS drifting, count(*) FILTER (NOT (ratio >= 0.1 OR ch > 0)) OVER (ORDER BY check_key) AS island FROM sev),
c AS (SELECT *, CAST(count(*) FILTER (drifting) OVER (PARTITION BY island ORDER BY check_key) AS BIGINT) AS consecutive_drift_checks FROM g)
SELECT check_key, round(ratio, 6) AS drift_ratio, severity, consecutive_drift_checks, consecutive_drift_checks >= 3 AS alert, consecutive_drift_checks >= 3 AND (ratio >= 0.25 OR severity = 'high') AS retraining_recommended FROM c""")
def _(spark, sf):
    from catalog.base import table
    k = F.col("s_suppkey")
    flag = lambda c: c.cast("int")
    ratio = (flag(k % 7 == 0) * 5 + flag(k % 5 == 0) * 10 + flag(k % 11 < 4) * 20) / 100.0
    checks = table(spark, sf, "supplier").select(k.alias("check_key"), ratio.alias("drift_ratio"), F.when(k % 3 == 0, k % 4).otherwise(0).alias("active_channels"))
    checks = checks.withColumns({"severity": W.severity(F.col("drift_ratio"), F.col("active_channels")),
                                 "drifting": (F.col("drift_ratio") >= 0.1) | (F.col("active_channels") > 0)})
    return rounded(W.with_persistence(checks, "check_key").drop("check_id", "active_channels", "drifting", "recommendation"))


_F19 = f"""{_ME}, days AS (SELECT DISTINCT day FROM bt),
rb AS (SELECT day, 'value' AS feature, value AS v FROM bt UNION ALL SELECT day, 'user_id', user_id::DOUBLE FROM bt UNION ALL SELECT day, 'p', p FROM bt),
r0 AS (SELECT 'value' AS feature, value AS v FROM rf UNION ALL SELECT 'user_id', user_id::DOUBLE FROM rf UNION ALL SELECT 'p', p FROM rf),
ra AS (SELECT day, feature, v FROM r0, days), {_ks('ra', 'rb', 'day')},
kp AS (SELECT day, feature, {ks_sf('d', 'n', 'm')} AS pv FROM ks),
cr AS (SELECT 'event_type' AS feature, event_type AS v, count(*) AS r FROM rf GROUP BY ALL UNION ALL SELECT 'y', y::VARCHAR, count(*) FROM rf GROUP BY ALL),
cn AS (SELECT day, 'event_type' AS feature, event_type AS v, count(*) AS o FROM bt GROUP BY ALL UNION ALL SELECT day, 'y', y::VARCHAR, count(*) FROM bt GROUP BY ALL),
grid AS (SELECT d.day, f.feature, f.v FROM days d, (SELECT feature, v FROM cr UNION SELECT feature, v FROM cn) f),
jn AS (SELECT g.day, g.feature, coalesce(r, 0) + 1e-6::DOUBLE AS r, coalesce(o, 0)::DOUBLE AS o FROM grid g LEFT JOIN cr USING (feature, v) LEFT JOIN cn ON cn.day = g.day AND cn.feature = g.feature AND cn.v = g.v),
jj AS (SELECT *, sum(r) OVER (PARTITION BY day, feature) AS R_, sum(o) OVER (PARTITION BY day, feature) AS N_ FROM jn),
cs AS (SELECT day, feature, sum(pow(o - r * N_ / R_, 2) / (r * N_ / R_)) AS stat, count(*) AS k FROM jj GROUP BY day, feature),
cp AS (SELECT day, feature, {chi2_sf('stat', '(k - 1)')} AS pv FROM cs),
ap AS (SELECT * FROM kp UNION ALL SELECT * FROM cp),
fe AS (SELECT day, count(*) FILTER (pv < 0.05 AND feature IN ('value', 'user_id', 'event_type')) / 3.0::DOUBLE AS ratio, coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (pv < 0.05 AND feature IN ('value', 'user_id', 'event_type')), '') AS drifted_features,
              bool_or(pv < 0.05 AND feature = 'y') AS label_drift, bool_or(pv < 0.05 AND feature = 'p') AS prediction_drift FROM ap GROUP BY day)
SELECT fe.day, (SELECT count(*) FROM bt WHERE bt.day = fe.day) AS n_rows, drifted_features, round(ratio, 6) AS drift_ratio, label_drift, prediction_drift FROM fe"""


@query("f19_batch_checks", _F19)
def _(spark, sf):
    """Twenty daily batches against one reference profile, in one job."""
    checks = W.check_batches(_reference(spark, sf), _batches(spark, sf), ["day"], ROLES)
    return rounded(checks.select("day", "n_rows", F.array_join("drifted_features", ",").alias("drifted_features"), "drift_ratio", "label_drift", "prediction_drift"))


@query("f19_monitor_history")
def _(spark, sf):
    """The same checks with severity, persistence and recommendation, as the history table."""
    checks = W.check_batches(_reference(spark, sf), _batches(spark, sf), ["day"], ROLES, W.MonitorConfig(persistence=2))
    return W.with_persistence(checks, "day", W.MonitorConfig(persistence=2))


@query("f20_drift_report", f"""{_F1}, ca AS (SELECT feature, v, count(*) AS r FROM ({_long('dr', CAT, 'VARCHAR')}) GROUP BY ALL), cb AS (SELECT feature, v, count(*) AS o FROM ({_long('dn', CAT, 'VARCHAR')}) GROUP BY ALL),
j AS (SELECT feature, r::DOUBLE AS r, o::DOUBLE AS o, (sum(r) OVER (PARTITION BY feature))::DOUBLE AS R_, (sum(o) OVER (PARTITION BY feature))::DOUBLE AS N_ FROM ca JOIN cb USING (feature, v)),
s AS (SELECT feature, sum(pow(o - r * N_ / R_, 2) / (r * N_ / R_)) AS stat, count(*) AS k FROM j GROUP BY feature HAVING count(*) >= 2)
SELECT 'numeric' AS check_type, feature, round({ks_sf('d', 'n', 'm')}, 6) AS pvalue, ({ks_sf('d', 'n', 'm')}) < 0.05 AS drifted FROM ks
UNION ALL SELECT 'categorical', feature, round({chi2_sf('stat', '(k - 1)')}, 6), ({chi2_sf('stat', '(k - 1)')}) < 0.05 FROM s
UNION ALL SELECT 'novel_class', 'X', NULL, true WHERE (SELECT count(*) FROM dn WHERE l_returnflag = 'X') > 0""")
def _(spark, sf):
    """Full train/new report on line items (flagship query)."""
    report = drift_report(drift_ref(spark, sf), drift_new(spark, sf), NUM, CAT, label="l_returnflag")
    return rounded(report.where("check_type in ('numeric', 'categorical', 'novel_class')").select("check_type", "feature", "pvalue", "drifted"))


@query("f20_any_drift")
def _(spark, sf):
    report = drift_report(drift_ref(spark, sf), drift_new(spark, sf), NUM, CAT, label="l_returnflag", segment_cols=["l_linestatus"])
    return report.groupBy("check_type").agg(F.count("*").alias("n_checks"), F.count_if("drifted").alias("n_drifted"))

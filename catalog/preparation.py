"""E, I12-I13, L10 and L15: feature preparation and tables over plain columns."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from catalog.base import SQL_TRAIN, SQL_TRIALS, query, r, rounded, table, train_table, trials
from veldtab.operators import curves as L
from veldtab.operators import prep as E
from veldtab.operators.profiling import choose_metric

KEY = ["l_orderkey", "l_linenumber"]
# Train table with gaps: discount is null on every seventh order, type on every fifth.
SQL_GAPS = SQL_TRAIN + """,
gp AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_discount END AS l_discount, p_retailprice,
              CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE p_type END AS p_type, p_size, y FROM tt)"""


def gaps(spark, sf):
    return train_table(spark, sf).select(
        *KEY, "l_quantity", "l_extendedprice", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_discount")).alias("l_discount"), "p_retailprice",
        F.when(F.col("l_orderkey") % 5 != 0, F.col("p_type")).alias("p_type"), "p_size", "y")


NUM = ["l_quantity", "l_extendedprice", "l_discount", "p_retailprice"]


@query("e1_median_imputation", f"WITH {SQL_GAPS} SELECT count(*) AS n, count(v) AS n_value, round(sum(v), 4) AS total FROM (SELECT coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM gp)) AS v FROM gp)")
def _(spark, sf):
    df = gaps(spark, sf)
    filled = E.fit_median_imputer(df, NUM).transform(df)
    return filled.agg(F.count("*").alias("n"), F.count("l_discount").alias("n_value"), r(F.sum("l_discount"), 4).alias("total"))


@query("e2_mode_imputation", f"""WITH {SQL_GAPS}, t AS (SELECT p_type AS m FROM gp WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 1)
SELECT coalesce(p_type, (SELECT m FROM t)) AS p_type, count(*) AS n FROM gp GROUP BY 1""")
def _(spark, sf):
    df = gaps(spark, sf)
    return E.fit_mode_imputer(df, ["p_type", "p_size"]).transform(df).groupBy("p_type").agg(F.count("*").alias("n"))


@query("e3_power_transform")
def _(spark, sf):
    df = train_table(spark, sf).select("l_extendedprice", "p_retailprice")
    pt = E.fit_power_transform(df, df.columns)
    out = pt.transform(df)
    return rounded(out.agg(*[f(c).alias(f"{n}_{c}") for c in df.columns for n, f in (("mean", F.avg), ("std", F.stddev_pop), ("skew", F.skewness))]))


@query("e3_power_likelihood", f"""WITH {SQL_TRAIN}, g AS (SELECT unnest([0.0, 0.5, 1.0, 1.5]) AS lam),
t AS (SELECT lam, CASE WHEN lam = 0 THEN ln(1 + l_extendedprice) ELSE (pow(l_extendedprice + 1, lam) - 1) / lam END AS z, ln(1 + l_extendedprice) AS lg FROM tt, g)
SELECT lam::DOUBLE AS lam, round((-count(*) / 2.0 * ln(var_pop(z)) + (lam - 1) * sum(lg)) / count(*), 5) AS mean_log_likelihood FROM t GROUP BY lam""")
def _(spark, sf):
    df = train_table(spark, sf).select("l_extendedprice")
    scores = E.lambda_likelihoods(df, {"l_extendedprice": [0.0, 0.5, 1.0, 1.5]})
    per_lambda = F.array(*[F.struct(F.lit(lam).alias("lam"), F.lit(v).alias("total")) for (_, lam), v in scores.items()])
    return (df.agg(F.count("*").alias("n")).select("n", F.explode(per_lambda).alias("s"))
            .select("s.lam", r(F.col("s.total") / F.col("n"), 5).alias("mean_log_likelihood")))


@query("e4_robust_scaler", f"""WITH {SQL_GAPS}, q AS (SELECT quantile_cont(l_extendedprice, 0.5) AS m, quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25) AS w FROM gp)
SELECT l_orderkey, count(*) AS n, round(sum((l_extendedprice - m) / w), 5) AS scaled FROM gp, q GROUP BY l_orderkey""")
def _(spark, sf):
    df = gaps(spark, sf)
    out = E.fit_robust_scaler(df, ["l_extendedprice"]).transform(df)
    return out.groupBy("l_orderkey").agg(F.count("*").alias("n"), r(F.sum("l_extendedprice"), 5).alias("scaled"))


@query("e5_standard_scaler", f"""WITH {SQL_GAPS}, q AS (SELECT avg(l_discount) AS m, stddev_pop(l_discount) AS w FROM gp)
SELECT l_orderkey, count(l_discount) AS n, round(sum((l_discount - m) / w), 5) AS scaled FROM gp, q GROUP BY l_orderkey""")
def _(spark, sf):
    df = gaps(spark, sf)
    out = E.fit_standard_scaler(df, ["l_discount", "l_quantity"]).transform(df)
    return out.groupBy("l_orderkey").agg(F.count("l_discount").alias("n"), r(F.sum("l_discount"), 5).alias("scaled"))




@query("e7_one_hot", f"WITH {SQL_GAPS}, h AS (SELECT p_type AS level, count(*) AS n FROM gp WHERE p_type IS NOT NULL GROUP BY 1) SELECT 'p_type=' || level AS \"column\", CAST(n AS BIGINT) AS ones, (SELECT count(*) FROM gp) AS total FROM h")
def _(spark, sf):
    df = gaps(spark, sf)
    hot = E.fit_one_hot(df, ["p_type"])
    cols = list(hot.columns("p_type"))
    out = hot.transform(df)
    one = out.agg(F.count("*").alias("total"), *[F.sum(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").cast("bigint").alias("ones")) for i, c in enumerate(cols)])
    return one.select(F.explode(pairs).alias("s"), "total").select("s.*", "total")


_TE = f"""{SQL_TRAIN}, g AS (SELECT avg(y) AS g, var_pop(y) AS v FROM tt), c AS (SELECT p_name, count(*) AS n, avg(y) AS m, var_pop(y) AS cv FROM tt GROUP BY p_name)"""


@query("e8_target_encoding", f"WITH {_TE} SELECT p_name AS category, n, round((n * m + cv / v * g) / (n + cv / v), 6) AS encoding FROM c, g")
def _(spark, sf):
    return rounded(E.target_encoding(train_table(spark, sf), ["p_name"], "y").select("category", "n", "encoding"))


@query("e8_target_encoder_applied", f"WITH {_TE}, e AS (SELECT p_name, (n * m + cv / v * g) / (n + cv / v) AS e FROM c, g) SELECT count(*) AS n, round(avg(e), 6) AS mean, round(stddev_pop(e), 6) AS spread FROM tt JOIN e USING (p_name)")
def _(spark, sf):
    df = train_table(spark, sf)
    out = E.fit_target_encoder(df, ["p_name"], "y").transform(df)
    return rounded(out.agg(F.count("*").alias("n"), F.avg("p_name").alias("mean"), F.stddev_pop("p_name").alias("spread")))


@query("e8_cross_fit_encoding", f"""WITH {SQL_TRAIN}, f AS (SELECT *, l_orderkey % 3 AS fold FROM tt), k AS (SELECT DISTINCT fold, p_name FROM f),
c AS (SELECT k.fold, k.p_name, count(*) AS n, avg(y) AS m, var_pop(y) AS cv FROM k JOIN f ON f.fold <> k.fold AND f.p_name = k.p_name GROUP BY 1, 2),
g AS (SELECT k.fold, avg(y) AS g, var_pop(y) AS v FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY 1)
SELECT CAST(k.fold AS BIGINT) AS fold, k.p_name, round(coalesce((n * m + cv / v * g) / (n + cv / v), g), 6) AS encoded FROM k JOIN g USING (fold) LEFT JOIN c USING (fold, p_name)""")
def _(spark, sf):
    df = train_table(spark, sf).withColumn("fold", F.col("l_orderkey") % 3)
    out = E.cross_fit_encoding(df, "p_name", "y", "fold", "encoded")
    return rounded(out.groupBy("fold", "p_name").agg(F.max("encoded").alias("encoded")))


@query("e10_low_variance", f"""WITH {SQL_GAPS}, v AS (SELECT var_pop(l_quantity) AS l_quantity, var_pop(l_extendedprice) AS l_extendedprice,
  (SELECT var_pop(coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM gp))) FROM gp) AS l_discount, var_pop(p_retailprice) AS p_retailprice FROM gp)
SELECT feature, CAST(floor(log10(variance)) AS INT) AS magnitude, round(variance / pow(10, floor(log10(variance))), 9) AS leading FROM (UNPIVOT v ON COLUMNS(*) INTO NAME feature VALUE variance) WHERE variance > 1""")
def _(spark, sf):
    df = gaps(spark, sf)
    variances = E.column_variances(df, NUM)
    kept = [c for c in NUM if variances[c] > 1.0]
    size = {c: math.floor(math.log10(variances[c])) for c in kept}
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.lit(size[c]).alias("magnitude"), F.lit(round(variances[c] / 10 ** size[c], 9)).alias("leading")) for c in kept])
    return df.agg(F.count("*").alias("n")).where("n > 0").select(F.explode(rows).alias("s")).select("s.*")


def _corr(pairs, t: str) -> str:
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS c, {i} AS i FROM {t}" for i, (a, b) in enumerate(pairs))


_PAIRS = [(a, b) for i, a in enumerate(NUM) for b in NUM[i + 1:]]


@query("e11_correlation_pairs", f"WITH {SQL_GAPS}, c AS ({_corr(_PAIRS, 'gp')}) SELECT a, b, round(c, 6) AS corr FROM c")
def _(spark, sf):
    return rounded(E.correlation_pairs(gaps(spark, sf), NUM).select("a", "b", "corr"))


@query("e12_interactions", f"""WITH {SQL_GAPS}, m AS (SELECT l_quantity, l_extendedprice, coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM gp)) AS l_discount, p_retailprice FROM gp),
c AS ({_corr(_PAIRS, 'm')}) SELECT a || '__x__' || b AS name, round(abs(c), 6) AS abs_corr, (SELECT round(sum(l_quantity * l_extendedprice), 0) FROM gp) AS first_total FROM c WHERE abs(c) >= 0.05 ORDER BY abs(c) DESC, i LIMIT 3""")
def _(spark, sf):
    df = gaps(spark, sf)
    pairs = E.interaction_pairs(df, NUM, top_k=3)
    extended = E.add_interactions(df, [(p["a"], p["b"]) for p in pairs.collect()] or [])
    first = extended.agg(r(F.sum(F.col("l_quantity") * F.col("l_extendedprice")), 0).alias("first_total"))
    return rounded(pairs.select(F.concat_ws("__x__", "a", "b").alias("name"), "abs_corr").crossJoin(F.broadcast(first)))


_GEN = [(f"ft__{a}_{o}_{b}", f"{a} {o} {b}") for a, b in _PAIRS[:3] + [p for p in _PAIRS[3:]] for o in ("+", "*")]


@query("e13_e16_generated_features", f"WITH {SQL_GAPS}, v AS (" + " UNION ALL ".join(f"SELECT '{n}' AS feature, var_samp({e}) AS v FROM gp" for n, e in _GEN)
       + ") SELECT feature, count_ AS n_values, position FROM (SELECT feature, row_number() OVER (ORDER BY v DESC, feature) AS position FROM v WHERE v > 0) JOIN ("
       + " UNION ALL ".join(f"SELECT '{n}' AS feature, count({e}) AS count_ FROM gp" for n, e in _GEN) + ") USING (feature) WHERE position <= 5")
def _(spark, sf):
    df = gaps(spark, sf)
    fitted = E.fit_generated_features(df, NUM, max_features=5)
    out = E.align_columns(fitted.transform(df), fitted.names)
    one = out.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(fitted.names)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n_values"), F.lit(i + 1).cast("bigint").alias("position")) for i, c in enumerate(fitted.names)])
    return one.select(F.explode(rows).alias("s")).select("s.*")




@query("e14_entity_features", """SELECT user_id, round(sum(value), 4) AS tsfresh__value__sum_values, round(quantile_cont(value, 0.5), 6) AS tsfresh__value__median, round(avg(value), 6) AS tsfresh__value__mean, count(*)::DOUBLE AS tsfresh__value__length,
  round(stddev_pop(value), 6) AS tsfresh__value__standard_deviation, round(var_pop(value), 4) AS tsfresh__value__variance, round(sqrt(avg(value * value)), 6) AS tsfresh__value__root_mean_square,
  round(max(value), 6) AS tsfresh__value__maximum, round(max(abs(value)), 6) AS tsfresh__value__absolute_maximum, round(min(value), 6) AS tsfresh__value__minimum FROM events GROUP BY user_id""")
def _(spark, sf):
    out = E.entity_features(table(spark, sf, "events"), "user_id", ["value"])
    return rounded(out, tsfresh__value__sum_values=4, tsfresh__value__variance=4)


@query("e15_attach_entity_features", "SELECT event_id, round(value - avg(value) OVER (PARTITION BY user_id), 9) AS centred FROM events")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    feats = E.entity_features(events, "user_id", ["value"], exact_median=False)
    out = E.attach_entity_features(events, feats.select("user_id", "tsfresh__value__mean"), "user_id")
    return rounded(out.select("event_id", (F.col("value") - F.col("tsfresh__value__mean")).alias("centred")), 9)


@query("i3_class_weights", f"WITH {SQL_TRAIN}, c AS (SELECT y, count(*) AS n FROM tt GROUP BY y) SELECT y, n, round((SELECT sum(n) FROM c) / (2.0 * n)::DOUBLE, 6) AS weight FROM c")
def _(spark, sf):
    df = E.balanced_weights(train_table(spark, sf).select("y"), "y")
    return rounded(df.groupBy("y").agg(F.count("*").alias("n"), F.max("weight").alias("weight")))


@query("i3_positive_weight", f"WITH {SQL_TRAIN}, c AS (SELECT count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS q FROM tt) SELECT y, count(*) AS n, round(CASE WHEN y = 1 THEN max(greatest(p, q) / least(p, q)::DOUBLE) ELSE 1 END, 6) AS weight FROM tt, c GROUP BY y")
def _(spark, sf):
    """The weight of the rarer class that the metric choice gives, on its rows."""
    df = train_table(spark, sf).select("y")
    df = E.class_weights(df, "y", choose_metric(df, "y", imbalance_threshold=0.45).first()["class_weight"])
    return rounded(df.groupBy("y").agg(F.count("*").alias("n"), F.max("weight").alias("weight")))


@query("i12_parameter_impact", f"""WITH {SQL_TRIALS}, c AS (SELECT 'max_depth' AS parameter, corr(max_depth, score) AS c FROM tr UNION ALL SELECT 'learning_rate', corr(learning_rate, score) FROM tr UNION ALL SELECT 'subsample', corr(subsample, score) FROM tr)
SELECT parameter, round(c, 6) AS corr, CAST(row_number() OVER (ORDER BY abs(c) DESC, parameter) AS INT) AS rank FROM c""")
def _(spark, sf):
    return rounded(L.parameter_impact(trials(spark, sf), ["max_depth", "learning_rate", "subsample"]))


@query("i13_running_best", f"WITH {SQL_TRIALS} SELECT trial, round(score, 6) AS score, round(max(score) OVER (ORDER BY trial), 6) AS best_so_far FROM tr")
def _(spark, sf):
    return rounded(L.running_best(trials(spark, sf)))


@query("l10_correlation_table", f"""WITH {SQL_GAPS}, c AS ({_corr(_PAIRS, 'gp')}), s AS (SELECT a AS k, abs(c) AS r FROM c UNION ALL SELECT b, abs(c) FROM c),
top AS (SELECT k FROM s GROUP BY k ORDER BY avg(r) DESC, k LIMIT 3)
SELECT b AS a, a AS b, round(c, 6) AS corr FROM c WHERE a IN (FROM top) AND b IN (FROM top) UNION ALL SELECT k, k, 1.0 FROM top""")
def _(spark, sf):
    return rounded(L.correlation_table(gaps(spark, sf), NUM, keep=3))


@query("l15_pixel_counts", """WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y, l_discount AS v FROM lineitem), s AS (SELECT min(x) AS x0, max(x) - min(x) AS xs, min(y) AS y0, max(y) - min(y) AS ys FROM p)
SELECT CAST(least(floor((x - (x0 - 0.03::DOUBLE * xs)) / (xs * 1.06::DOUBLE) * 80), 79) AS INT) AS px, CAST(least(floor((y - (y0 - 0.03::DOUBLE * ys)) / (ys * 1.06::DOUBLE) * 60), 59) AS INT) AS py, count(*) AS n, round(avg(v), 9) AS mean FROM p, s GROUP BY 1, 2""")
def _(spark, sf):
    return rounded(L.pixel_counts(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 80, 60, value="l_discount"), 9)


@query("l15_pixel_categories", """WITH p AS (SELECT l_quantity AS x, l_extendedprice AS y, l_returnflag FROM lineitem), s AS (SELECT min(x) AS x0, max(x) - min(x) AS xs, min(y) AS y0, max(y) - min(y) AS ys FROM p)
SELECT CAST(least(floor((x - (x0 - 0.03::DOUBLE * xs)) / (xs * 1.06::DOUBLE) * 20), 19) AS INT) AS px, CAST(least(floor((y - (y0 - 0.03::DOUBLE * ys)) / (ys * 1.06::DOUBLE) * 20), 19) AS INT) AS py, l_returnflag, count(*) AS n FROM p, s GROUP BY 1, 2, 3""")
def _(spark, sf):
    return L.pixel_counts(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20, 20, category="l_returnflag")

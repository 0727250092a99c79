"""I, K, J4 and the model-based L rows. Trained models are checked by rows and invariants."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from catalog.base import query, rounded, table
from veldtab.operators import components as P
from veldtab.operators import diagnostics as G
from veldtab.operators import metrics as M
from veldtab.operators import models as I
from veldtab.operators import monitor as W
from veldtab.operators import prep as E
from veldtab.operators import scoring as K
from veldtab.operators import uncertainty as U
from veldtab.operators.profiling import FeatureRoles
from veldtab.operators.splits import stratified_holdout, written_holdout
from veldtab.plans import scorer as S
from veldtab.plans.training import train_classifier
from veldtab.sources.storage import fresh_path, write_through

KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
NUM = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size"]
ROLES = FeatureRoles(tuple(NUM), ("p_type", "l_linestatus"), ("p_name",))
SMALL = I.TreeParams(8, 3, 0.3, 1.0, 1.0, 1)


_LABELLED = "l AS (SELECT CAST(l_quantity + p_size * 0.3 + l_extendedprice % 20 > 45 AS INT) AS y FROM lineitem JOIN part ON l_partkey = p_partkey)"
_TEST_ROWS = f"WITH {_LABELLED} SELECT CAST(sum(n) AS BIGINT) AS n FROM (SELECT round_even(count(*) * 0.2, 0) AS n FROM l GROUP BY y)"


def labelled(spark, sf):
    """Line items with their part; y and price follow from features plus a part the features do not show."""
    li, part_ = table(spark, sf, "lineitem"), table(spark, sf, "part")
    hidden = F.col("l_extendedprice") % 20
    return li.join(part_, li.l_partkey == part_.p_partkey).select(
        *KEY, *NUM, "p_type", "l_linestatus", "p_name",
        (F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount")) + hidden * 50).alias("price"),
        (F.col("l_quantity") + F.col("p_size") * 0.3 + hidden > 45).cast("int").alias("y"))


def split(spark, sf):
    """The table is written once; every fit and evaluation reads it."""
    return written_holdout(labelled(spark, sf), "y", KEY)


def prepared(spark, sf, roles=ROLES, options=I.PrepOptions()):
    df = split(spark, sf)
    prep = I.fit_preparation(df.where("split = 'train'"), roles, "y", options)
    columns = [*KEY, "split", "y", "price", "features"]
    vectors = prep.transform_train(df.where("split = 'train'"), "y", KEY).select(*columns).unionByName(prep.transform(df.where("split <> 'train'")).select(*columns))
    return prep, write_through(vectors, "features")


def part(df, which):
    return df.where(F.col("split") == which)


@query("i1_classifier_metrics")
def _(spark, sf):
    """Preparation, boosted trees, exact test metrics."""
    _, df = prepared(spark, sf)
    model = I.fit_trees(part(df, "train"), "classification", SMALL, key_cols=KEY)
    return rounded(M.classification_suite(I.scored(model, part(df, "test"), "classification")))


def _stump(l1, l2):
    """The best first cut of the gain with penalties as SQL, over two features with few values."""
    kept = lambda g: f"greatest(abs({g}) - {l1}, 0)"
    leaf = lambda g, h: f"-sign({g}) * {kept(g)} / ({h} + {l2})"
    return f"""WITH r AS (SELECT l_linenumber::DOUBLE AS a, l_quantity::DOUBLE AS b, l_extendedprice::DOUBLE / 1000 AS y FROM lineitem),
m AS (SELECT avg(y) AS base, count(*) AS n FROM r), v AS (SELECT 0 AS feature, a AS x, y FROM r UNION ALL SELECT 1, b, y FROM r),
s AS (SELECT feature, x, sum(base - y) AS g, count(*) AS h FROM v, m GROUP BY 1, 2),
c AS (SELECT feature, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY feature) AS g, sum(h) OVER (PARTITION BY feature) AS h, row_number() OVER (PARTITION BY feature ORDER BY x DESC) AS k
      FROM s WINDOW w AS (PARTITION BY feature ORDER BY x)),
b AS (SELECT *, pow({kept('gl')}, 2) / (hl + {l2}) + pow({kept('(g - gl)')}, 2) / (h - hl + {l2}) AS worth FROM c WHERE k > 1)
SELECT feature, x AS threshold, round({leaf('gl', 'hl')}, 6) AS low_value, round({leaf('(g - gl)', '(h - hl)')}, 6) AS high_value, CAST(h AS BIGINT) AS n FROM b ORDER BY worth DESC LIMIT 1"""


@query("i1_leaf_penalties", _stump(500.0, 300.0))
def _(spark, sf):
    """One cut of the booster with L1 and L2 penalties: feature, threshold and both leaves."""
    rows = table(spark, sf, "lineitem").select(F.array(F.col("l_linenumber").cast("double"), F.col("l_quantity").cast("double")).alias("features"),
                                               (F.col("l_extendedprice").cast("double") / 1000).alias("y"), "l_orderkey", "l_linenumber")
    model = I.fit_trees(rows, "regression", I.TreeParams(1, 1, 1.0, 1.0, 1.0, 1, 500.0, 300.0), key_cols=["l_orderkey", "l_linenumber"])
    tree = model.rounds[0][0]
    scored = I.scored(model, rows, "regression")
    return scored.agg(F.count("yhat").alias("n")).select(F.lit(tree.feature[0]).alias("feature"), F.lit(tree.threshold[0]).alias("threshold"),
                                                         F.lit(round(tree.value[1], 6)).alias("low_value"), F.lit(round(tree.value[2], 6)).alias("high_value"), "n")


@query("i1_regressor_metrics")
def _(spark, sf):
    _, df = prepared(spark, sf)
    model = I.fit_trees(part(df, "train"), "regression", SMALL, label="price", key_cols=KEY)
    return rounded(M.metric_rows(M.regression_metrics(I.scored(model, part(df, "test"), "regression"), "price")))


@query("e6_l8_pca_scree")
def _(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    _, explained = G.fit_components(emb, vector="v")
    return rounded(G.scree(explained, emb))


@query("l9_pca_projection")
def _(spark, sf):
    emb = table(spark, sf, "embeddings").select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    transform, _ = G.fit_components(emb, vector="v")
    return rounded(G.projection(emb, transform, ["vec_id", "label"]))


_TRACE = "+".join(f"var_samp(embedding[{i + 1}]::DOUBLE)" for i in range(64))


@query("e6_l9_component_variance", f"SELECT count(*) AS n, round({_TRACE}, 6) AS total_variance, CAST(0 AS BIGINT) AS n_correlated FROM embeddings")
def _(spark, sf):
    """All components of all dimensions: their variances add up to that of the data, and neighbours are uncorrelated."""
    emb = table(spark, sf, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    transform, explained = G.fit_components(emb, vector="v")
    width = len(explained)
    flat = G.projection(emb, transform, ["vec_id"], width)
    total = F.round(sum((F.var_samp(f"pc{i + 1}") for i in range(1, width)), F.var_samp("pc1")), 6)
    odd = sum((F.when(F.abs(F.corr(f"pc{i}", f"pc{i + 1}")) > 1e-6, 1).otherwise(0) for i in range(1, width)), F.lit(0))
    return flat.agg(F.count("*").alias("n"), total.alias("total_variance"), odd.cast("bigint").alias("n_correlated"))


@query("e6_top_components", f"SELECT count(*) AS n, 8 AS n_components, true AS leads, true AS uncorrelated, round({_TRACE}, 6) AS total_variance FROM embeddings")
def _(spark, sf):
    """The first eight components by block power iteration: uncorrelated, in falling order, with the variance that their coordinates have; all of them hold all variance."""
    emb = table(spark, sf, "embeddings").select("embedding")
    top, whole = P.fit_top_components(emb, "embedding", 8), P.fit_top_components(emb, "embedding", 64)
    flat = top.project(emb, "embedding").select(*[F.col("components")[i].alias(f"c{i}") for i in range(8)])
    same = sum(((F.abs(F.var_samp(f"c{i}") / float(v) - 1) < 1e-9).cast("int") for i, v in enumerate(top.variances)), F.lit(0)) == 8
    crossed = sum(((F.abs(F.corr(f"c{i}", f"c{i + 1}")) < 1e-6).cast("int") for i in range(7)), F.lit(0)) == 7
    falling = all(a >= b for a, b in zip(top.variances, top.variances[1:])) and bool(abs(top.variances / whole.variances[:8] - 1).max() < 1e-9)
    return flat.agg(F.count("*").alias("n"), F.lit(len(top.variances)).alias("n_components"), (same & F.lit(falling)).alias("leads"), crossed.alias("uncorrelated"),
                    F.lit(round(float(whole.variances.sum()), 6)).alias("total_variance"))


@query("e9_feature_vector")
def _(spark, sf):
    """Assembled features with a PCA block, power transform and robust scaling."""
    from pyspark.ml.functions import vector_to_array
    _, df = prepared(spark, sf, options=I.PrepOptions(robust_cols=("l_quantity",), power=True, pca_threshold=3))
    return df.select(F.size(vector_to_array("features")).alias("width"), "split").groupBy("width", "split").agg(F.count("*").alias("n_rows"))


@query("e17_feature_elimination")
def _(spark, sf):
    _, df = prepared(spark, sf, FeatureRoles(tuple(NUM)))
    _, history = I.select_features(part(df, "train"), "classification", "roc_auc", "y", KEY, params=I.TreeParams(3, 2, 0.3, 1.0, 1.0, 1))
    return rounded(history)


def _multiclass(spark, sf):
    """Fitted on the train rows with all dimensions, scored on the test rows."""
    df = table(spark, sf, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    df = write_through(stratified_holdout(df.withColumn("y", (F.col("label") % 3).cast("int")), "y", ["vec_id"]), "split")
    prep = I.fit_preparation(part(df, "train"), FeatureRoles(tuple(f"e{i}" for i in range(64))), "y", I.PrepOptions(pca_threshold=64))
    return I.fit_multiclass(prep.transform(part(df, "train")), 3, I.TreeParams(3, 2, 0.3, 1.0, 1.0, 1)).transform(prep.transform(part(df, "test")))


@query("i2_multiclass")
def _(spark, sf):
    return rounded(M.classification_suite(_multiclass(spark, sf), p=None, probs="probs", binary=False))


@query("i2_class_probabilities", """SELECT CAST(sum(n) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_not_one, CAST(0 AS BIGINT) AS n_not_likeliest
FROM (SELECT round_even(count(*) * 0.2, 0) AS n FROM embeddings GROUP BY label % 3)""")
def _(spark, sf):
    """Every test row of the multi-class model: probabilities within 0 and 1 that sum to 1, the prediction the likeliest class."""
    rows = _multiclass(spark, sf)
    total = F.aggregate("probs", F.lit(0.0), lambda s, x: s + x)
    bad = lambda c: F.sum(F.when(c, 0).otherwise(1)).cast("bigint")
    return rows.agg(F.count("*").alias("n"), bad(F.forall("probs", lambda x: x.between(0, 1))).alias("n_outside"),
                    bad(F.abs(total - 1) < 1e-9).alias("n_not_one"), bad(F.get("probs", F.col("pred")) == F.array_max("probs")).alias("n_not_likeliest"))


@query("i4_i6_early_stopping")
def _(spark, sf):
    _, df = prepared(spark, sf)
    stopped = I.fit_early_stopped(part(df, "train"), part(df, "val"), "classification", SMALL)
    return rounded(I.round_log(stopped, df).withColumn("best_iteration", F.lit(stopped.best_iteration)))


@query("i4_patience", f"SELECT n, 3 AS patience, true AS stopped_by_patience, true AS best_is_least, true AS model_ends_at_best FROM ({_TEST_ROWS})")
def _(spark, sf):
    """Rounds on labels without any relation to the features: the held-out loss soon rises, and the fit stops three rounds after its best."""
    _, df = prepared(spark, sf, FeatureRoles(tuple(NUM)))
    noise = df.withColumn("y", (F.crc32(F.concat_ws(":", *KEY).cast("binary")) % 2).cast("int"))
    stopped = I.fit_early_stopped(part(noise, "train"), part(noise, "val"), "classification", I.TreeParams(60, 3, 0.5, 1.0, 1.0, 1), patience=3, key_cols=KEY)
    held = [v for _, v in stopped.rounds]
    least = held.index(min(held)) + 1
    return part(noise, "test").agg(F.count("*").alias("n")).withColumns({
        "patience": F.lit(3), "stopped_by_patience": F.lit(len(held) == least + 3), "best_is_least": F.lit(stopped.best_iteration == least),
        "model_ends_at_best": F.lit(stopped.model.getNumTrees == least)})


@query("i5_final_fit")
def _(spark, sf):
    _, df = prepared(spark, sf)
    model = I.fit_final(df, "classification", SMALL, 5)
    return rounded(M.ranking_metrics(I.scored(model, part(df, "test"), "classification")).withColumn("n_trees", F.lit(model.getNumTrees)))


def _trials(df, n=3):
    return I.search(part(df, "train"), "classification", "roc_auc", "y", KEY, n_trials=n, n_estimators=(2, 4), folds=2, validation=part(df, "val"))


@query("i7_search_trials")
def _(spark, sf):
    _, df = prepared(spark, sf)
    return rounded(_trials(df))


@query("i8_tree_count")
def _(spark, sf):
    _, df = prepared(spark, sf)
    _, rounds = I.tree_count_by_folds(part(df, "train"), "classification", I.TreeParams(5, 3, 0.3, 1.0, 1.0, 1), "y", KEY, folds=2)
    return rounded(rounds)


@query("i9_baselines")
def _(spark, sf):
    _, df = prepared(spark, sf)
    return rounded(I.evaluate_baselines(part(df, "train"), part(df, "test"), "classification", "roc_auc", trees=SMALL))


@query("i9_regression_baselines")
def _(spark, sf):
    _, df = prepared(spark, sf)
    return rounded(I.evaluate_baselines(part(df, "train"), part(df, "test"), "regression", "r2", label="price", trees=SMALL))


@query("i10_ensemble")
def _(spark, sf):
    _, df = prepared(spark, sf)
    members = I.fit_ensemble(df.where("split in ('train', 'val')"), _trials(df, 2), "classification", 2)
    return rounded(M.ranking_metrics(I.ensemble_scores(members, part(df, "test"), "classification")))


@query("i10_member_mean", f"SELECT n, CAST(0 AS BIGINT) AS n_different FROM ({_TEST_ROWS})")
def _(spark, sf):
    """The ensemble's probability of every test row is the mean of its members' own."""
    _, df = prepared(spark, sf)
    members = I.fit_ensemble(df.where("split in ('train', 'val')"), _trials(df, 2), "classification", 2)
    rows = I.ensemble_scores(members, part(df, "test"), "classification").select(*KEY, "features", "p")
    for i, member in enumerate(members):
        rows = I.scored(member, rows.withColumnRenamed("p", "mean"), "classification").withColumnRenamed("p", f"p{i}").withColumnRenamed("mean", "p").drop("probs", "pred")
    alone = sum((F.col(f"p{i}") for i in range(1, len(members))), F.col("p0")) / len(members)
    return rows.agg(F.count("*").alias("n"), F.sum(F.when(F.abs(alone - F.col("p")) < 1e-12, 0).otherwise(1)).cast("bigint").alias("n_different"))


_AVG = """SELECT o_orderkey, round((a + b) / 2, 9) AS p FROM (SELECT o_orderkey, CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 2)) AS INT) / 255.0::DOUBLE AS a,
CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 3, 2)) AS INT) / 255.0::DOUBLE AS b FROM orders)"""


@query("i10_probability_average", _AVG)
def _(spark, sf):
    h = F.md5(F.col("o_orderkey").cast("string"))
    p = lambda i: F.conv(F.substring(h, i, 2), 16, 10).cast("double") / 255.0
    rows = table(spark, sf, "orders").select("o_orderkey", F.array(1 - p(1), p(1)).alias("m1"), F.array(1 - p(3), p(3)).alias("m2"))
    return rounded(rows.select("o_orderkey", I.average_probabilities([F.col("m1"), F.col("m2")])[1].alias("p")), 9)


@query("i11_calibration")
def _(spark, sf):
    _, df = prepared(spark, sf)
    model = I.fit_spread(I.tree_estimator("classification", SMALL), part(df, "train"))
    calibrated = I.fit_calibration(I.scored(model, part(df, "val"), "classification")).transform(I.scored(model, part(df, "test"), "classification"))
    before = M.calibration_metrics(calibrated).withColumn("variant", F.lit("raw"))
    return rounded(before.unionByName(M.calibration_metrics(calibrated, p="p_calibrated").withColumn("variant", F.lit("calibrated"))))


@query("j4_quantile_intervals", f"SELECT n, CAST(0 AS BIGINT) AS n_crossed, true AS near_nominal FROM ({_TEST_ROWS})")
def _(spark, sf):
    """Models of the .05 and .95 quantile by pinball loss; the test rows between them are within three points of 90 %."""
    _, df = prepared(spark, sf)
    lower, upper = I.fit_quantiles(part(df, "train"), I.TreeParams(5, 3, 0.5, 1.0, 1.0, 20), label="price", key_cols=KEY)
    out = U.quantile_intervals(part(df, "test"), lower, upper)
    inside = F.avg(F.col("price").between(F.col("quantile_lower"), F.col("quantile_upper")).cast("double"))
    return out.agg(F.count("*").alias("n"), F.count_if(F.col("quantile_lower") > F.col("quantile_upper")).alias("n_crossed"), (F.abs(inside - 0.9) < 0.03).alias("near_nominal"))


# -- K: scoring ----------------------------------------------------------------------------------

FEATURE_COLS = [*NUM, "p_type", "l_linestatus", "p_name"]


def _fitted(spark, sf):
    df = split(spark, sf)
    prep = I.fit_preparation(part(df, "train"), ROLES, "y")
    model = I.fit_spread(I.tree_estimator("classification", SMALL), prep.transform_train(part(df, "train"), "y", KEY))
    spec = K.ScoringSpec(tuple(FEATURE_COLS), version="v1", threshold=0.4, labels=("cheap", "expensive"), dropped=("legacy_score",))
    return df, prep, model, spec


@query("k1_k2_input_check", "SELECT count(*) AS n, 2 AS n_warnings, 10 AS n_columns FROM lineitem JOIN part ON l_partkey = p_partkey")
def _(spark, sf):
    spec = K.ScoringSpec(tuple(FEATURE_COLS), dropped=("legacy_score",))
    rows, warnings = K.check_input(labelled(spark, sf).withColumns({"legacy_score": F.lit(1.0)}), spec, ["l_orderkey", "l_linenumber"])
    return rows.agg(F.count("*").alias("n")).withColumns({"n_warnings": F.lit(len(warnings)), "n_columns": F.lit(len(rows.columns))})


@query("k3_k8_unseen_categories", """SELECT 'p_brand' AS feature, p_brand AS category, count(*) AS n FROM part WHERE p_partkey % 2 = 1 AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_partkey % 2 = 0 AND p_brand <> 'Brand#11') GROUP BY p_brand""")
def _(spark, sf):
    p = table(spark, sf, "part")
    known = E.known_categories(p.where("p_partkey % 2 = 0 and p_brand <> 'Brand#11'"), ["p_brand"])
    return K.unseen_report(p.where("p_partkey % 2 = 1"), known, ["p_brand"])


@query("k4_k5_predictions")
def _(spark, sf):
    df, prep, model, spec = _fitted(spark, sf)
    rows, _ = K.check_input(part(df, "test"), spec, KEY)
    return rounded(K.predict(rows, prep, model, spec).groupBy("prediction").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p")))


_ENV_SQL = """SELECT CAST(o_orderkey % 10 AS VARCHAR) AS request_id, count(*) AS n_rows, CAST(sum(CAST(o_totalprice > 200000 AS INT)) AS BIGINT) AS positives, 'v1' AS model_version,
ceil(count(*) / 100.0)::INT AS parts FROM orders GROUP BY 1"""


@query("k6_envelope", _ENV_SQL)
def _(spark, sf):
    """Responses of ten requests in parts of about 100 rows, put together again."""
    spec = K.ScoringSpec((), version="v1", threshold=0.5)
    o = table(spark, sf, "orders").select(
        "o_orderkey", (F.col("o_orderkey") % 10).cast("string").alias("req"), (F.col("o_totalprice") > 200000).cast("int").alias("prediction"), F.lit(0.5).alias("p"))
    docs = K.envelope(o, spec, [], "o_orderkey", "req", part_rows=100)
    body = F.from_json("response", "model_version string, n_rows bigint, predictions array<int>")
    positives = F.aggregate("b.predictions", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return (docs.select("request_id", "parts", body.alias("b")).groupBy("request_id", "parts")
            .agg(F.sum("b.n_rows").alias("n_rows"), F.sum(positives).alias("positives"), F.max("b.model_version").alias("model_version")))


@query("k7_scoring_drift")
def _(spark, sf):
    """Drift check of scored batches with their own predictions."""
    df, prep, model, spec = _fitted(spark, sf)
    # Both are written once: every channel of the checks reads them.
    ref = write_through(K.predict(part(df, "train").drop("price", "split"), prep, model, spec).select(*FEATURE_COLS, "p", "y"), "scored")
    new = write_through(K.predict(part(df, "test").drop("price", "split"), prep, model, spec).select(*FEATURE_COLS, "p", "y", F.lit(1).alias("batch")), "scored")
    # The target-encoded column is a number after scoring.
    roles = W.BatchColumns(label="y", probability="p")
    profile = W.build_profile(ref, [*NUM, "p_name"], ["p_type", "l_linestatus"], roles)
    return W.with_persistence(W.check_batches(profile, new, ["batch"], roles), "batch").select("batch", "n_rows", "drift_ratio", "severity", "alert", "prediction_drift")


@query("a9_artifact", f"SELECT n, CAST(0 AS BIGINT) AS n_different, CAST(0 AS BIGINT) AS n_outside, 'v1' AS version, 0.4::DOUBLE AS threshold FROM ({_TEST_ROWS})")
def _(spark, sf):
    """Save and load the whole scorer, target encoding included; both score the same rows, and every row is compared."""
    df, prep, model, spec = _fitted(spark, sf)
    known = E.known_categories(part(df, "train"), ["p_type", "l_linestatus"])
    live = S.Scorer(prep, model, spec, known, I.fit_calibration(I.scored(model, prep.transform(part(df, "val")), "classification")))
    loaded = S.load_scorer(S.save_scorer(live, fresh_path(spark, "artifact")))
    columns = [*KEY, "prediction", "p", "p_calibrated"]
    a, b = (s.score(part(df, "test"), KEY)[0].select(*columns, F.lit(side).alias("side")) for s, side in ((live, 1), (loaded, 2)))
    pairs = a.unionByName(b).groupBy(*KEY, "prediction", "p", "p_calibrated").agg(F.count("*").alias("c"), F.count_distinct("side").alias("sides"))
    return pairs.agg((F.sum("c") / 2).cast("bigint").alias("n"), F.sum(F.when(F.col("sides") == 2, 0).otherwise(F.col("c"))).alias("n_different"),
                     F.sum(F.when(F.col("p").between(0, 1) & F.col("p_calibrated").between(0, 1), 0).otherwise(1)).cast("bigint").alias("n_outside")).withColumns(
        {"version": F.lit(loaded.spec.version), "threshold": F.lit(float(loaded.spec.threshold))})


# -- L: model diagnostics ------------------------------------------------------------------------

def _scorer(prep, model):
    return lambda df: I.scored(model, prep.transform(df), "classification", prep.slots).withColumn("value", F.col("p"))


def _numeric_model(spark, sf):
    df = split(spark, sf).select(*KEY, *NUM, "y", "split")
    prep = I.fit_preparation(part(df, "train"), FeatureRoles(tuple(NUM)), "y")
    return df, prep, I.fit_spread(I.tree_estimator("classification", SMALL), prep.transform(part(df, "train")))


@query("l5_importance")
def _(spark, sf):
    prep, df = prepared(spark, sf)
    return rounded(I.importances(I.fit_spread(I.tree_estimator("classification", SMALL), part(df, "train")), df))


@query("l6_permutation_importance")
def _(spark, sf):
    df, prep, model = _numeric_model(spark, sf)
    auc = lambda rows: float(M.ranking_metrics(rows, p="value").first()["roc_auc"])
    return rounded(G.permutation_importance(part(df, "test"), _scorer(prep, model), auc, NUM, KEY, repeats=2))


@query("l7_learning_curve")
def _(spark, sf):
    _, df = prepared(spark, sf, FeatureRoles(tuple(NUM)))
    return rounded(G.learning_curve(part(df, "train"), part(df, "val"), "classification", "roc_auc", "y", KEY, params=I.TreeParams(3, 2, 0.3, 1.0, 1.0, 1)))


@query("l11_outliers")
def _(spark, sf):
    df = split(spark, sf)
    out = G.outlier_report(part(df, "train"), part(df, "test"), NUM, KEY)
    return rounded(out.groupBy("is_outlier").agg(F.count("*").alias("n"), F.avg("outlier_score").alias("mean_score")), 4)


@query("l12_partial_dependence")
def _(spark, sf):
    df, prep, model = _numeric_model(spark, sf)
    return rounded(G.partial_dependence(G.individual_curves(part(df, "test"), _scorer(prep, model), NUM, KEY, points=20)))


@query("l12_tree_dependence", """SELECT l_linenumber::DOUBLE AS grid, (SELECT count(*) FROM lineitem) AS n_rows, true AS equal FROM lineitem GROUP BY l_linenumber""")
def _(spark, sf):
    """Dependence on a feature from leaf counts of one pass, against the mean score of all rows with the feature set."""
    rows = table(spark, sf, "lineitem").select(*[F.col(c).cast("double") for c in ("l_linenumber", "l_quantity", "l_discount")], F.col("l_extendedprice").cast("double").alias("price"), "l_orderkey")
    vectors = F.array("l_linenumber", "l_quantity", "l_discount")
    model = I.fit_trees(rows.withColumn("features", vectors), "regression", I.TreeParams(4, 3, 0.5, 1.0, 1.0, 1), label="price", key_cols=["l_orderkey", "l_linenumber"])
    values = [r[0] for r in rows.select("l_linenumber").distinct().collect()]
    found = G.tree_dependence(model, rows.withColumn("features", vectors), {0: values})
    cells = rows.withColumn("l_linenumber", F.explode(F.array(*map(F.lit, values)))).withColumn("features", vectors)
    plain = I.scored(model, cells, "regression").groupBy(F.col("l_linenumber").alias("grid")).agg(F.avg("yhat").alias("mean"))
    return found.join(plain, "grid").select("grid", "n_rows", (F.abs(F.col("mean_value") - F.col("mean")) < 1e-6).alias("equal"))


@query("l13_contributions")
def _(spark, sf):
    df, prep, model = _numeric_model(spark, sf)
    return rounded(G.contribution_summary(G.contributions(part(df, "test"), _scorer(prep, model), NUM, KEY)))


@query("l14_interactions")
def _(spark, sf):
    df, prep, model = _numeric_model(spark, sf)
    return rounded(G.interaction_strength(part(df, "test"), _scorer(prep, model), NUM, KEY))


@query("training_run")
def _(spark, sf):
    """The whole flow on one table: split, roles, fit, threshold, metrics, conformal summary."""
    result = train_classifier(labelled(spark, sf).drop("price"), "y", KEY, params=SMALL)
    return rounded(result.metrics)

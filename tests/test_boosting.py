"""The booster against a plain exact search, its penalties, losses, patience and odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veldtab.operators import boosting as B
from veldtab.operators import models as I
from veldtab.operators import uncertainty as U
from veldtab.sources.storage import fresh_path

ALL = dict(subsample=1.0, colsample=1.0)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.standard_normal((1200, 4)), 1)
    z = 2 * x[:, 0] + np.abs(x[:, 3]) + rng.standard_normal(1200) * 0.5
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.standard_normal(1200) * 0.5 > 0).astype(int)
    c = np.digitize(x[:, 0] + x[:, 1] + rng.standard_normal(1200) * 0.5, [-0.7, 0.7])
    rows = [(i, list(map(float, r)), int(a), float(b), int(k)) for i, (r, a, b, k) in enumerate(zip(x, y, z, c))]
    return spark.createDataFrame(rows, "id long, features array<double>, y int, z double, c int").repartition(5).cache()


def plain_tree(x, g, h, depth, p, limits):
    """Nested (feature, threshold, left, right) or a leaf value."""
    kept = lambda a: max(abs(a) - p.l1, 0.0) ** 2
    worth = lambda a, b: kept(a) / (b + p.l2)
    best = (B.LEAST_GAIN, None)
    if depth:
        for j in range(x.shape[1]):
            for t in limits[j]:
                left = x[:, j] <= t
                if min(h[left].sum(), h[~left].sum()) < p.min_child_weight:
                    continue
                gain = (worth(g[left].sum(), h[left].sum()) + worth(g[~left].sum(), h[~left].sum()) - worth(g.sum(), h.sum())) / 2
                if gain > best[0] + 1e-9:
                    best = gain, (j, t)
    if best[1] is None:
        return -math.copysign(math.sqrt(kept(g.sum())), g.sum()) / (h.sum() + p.l2)
    j, t = best[1]
    left = x[:, j] <= t
    return j, t, plain_tree(x[left], g[left], h[left], depth - 1, p, limits), plain_tree(x[~left], g[~left], h[~left], depth - 1, p, limits)


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return tree.value[node]
    return tree.feature[node], tree.threshold[node], nested(tree, 2 * node + 1), nested(tree, 2 * node + 2)


def same(a, b):
    if isinstance(a, float) or isinstance(b, float):
        return a == pytest.approx(b, abs=1e-9)
    return a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("kind,label,l1,l2,weight", [("squared", "z", 0.0, 1.0, 1), ("squared", "z", 40.0, 20.0, 30), ("logistic", "y", 3.0, 0.5, 5)])
def test_trees_equal_a_plain_search(data, kind, label, l1, l2, weight):
    p = B.TreeParams(3, 3, 0.5, min_child_weight=weight, l1=l1, l2=l2, **ALL)
    model = B.fit_boosted(data, B.Loss(kind), p, label=label, key_cols=["id"])
    rows = data.orderBy("id").collect()
    x, y = np.array([r.features for r in rows]), np.array([float(r[label]) for r in rows])
    limits = B.bin_limits(data.select(F.col("features").alias("x")), 4)
    margin = np.full((len(y), 1), model.base[0])
    assert model.base[0] == pytest.approx(y.mean() if kind == "squared" else math.log(y.mean() / (1 - y.mean())))
    for trees in model.rounds:
        g, h = B.Loss(kind).slopes(margin, y)
        assert same(nested(trees[0]), plain_tree(x, g[:, 0], h[:, 0], 3, p, limits))
        margin[:, 0] += 0.5 * np.array(trees[0].value)[trees[0].nodes(x, trees[0].threshold)]
    scored = {r.id: r for r in I.scored(model, data, "regression" if kind == "squared" else "classification").collect()}
    for r, m in zip(rows, margin[:, 0]):
        assert (scored[r.id].yhat if kind == "squared" else scored[r.id].p) == pytest.approx(m if kind == "squared" else 1 / (1 + math.exp(-m)), abs=1e-12)


def test_penalties_shrink_and_prune(data):
    fit = lambda **p: B.fit_boosted(data, B.Loss("squared"), B.TreeParams(1, 3, 1.0, **ALL, **p), label="z", key_cols=["id"])
    plain, ridge, lasso, gone = fit(l2=0.0), fit(l2=200.0), fit(l1=150.0, l2=0.0), fit(l1=1e9)
    largest = lambda m: max(abs(v) for v in m.rounds[0][0].value)
    assert largest(ridge) < largest(plain) and largest(lasso) < largest(plain)
    assert len(lasso.rounds[0][0].leaves()) <= len(plain.rounds[0][0].leaves()) == 8
    assert gone.rounds[0][0].leaves() == [0] and gone.rounds[0][0].value[0] == 0


def test_softmax_beats_one_vs_rest(data):
    from pyspark.ml.functions import array_to_vector
    rows = data.withColumn("features", array_to_vector("features"))
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    p = B.TreeParams(10, 3, 0.3, **ALL)
    loss = lambda m: I.scored(m, test, "classification").agg(F.avg(-F.log(F.greatest(F.get("probs", F.col("c")), F.lit(1e-15))))).first()[0]
    model = I.fit_multiclass(train, 3, p, label="c", key_cols=["id"])
    assert loss(model) < loss(I.fit_one_vs_rest(train, 3, p, label="c"))
    out = I.scored(model, test, "classification").collect()
    assert all(sum(r.probs) == pytest.approx(1) and r.pred == int(np.argmax(r.probs)) for r in out)
    assert np.mean([r.pred == r.c for r in out]) > 0.6


def test_patience_stops_at_a_planted_best_round(spark, data):
    # the held rows have the opposite labels, so every round makes them worse than the first
    turned = data.withColumn("y", 1 - F.col("y"))
    p = B.TreeParams(40, 2, 0.3, **ALL)
    stopped = I.fit_early_stopped(data, turned, "classification", p, patience=4, key_cols=["id"])
    assert stopped.best_iteration == 1 and len(stopped.rounds) == 5 and stopped.model.getNumTrees == 1
    train, held = zip(*stopped.rounds)
    assert list(train) == sorted(train, reverse=True) and list(held) == sorted(held)
    assert I.round_log(stopped, data).count() == 5
    best, rounds = I.tree_count_by_folds(data.withColumn("y", (F.xxhash64("id") % 2 == 0).cast("int")), "classification", p.replaced(learning_rate=1.0), "y", ["id"], folds=2, patience=2)
    assert rounds.count() == best + 2


def test_losses_are_those_of_the_model(data):
    p = B.TreeParams(10, 2, 0.3, subsample=0.7, colsample=0.5)
    train, held = data.where("id % 3 > 0"), data.where("id % 3 = 0")
    model = B.fit_boosted(train, B.Loss("logistic"), p, validation=held, key_cols=["id"])
    assert len(model.losses) == 10
    again = B.fit_boosted(train.repartition(3), B.Loss("logistic"), p, validation=held, key_cols=["id"])
    assert [[t.feature for t in r] for r in again.rounds] == [[t.feature for t in r] for r in model.rounds]
    for df, want in ((train, 0), (held, 1)):
        got = I.scored(model, df, "classification").agg(F.avg(-F.log(F.get("probs", F.col("y"))))).first()[0]
        assert got == pytest.approx(model.losses[model.getNumTrees - 1][want], abs=1e-9)


def test_quantile_models_cover(data):
    lower, upper = I.fit_quantiles(data.where("id % 4 > 0"), B.TreeParams(4, 2, 0.5, min_child_weight=30, **ALL), label="z", key_cols=["id"])
    for df, near in ((data.where("id % 4 > 0"), 0.005), (data.where("id % 4 = 0"), 0.04)):
        rows = U.quantile_intervals(df, lower, upper).collect()
        assert np.mean([r.z < r.quantile_lower for r in rows]) == pytest.approx(0.05, abs=near)
        assert np.mean([r.z > r.quantile_upper for r in rows]) == pytest.approx(0.05, abs=near)
    spread = np.std([r.z for r in rows])
    assert np.mean([r.quantile_upper - r.quantile_lower for r in rows]) < 3.29 * spread


def test_saved_model_scores_alike(spark, data):
    model = B.fit_boosted(data, B.Loss("softmax", 3), B.TreeParams(2, 2, 0.5, **ALL), label="c", key_cols=["id"], validation=data)
    path = fresh_path(spark, "model")
    model.save(path)
    loaded = B.BoostedModel.load(path)
    assert loaded == model
    assert sorted(map(repr, loaded.transform(data).collect())) == sorted(map(repr, model.transform(data).collect()))


def test_missing_values_constant_features_and_empty_input(spark, data):
    rows = [(i, [float("nan") if i % 3 == 0 else None if i % 3 == 1 else float(i % 5), 1.0], float(i % 3 == 2)) for i in range(90)] + [(99, [1.0, 1.0], None)]
    df = spark.createDataFrame(rows, "id long, features array<double>, y double")
    model = B.fit_boosted(df, B.Loss("squared"), B.TreeParams(3, 2, 1.0, l2=0.0, **ALL), key_cols=["id"])
    got = {r.id: r.yhat for r in model.transform(df.where("y is not null")).collect()}
    assert all(got[i] == pytest.approx(y, abs=0.35) for i, _, y in rows[:90]) and model.rounds[0][0].feature[0] == 0
    assert model.transform(df.limit(0)).columns == [*df.columns, "yhat"] and model.transform(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        B.fit_boosted(df.limit(0), B.Loss("squared"))
    same_label = B.fit_boosted(data.withColumn("y", F.lit(1)), B.Loss("logistic"), B.TreeParams(2, 2, 0.3, **ALL), key_cols=["id"])
    assert min(r.p for r in same_label.transform(data).collect()) > 0.99


def test_search_has_penalties(data):
    drawn = I.draw_params(200) + I.draw_params(200, wide=True)
    assert all(1e-4 <= p.l1 <= 1 and 0.1 <= p.l2 <= 5 for p in drawn[:200]) and all(1e-5 <= p.l1 <= 10 and 1e-2 <= p.l2 <= 10 for p in drawn[200:])
    trials = I.search(data, "classification", "log_loss", "c", ["id"], n_trials=2, n_estimators=(1, 2), folds=2, label="c", n_classes=3)
    best = I.best_trials(trials, 2)
    assert len(best) == 2 and {"l1", "l2"} <= set(trials.columns) and I.trial_params(best[0]).l1 == best[0]["l1"]
    members = I.fit_ensemble(data, trials, "classification", 2, label="c", n_classes=3, key_cols=["id"])
    rows = I.ensemble_scores(members, data, "classification").collect()
    assert all(len(r.probs) == 3 and sum(r.probs) == pytest.approx(1) and r.p is None for r in rows)


def test_small_models_of_values_score_inside_the_jvm_as_their_margins(spark, monkeypatch):
    rows = spark.range(600, numPartitions=3).select("id", F.array(
        F.when(F.col("id") % 13 == 0, float("nan")).when(F.col("id") % 17 == 0, None).when(F.col("id") % 19 == 0, float("-inf")).otherwise((F.col("id") * 31 % 101).cast("double")),
        (F.col("id") % 7).cast("double")).alias("features"), (F.col("id") * 31 % 101 + F.col("id") % 7 * 5).cast("double").alias("y"))
    model = B.fit_boosted(rows, B.Loss("squared"), B.TreeParams(4, 3, 0.5, 1.0, 1.0, 1), key_cols=["id"])
    scored = model.transform(rows)
    assert scored.columns == ["id", "features", "y", "yhat"]
    assert "Python" not in scored._jdf.queryExecution().optimizedPlan().toString()
    found = scored.collect()
    x = np.array([[np.nan if v is None else v for v in r["features"]] for r in found])
    assert [r["yhat"] for r in found] == model.margins(x)[:, 0].tolist() and len({r["yhat"] for r in found}) > 8
    for odd in (F.array(F.lit(1.0)), F.lit(None).cast("array<double>")):
        with pytest.raises(Exception, match="missing or differ in length"):
            model.transform(rows.withColumn("features", F.when(F.col("id") == 5, odd).otherwise(F.col("features")))).agg(F.sum("yhat")).collect()
    assert model.upto(0).transform(rows).select("yhat").distinct().count() == 1
    monkeypatch.setattr(B, "EXPRESSION_NODES", 5)
    assert [r["yhat"] for r in model.transform(rows).collect()] == [r["yhat"] for r in found]

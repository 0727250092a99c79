"""Queries on large tables: rows are exchanged once for all fits, scored once for all that reads the scores, and no vector or place is made that is not read."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from veldtab.operators import diagnostics as G
from veldtab.operators import models as I
from veldtab.operators import prep as E
from veldtab.operators.profiling import FeatureRoles

SF = "/root/testdata/sf0.001"
NUM = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1500, numPartitions=3).select(
        "id", (F.col("id") * 7919 % 4001 / 40.0).alias("a"), F.when(F.col("id") % 9 > 0, (F.col("id") % 17).cast("double")).alias("b"), (F.col("id") % 5).cast("int").alias("c"),
        ((F.col("id") * 7919 % 4001 + F.col("id") % 5 * 300) > 2400).cast("int").alias("y"))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_spread_rows_are_exchanged_once_and_bounded(rows, monkeypatch):
    monkeypatch.setattr(I, "ROWS_PER_TASK", 100)
    out = I.spread(rows, {"id", "a"})
    assert "Repartition" not in plan(out) and "Range" not in plan(out)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 15 and max(sizes) <= 110
    assert out.exceptAll(rows.select("id", "a")).isEmpty() and rows.select("id", "a").exceptAll(out).isEmpty()
    monkeypatch.setattr(I, "ROWS_PER_TASK", 10 ** 6)
    assert I.spread(rows, {"id"}) is rows


def test_elimination_exchanges_its_rows_once(rows, monkeypatch):
    vectors = VectorAssembler(inputCols=["a", "c", "u", "v", "w"], outputCol=I.FEATURES).transform(
        rows.withColumns({"u": F.col("id") % 7, "v": F.col("id") % 11, "w": F.col("id") % 3}))
    calls, once = [], I.exchanged_once
    monkeypatch.setattr(I, "exchanged_once", lambda df: calls.append(df.columns) or once(df))
    monkeypatch.setattr(I, "ROWS_PER_TASK", 100)
    slots, history = I.select_features(vectors, "classification", "roc_auc", "y", ["id"], params=I.TreeParams(2, 2, 0.3, 1.0, 1.0, 1))
    assert calls == [["y", I.FEATURES, "fold"]]
    assert sorted(r["n_features"] for r in history.collect()) == [3, 4, 5] and 0 in slots


def test_baselines_exchange_once_and_read_written_scores(rows, monkeypatch):
    vectors = VectorAssembler(inputCols=["a", "c"], outputCol=I.FEATURES).transform(rows)
    calls, read, once, tune = [], [], I.exchanged_once, I.tune_threshold
    monkeypatch.setattr(I, "exchanged_once", lambda df: calls.append(df.columns) or once(df))
    monkeypatch.setattr(I, "tune_threshold", lambda df, *a, **k: read.append(df.inputFiles()) or tune(df, *a, **k))
    monkeypatch.setattr(I, "ROWS_PER_TASK", 100)
    out = I.evaluate_baselines(vectors.where("id % 3 > 0"), vectors.where("id % 3 = 0"), "classification", "roc_auc", trees=I.TreeParams(2, 2, 0.3, 1.0, 1.0, 1))
    found = {(r["model"], r["metric"]): r["value"] for r in out.collect()}
    assert calls == [["y", I.FEATURES]] and len(read) == 2
    assert all(files and all("/veldtab/scored-" in f for f in files) for files in read)
    assert found["default_trees", "roc_auc"] > 0.8 and found["logistic", "roc_auc"] > 0.8


def test_channels_of_the_scoring_drift_read_written_scores(spark, monkeypatch):
    from catalog import modelling
    from catalog.base import QUERIES
    read, profile, check = [], modelling.W.build_profile, modelling.W.check_batches
    monkeypatch.setattr(modelling.W, "build_profile", lambda df, *a, **k: read.append(df.inputFiles()) or profile(df, *a, **k))
    monkeypatch.setattr(modelling.W, "check_batches", lambda p, df, *a, **k: read.append(df.inputFiles()) or check(p, df, *a, **k))
    assert QUERIES["k7_scoring_drift"](spark, SF).count() == 1
    assert len(read) == 2 and all(files and all("/veldtab/scored-" in f for f in files) for files in read)


def scorer(rows):
    prep = I.fit_preparation(rows, FeatureRoles(tuple(NUM)), "y")
    model = I.tree_estimator("classification", I.TreeParams(4, 3, 0.3, 1.0, 1.0, 1)).fit(prep.transform(rows))
    return prep, model


def test_scores_from_columns_are_those_from_vectors(rows):
    prep, model = scorer(rows)
    odd = rows.withColumns({"a": F.when(F.col("id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("a")), "c": F.when(F.col("id") % 7 > 0, F.col("c"))})
    assert prep.slots == ["n_a", "n_b", "n_c"]
    found, plain = (I.scored(model, prep.transform(odd), "classification", slots).select("id", "probs", "p", "pred") for slots in (prep.slots, None))
    assert "UDF" in plan(plain) and "UDF" not in plan(found)
    assert found.exceptAll(plain).isEmpty() and found.count() == 1500
    hot = I.fit_preparation(rows.withColumn("k", F.col("c").cast("string")), FeatureRoles(("a",), ("k",)), "y")
    assert hot.slots is None


def test_mean_curves_need_neither_places_nor_vectors(rows):
    prep, model = scorer(rows)
    score = lambda df: I.scored(model, prep.transform(df), "classification", prep.slots).withColumn("value", F.col("p"))
    curves = G.individual_curves(rows, score, NUM, ["id"], points=4)
    assert sorted({r["row"] for r in curves.select("row").distinct().collect()}) == list(range(1500))
    mean = G.partial_dependence(curves)
    assert "md5" not in plan(mean) and "Window" not in plan(mean) and "Join" not in plan(mean)
    found = {(r["feature"], r["grid"]): (r["mean_value"], r["n_rows"]) for r in mean.collect()}
    grid = G.dependence_grid(rows, NUM, 4)
    assert set(found) == {(f, v) for f, values in grid.items() for v in values}
    for f, v in [("a", grid["a"][2]), ("c", grid["c"][1])]:
        plain = model.transform(prep.transform(rows.withColumn(f, F.lit(v)))).agg(F.avg(F.element_at(I.vector_to_array("probability"), 2))).first()[0]
        assert found[f, v] == (pytest.approx(plain, abs=1e-12), 1500)


@pytest.mark.parametrize("at_once", [45, 2])
def test_interactions_score_each_choice_of_switched_features_once(rows, monkeypatch, at_once):
    monkeypatch.setattr(G, "PAIRS_AT_ONCE", at_once)
    sizes = []

    def score(df):
        sizes.append(df.count())
        return df.withColumn("value", F.col("a") * F.col("c") + F.col("b"))

    found = {(r["a"], r["b"]): r["strength"] for r in G.interaction_strength(rows.na.fill(0.0), score, NUM, ["id"], background=16).collect()}
    assert sizes == ([1500 * 7] if at_once == 45 else [1500 * 6, 1500 * 4])
    assert set(found) == {("a", "b"), ("a", "c"), ("b", "c")}
    assert found["a", "c"] > 1 and found["a", "b"] == pytest.approx(0, abs=1e-9) and found["b", "c"] == pytest.approx(0, abs=1e-9)


def test_likelihoods_of_all_lambdas_come_from_one_pass(spark, monkeypatch):
    x = [None, -3.5, -0.25, 0.0, 0.5, 2.0, 7.0, 40.0] * 5 + [1.0, None]
    df = spark.createDataFrame([(v, 4.0, None) for v in x], "x double, same double, none double").repartition(5)
    monkeypatch.setattr(E, "one_row_agg", lambda *_: pytest.fail("an aggregate of one expression per lambda"))
    lams = [-2.0, 0.0, 0.3, 1.0, 2.0, 2.5]
    found = E.lambda_likelihoods(df, {"x": lams, "same": [1.0], "none": [1.0]})
    known = np.array([v for v in x if v is not None])

    def one(v, lam):
        if v >= 0:
            return math.log1p(v) if lam == 0 else ((v + 1) ** lam - 1) / lam
        return -math.log1p(-v) if lam == 2 else -((1 - v) ** (2 - lam) - 1) / (2 - lam)

    logs = np.sum(np.sign(known) * np.log1p(np.abs(known)))
    for lam in lams:
        wanted = -len(known) / 2 * math.log(np.var([one(v, lam) for v in known])) + (lam - 1) * logs
        assert found["x", lam] == pytest.approx(wanted, rel=1e-10)
    assert found["same", 1.0] == found["none", 1.0] == -math.inf


def test_a_training_run_reads_written_scores(rows, monkeypatch):
    from veldtab.plans import training as R
    read, tune, suite = [], R.H.tune_threshold, R.M.classification_suite
    monkeypatch.setattr(R.H, "tune_threshold", lambda df, *a, **k: read.append(df.inputFiles()) or tune(df, *a, **k))
    monkeypatch.setattr(R.M, "classification_suite", lambda df, *a, **k: read.append(df.inputFiles()) or suite(df, *a, **k))
    R.train_classifier(rows, "y", ["id"], roles=FeatureRoles(("a", "c")), params=I.TreeParams(2, 2, 0.3, 1.0, 1.0, 1))
    assert len(read) == 2 and all(files and all("/veldtab/scored-" in f for f in files) for files in read)

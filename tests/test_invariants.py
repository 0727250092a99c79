"""Queries without SQL: exact small cases of their operators, and what must hold of their rows."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from veldtab.operators import diagnostics as G

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(60).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"), (F.col("id") * 37 % 11).cast("double").alias("c")).persist()


def run(spark, name):
    return entry.queries()[name](spark, SF).collect()


def by(expression):
    return lambda df: df.withColumn("value", F.expr(expression))


def test_contributions_add_up_to_the_score(spark, rows):
    f = lambda v: v["a"] * v["b"] + v["b"]
    phi = {}
    for r in G.contributions(rows, by("a * b + b"), FEATURES, ["id"], background=8, draws=3).collect():
        phi.setdefault(r["row"], {})[r["feature"]] = r["phi"]
    expected = {}
    for r in G._with_background(rows, FEATURES, ["id"], None, 8, 3, 42).collect():
        expected.setdefault(r["_row"], []).append(f(r["_x"]) - f(r["_z"]))
    assert len(phi) == 60 and set(phi) == set(expected)
    for row, parts in phi.items():
        assert parts["c"] == 0 and sum(parts.values()) == pytest.approx(sum(expected[row]) / 3, abs=1e-9)


def test_contributions_of_a_sum_are_the_differences(rows):
    phi = {(r["row"], r["feature"]): r["phi"] for r in G.contributions(rows, by("2 * a - 3 * c"), FEATURES, ["id"], background=8, draws=3).collect()}
    means = {}
    for r in G._with_background(rows, FEATURES, ["id"], None, 8, 3, 42).collect():
        means.setdefault(r["_row"], []).append((2 * (r["_x"]["a"] - r["_z"]["a"]), -3 * (r["_x"]["c"] - r["_z"]["c"])))
    for row, parts in means.items():
        assert phi[row, "a"] == pytest.approx(sum(p[0] for p in parts) / 3) and phi[row, "c"] == pytest.approx(sum(p[1] for p in parts) / 3)


def test_interaction_is_the_mixed_difference(rows):
    found = {(r["a"], r["b"]): r["strength"] for r in G.interaction_strength(rows, by("a * b + c"), FEATURES, ["id"], background=8).collect()}
    pairs = G._with_background(rows, FEATURES, ["id"], None, 8, 1, 42).collect()
    exact = sum(abs((r["_x"]["a"] - r["_z"]["a"]) * (r["_x"]["b"] - r["_z"]["b"])) for r in pairs) / len(pairs)
    assert found["a", "b"] == pytest.approx(exact) and found["a", "c"] == pytest.approx(0) and found["b", "c"] == pytest.approx(0)


def test_permuting_an_unused_column_costs_nothing(rows):
    metric = lambda df: -df.agg(F.avg(F.abs(F.col("value") - (F.col("a") * 2)))).first()[0]
    target = rows.withColumn("target", F.col("a") * 2)
    shifted = G.permutation_importance(target, by("target + a"), lambda df: -df.agg(F.avg(F.abs(F.col("value") - F.col("target") * 1.5))).first()[0], FEATURES, ["id"], repeats=2)
    found = {r["feature"]: (r["mean_drop"], r["std_drop"]) for r in shifted.collect()}
    assert found["b"] == found["c"] == (0.0, 0.0) and found["a"][0] > 0 and metric(by("a + a")(rows)) == 0


def test_learning_curve_grows_to_all_rows(spark):
    curve = sorted(run(spark, "l7_learning_curve"), key=lambda r: r["share"])
    sizes = [r["n_rows"] for r in curve]
    assert sizes == sorted(sizes) and curve[-1]["share"] == 1.0
    assert all(abs(r["n_rows"] / sizes[-1] - r["share"]) < 0.02 for r in curve)
    assert all(0 <= r[c] <= 1 for r in curve for c in ("train_score", "val_score"))


def test_elimination_takes_one_feature_at_a_time(spark):
    sizes = [r["n_features"] for r in run(spark, "e17_feature_elimination")]
    assert sorted(sizes) == list(range(3, max(sizes) + 1)) if max(sizes) >= 5 else len(sizes) == 1


def test_majority_baseline_is_the_share_of_the_likelier_class(spark):
    from catalog.modelling import part, prepared
    found = {(r["model"], r["metric"]): r["value"] for r in run(spark, "i9_baselines") if r["status"] == "ok"}
    _, df = prepared(spark, SF)
    likelier = part(df, "train").agg(F.mode("y", True)).first()[0]
    share = part(df, "test").agg(F.avg((F.col("y") == likelier).cast("double"))).first()[0]
    assert found["majority", "accuracy"] == pytest.approx(share, abs=1e-6)
    assert {m for m, _ in found} > {"majority"}


def test_importances_are_shares(spark):
    values = [r["importance"] for r in run(spark, "l5_importance")]
    assert values == sorted(values, reverse=True) and sum(values) == pytest.approx(1, abs=1e-3) and min(values) >= 0


def test_predictions_cover_the_test_rows(spark):
    from catalog.modelling import KEY, K, _fitted, part
    df, prep, model, spec = _fitted(spark, SF)
    n = sum(r["n"] for r in run(spark, "k4_k5_predictions"))
    scored = K.predict(K.check_input(part(df, "test"), spec, KEY)[0], prep, model, spec)
    wrong = scored.where((F.col("prediction") == "expensive") != (F.col("p") >= 0.4)).count()
    assert n == part(df, "test").count() == scored.count() and wrong == 0


def test_feature_vectors_have_one_width(spark):
    from catalog.modelling import prepared
    found = run(spark, "e9_feature_vector")
    assert len({r["width"] for r in found}) == 1 and {r["split"] for r in found} == {"train", "val", "test"}
    assert sum(r["n_rows"] for r in found) == prepared(spark, SF)[1].count()


def test_history_agrees_with_the_checks(spark):
    history = {str(r["day"]): r for r in run(spark, "f19_monitor_history")}
    checks = {str(r["day"]): r for r in run(spark, "f19_batch_checks")}
    assert set(history) == set(checks)
    for day, r in checks.items():
        assert history[day]["n_rows"] == r["n_rows"] and history[day]["drift_ratio"] == pytest.approx(r["drift_ratio"], abs=1e-6)
        assert history[day]["label_drift"] == r["label_drift"] and history[day]["prediction_drift"] == r["prediction_drift"]


def test_report_counts_agree_with_the_report(spark):
    counts = {r["check_type"]: (r["n_checks"], r["n_drifted"]) for r in run(spark, "f20_any_drift")}
    report = run(spark, "f20_drift_report")
    for kind in ("numeric", "categorical"):
        own = [r["drifted"] for r in report if r["check_type"] == kind]
        assert counts[kind] == (len(own), sum(own))
    assert all(drifted <= n for n, drifted in counts.values())


def test_calibration_mends_shifted_probabilities(rows):
    from catalog.modelling import I
    planted = rows.crossJoin(rows.sparkSession.range(50).withColumnRenamed("id", "k")).select(
        (F.col("a") / 10 + 0.05).alias("p"), (F.col("k") / 50 < F.pow(F.col("a") / 10 + 0.05, 2)).cast("int").alias("y"))
    out = I.fit_calibration(planted).transform(planted)
    gap = lambda c: out.groupBy("p").agg(F.abs(F.avg(c) - F.avg("y")).alias("gap")).agg(F.max("gap")).first()[0]
    assert out.where(~F.col("p_calibrated").between(0, 1)).count() == 0 and gap("p_calibrated") < 0.05 < 0.2 < gap("p")


def test_scoring_drift_covers_the_test_rows(spark):
    from catalog.modelling import part, split
    (row,) = run(spark, "k7_scoring_drift")
    assert row["n_rows"] == part(split(spark, SF), "test").count() and 0 <= row["drift_ratio"] <= 1

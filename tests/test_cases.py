"""Small hand-made cases with known answers."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldtab.operators import cleaning as C
from veldtab.operators import metrics as M
from veldtab.operators import monitor as W
from veldtab.operators import prep as E
from veldtab.operators import profiling as P
from veldtab.operators import scoring as K
from veldtab.operators import thresholds as H
from veldtab.operators import uncertainty as U
from veldtab.operators.drift import duplicate_rate
from veldtab.sources import readers, sinks


def test_chunked_csv_returns_all_rows(spark, tmp_path):
    (tmp_path / "d.csv").write_text("x,target\n" + "".join(f"{i},{i % 2}\n" for i in range(5)))
    df = readers.read_table(spark, str(tmp_path / "d.csv"))
    assert [r["x"] for r in df.orderBy("x").collect()] == [0, 1, 2, 3, 4] and len(df.columns) == 2


def test_no_matching_file_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, str(tmp_path / "*.csv"))


def test_json_and_jsonl(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1},\n {"x": 2}]')
    (tmp_path / "b.jsonl").write_text('{"x": 3, "y": "k"}\n{"x": 4, "y": "l"}\n')
    df = readers.read_table(spark, str(tmp_path / "*"))
    assert sorted(r["x"] for r in df.collect()) == [1, 2, 3, 4] and df.where("y is null").count() == 2


def test_sampled_inference_rereads_when_types_do_not_fit(spark, tmp_path):
    (tmp_path / "m.csv").write_text("x\n" + "1\n" * 500 + "not a number\n")
    df = readers.read_csv(spark, [str(tmp_path / "m.csv")], sampling_ratio=0.01)
    assert dict(df.dtypes) == {"x": "string"} and df.count() == 501


def test_midnight_and_noon(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 0), ("2024-01-01 12:00:00", 1)], "event_time string, target int")
    rows = C.clean(df).orderBy("target").collect()
    assert "event_time" not in rows[0].asDict()
    assert rows[0]["event_time_hour_sin"] == pytest.approx(0) and rows[1]["event_time_hour_cos"] == pytest.approx(-1)
    assert {"event_time_month_sin", "event_time_dayofweek_cos"} <= set(rows[0].asDict())


def test_strings_are_stripped_and_markers_dropped(spark):
    df = spark.createDataFrame([("\t a ",), (" N/A",), ("NONE",), ("  ",)], "s string")
    assert [r["s"] for r in C.clean_strings(df).collect()] == ["a", None, "NONE", None]


def test_roles(spark):
    df = spark.createDataFrame([(0.1 * i, i % 2, f"t{i % 3}", None) for i in range(4)], "continuous double, low_card_int bigint, text string, empty string")
    roles = P.detect_roles(df)
    assert (roles.numeric, roles.one_hot, roles.target_encoded) == (("continuous",), ("text", "low_card_int"), ())


def test_distinct_counts_are_exact_at_the_limit(spark):
    df = spark.range(2000).select((F.col("id") % 20).alias("a"), (F.col("id") % 21).alias("b"), (F.col("id") % 51).cast("string").alias("c"), (F.col("id") % 50).cast("string").alias("d"))
    roles = P.detect_roles(df)
    assert roles.one_hot == ("d", "a") and roles.numeric == ("b",) and roles.target_encoded == ("c",)


def test_imbalanced_target(spark):
    df = spark.createDataFrame([(0,)] * 100 + [(1,)] * 2, "y int")
    row = P.choose_metric(df, "y").first()
    assert (row["metric"], row["needs_probability"], row["class_weight"]) == ("auprc", True, 50.0)


def test_missing_report(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "a", 0), (None, "b", 1), (3.0, None, 0)], "amount double, merchant string, target int")
    totals = P.missing_totals(df).first()
    report = P.missing_by_column(df, "target")
    assert (totals["total_missing"], totals["rows_with_missing"]) == (2, 2)
    assert {r["column"] for r in report.collect()} == {"amount", "merchant"}
    for kind in ("csv", "json"):
        sinks.write_report(report, str(tmp_path / kind), kind, small=True)
    assert readers.nan_to_null(spark.read.json(str(tmp_path / "json"))).count() == 2


def test_expectations_raise(spark):
    df = spark.range(5)
    with pytest.raises(ValueError, match="small ids"):
        P.require(df, [P.Rule("small ids", F.col("id") < 3, "id")])


def test_null_target_breaks_the_contract(spark):
    df = spark.createDataFrame([(float(i), i % 2) for i in range(20)], "x double, y int")
    contract = P.infer_contract(df, "y")
    with pytest.raises(ValueError, match="null"):
        P.require_contract(df.union(spark.createDataFrame([(1.0, None)], df.schema)), contract, "y")
    assert P.check_contract(df.drop("x"), contract).where("check = 'missing_column'").count() == 1


def _frames(spark):
    ref = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(6)], "amount double, segment string")
    new = spark.createDataFrame([(float(i), "ab"[i % 2]) for i in range(100, 106)], "amount double, segment string")
    return ref, new


def test_alert_only_on_second_drift(spark, tmp_path):
    ref, new = _frames(spark)
    monitor = W.DriftMonitor(W.build_profile(ref, ["amount"], ["segment"]), str(tmp_path / "h"), config=W.MonitorConfig(persistence=2))
    first = monitor.check(new, 1).collect()[-1]
    assert first["drifted_features"] == ["amount"] and not first["alert"] and first["severity"] == "high"
    second = monitor.check(new, 2).collect()[-1]
    assert second["alert"] and second["retraining_recommended"] and second["consecutive_drift_checks"] == 2
    again = monitor.check(new, 2).collect()
    assert len(again) == 2 and again[-1]["consecutive_drift_checks"] == 2  # a repeated batch counts once


def test_all_channels(spark, tmp_path):
    ref, new = _frames(spark)
    y = F.when(F.col("segment") == "a", "0").otherwise("1")
    ref = ref.withColumns({"y": y, "p": F.col("amount") / 10})
    new = new.withColumns({"extra": F.lit(1), "y": F.when(F.col("amount") == 105, "2").otherwise(y), "p": F.lit(0.9),
                           "amount": F.when(F.col("amount") != 100, F.col("amount"))})
    roles = W.BatchColumns(label="y", probability="p")
    profile = W.build_profile(ref, ["amount"], ["segment"], roles)
    profile.save(str(tmp_path / "profile"))
    loaded = W.ReferenceProfile.load(spark, str(tmp_path / "profile"))
    row = W.with_persistence(W.check_batches(loaded, new.withColumn("b", F.lit(1)), ["b"], roles), "b", W.MonitorConfig(persistence=1)).first()
    assert row["alert"] and row["schema_skew"] and row["novel_classes"] == ["2"]
    assert row["prediction_drift"] and row["quality_drift"] and row["quality_columns"] == ["amount"]


def test_duplicate_rate_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", None), ("y", "y")], "a string, b string")
    assert duplicate_rate(df).first()[0] == pytest.approx(0.25)


def test_conformal_sets(spark):
    df = spark.createDataFrame([(i, int(p > 0.5), [1 - p, p]) for i, p in enumerate((0.2, 0.4, 0.6, 0.8))], "x int, y int, probs array<double>")
    rows, summary = U.classification_uncertainty(df, df)
    s = summary.first()
    assert s["method"] == "split_conformal_classification" and s["qhat"] == pytest.approx(0.4)
    assert rows.where("set_size < 1").count() == 0


def test_thresholds(spark):
    df = spark.createDataFrame([(0, .1), (0, .4), (1, .35), (1, .8), (1, .9)], "y int, p double")
    best = H.tune_threshold(df, H.ThresholdPolicy("fbeta", beta=2.0)).first()
    assert best["recall"] == 1.0
    assert H.tune_threshold(df, H.ThresholdPolicy("disabled")).first()["threshold"] == 0.5
    assert H.ThresholdPolicy().resolved("auprc").mode == "f1" and H.ThresholdPolicy().resolved("r2").mode == "disabled"
    with pytest.raises(ValueError):
        H.ThresholdPolicy("nonsense").resolved()


def test_too_many_candidates_are_refused(spark):
    df = spark.createDataFrame([(0, .1), (1, .9)], "y int, p double")
    with pytest.raises(Exception, match="candidate thresholds"):
        H.threshold_scores(df, spark.range(5000).select((F.col("id") / 5000).alias("threshold"))).collect()


def test_perfect_and_tied_ranking(spark):
    df = spark.createDataFrame([(0, .5), (1, .5), (0, .1), (1, .9)], "y int, p double")
    row = M.ranking_metrics(df).first()
    assert row["roc_auc"] == pytest.approx(0.875)
    one_class = spark.createDataFrame([(1, .5), (1, .6)], "y int, p double")
    assert M.ranking_metrics(one_class).first()["roc_auc"] is None


def test_score_of_one_is_in_no_bin_unless_asked(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 0.05)], "y int, p double")
    assert M.calibration_metrics(df).first()["ece"] == pytest.approx(0.5 * 0.95)
    assert M.calibration_metrics(df, include_one=True).first()["ece"] == pytest.approx(0.5 * 0.95 + 0.5)


def test_mode_ties_go_to_the_smaller_number(spark):
    df = spark.createDataFrame([(9,), (10,), (9,), (10,), (None,)], "n int")
    assert E.fit_mode_imputer(df, ["n"]).values == {"n": 9}


def test_scoring_input(spark):
    spec = K.ScoringSpec(("amount", "merchant"), version="20260101_000000_abc123", threshold=0.5, dropped=("legacy_score",))
    df = spark.createDataFrame([(1.0, "m", 3)], "amount double, merchant string, legacy_score int")
    rows, warnings = K.check_input(df, spec)
    assert rows.columns == ["amount", "merchant"] and "legacy_score" in warnings[0]
    with pytest.raises(ValueError, match="merchant"):
        K.check_input(df.drop("merchant"), spec)
    with pytest.raises(ValueError, match="no rows"):
        K.check_input(df.limit(0), spec)
    scored = rows.withColumns({"probs": F.array(F.lit(.25), F.lit(.75)), "p": F.lit(.75), "prediction": F.lit(1)})
    body = T.StructType.fromDDL("model_version string, n_rows bigint, predictions array<int>, positive_proba array<double>, warnings array<string>")
    doc = K.envelope(scored, spec, warnings, "amount").select(F.from_json("response", body).alias("r")).select("r.*").first()
    assert (doc["model_version"], doc["predictions"], doc["positive_proba"]) == ("20260101_000000_abc123", [1], [.75])


def test_materialize_reads_back_what_was_written_first(spark, tmp_path):
    first = readers.materialize(spark.range(3), str(tmp_path), "key")
    second = readers.materialize(spark.range(9), str(tmp_path), "key")
    assert first.count() == second.count() == 3

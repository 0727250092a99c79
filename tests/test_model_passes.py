"""What the model queries share: the split, the encoding, the scores of small trees and the order by hash."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from veldtab.operators import diagnostics as G
from veldtab.operators import models as I
from veldtab.operators import prep as E
from veldtab.operators.metrics import ranking_metrics, score_counts
from veldtab.operators.splits import stratified_holdout, with_cut_index, written_holdout


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(4000, numPartitions=4).select(
        "id", (F.col("id") * 7919 % 4001 / 40.0).alias("a"), (F.col("id") % 17).cast("double").alias("b"),
        ((F.col("id") * 7919 % 4001 + F.col("id") % 5 * 300) > 2400).cast("int").alias("y"), F.concat(F.lit("k"), F.col("id") % 9).alias("c"))


def test_the_written_holdout_is_the_stratified_one_and_reads_its_table_once(rows):
    odd = rows.withColumn("y", F.when(F.col("id") % 11 > 0, F.col("y"))).unionByName(rows.where("id < 50"))
    written = written_holdout(odd, "y", ["id"])
    plain = stratified_holdout(odd, "y", ["id"])
    assert written.columns == plain.columns
    assert written.exceptAll(plain).isEmpty() and plain.exceptAll(written).isEmpty()
    assert all("/veldtab/" in f for f in written.inputFiles())
    assert "Range" not in written._jdf.queryExecution().optimizedPlan().toString()


def test_rows_are_not_exchanged_for_the_encoding_of_the_other_folds(rows):
    out = E.cross_fit_encoding(rows.withColumn("f", F.col("id") % 3), "c", "y", "f", "e")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    found = {(r["f"], r["c"]): r["e"] for r in out.select("f", "c", "e").distinct().collect()}
    assert len(found) == 27 // (9 // 3) and all(0 <= e <= 1 for e in found.values())


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_small_trees_score_as_their_transform(rows, task):
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol=I.FEATURES).transform(rows)
    model = I.tree_estimator(task, I.TreeParams(4, 3, 0.3, 1.0, 1.0, 1)).fit(vectors)
    assert I.margin_sql(model, "_x")
    value, plain = ("p", F.element_at(I.vector_to_array("probability"), 2)) if task == "classification" else ("yhat", F.col("prediction"))
    mine = I.scored(model, vectors, task)
    assert "UDF(features" in mine._jdf.queryExecution().optimizedPlan().toString()
    assert mine.count() == 4000
    both = model.transform(mine.withColumnRenamed(value, "_mine")).select(F.abs(F.col("_mine") - plain).alias("gap"), "_mine")
    assert both.agg(F.max("gap")).first()[0] < 1e-12
    assert both.select("_mine").distinct().count() > 3


def test_large_or_categorical_trees_keep_their_transform(rows, monkeypatch):
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol=I.FEATURES).transform(rows)
    model = I.tree_estimator("regression", I.TreeParams(2, 2)).fit(vectors)
    monkeypatch.setattr(I, "EXPRESSION_NODES", 2)
    assert I.margin_sql(model, "_x") is None
    assert "yhat" in I.scored(model, vectors, "regression").columns


def test_order_by_hash_is_that_of_the_hashes_and_can_stop(rows):
    hashed = rows.withColumn("h", G.hash_order(5, ["id"])).select("id", "h").toPandas().sort_values("h")
    places = G._ranked(rows.select("id"), 5, ["id"], "place")
    assert [r["id"] for r in places.orderBy("place").collect()] == list(hashed["id"])
    some = G._ranked(rows.select("id"), 5, ["id"], "place", 70)
    assert [(r["place"], r["id"]) for r in some.orderBy("place").collect()] == list(enumerate(hashed["id"][:70]))


def test_contributions_need_no_window_over_the_steps(rows):
    score = lambda df: df.withColumn("value", F.col("a") * 2 + F.col("b"))
    phi = G.contributions(rows.select("id", "a", "b"), score, ["a", "b"], ["id"], max_rows=300, background=16, draws=3)
    assert "lag(" not in phi._jdf.queryExecution().optimizedPlan().toString()
    assert phi.count() == 600
    # A sum of features gives each feature the same whatever the order, so that both add up to the gap to the mean of the drawn rows.
    total = phi.groupBy("row").agg(F.sum("phi").alias("s"), F.count("*").alias("n"))
    assert total.where("n <> 2").isEmpty() and total.agg(F.countDistinct(F.round("s", 6))).first()[0] > 100


def test_ranking_small_trees_computes_each_slot_and_each_tree_once_a_row(rows):
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol=I.FEATURES).transform(rows)
    model = I.tree_estimator("classification", I.TreeParams(4, 3, 0.3, 1.0, 1.0, 1)).fit(vectors)
    counts = score_counts(I.scored(model, vectors, "classification"))
    first = counts._jdf.queryExecution().optimizedPlan().toString()
    tests = [line for line in first.splitlines() if "Filter" in line]
    assert not any("UDF" in line or "CASE WHEN" in line for line in tests)
    plain = [(float(r["probability"][1]), r["y"]) for r in model.transform(vectors).collect()]
    found = ranking_metrics(I.scored(model, vectors, "classification")).first()["roc_auc"]
    good, bad = [p for p, y in plain if y == 1], [p for p, y in plain if y == 0]
    won = sum((a > b + 1e-12) + 0.5 * (abs(a - b) <= 1e-12) for a in set(good) for b in set(bad) for _ in range(good.count(a) * bad.count(b)))
    assert abs(found - won / len(good) / len(bad)) < 1e-9


def test_parts_of_a_split_are_read_without_a_function_of_the_cuts(rows):
    odd = rows.withColumn("y", F.when(F.col("id") % 11 > 0, F.col("y")))
    cut = with_cut_index(odd, "y", ["id"], 7, lambda n: [F.lit(10), F.lit(30), n], "part")
    assert "lambda" not in cut.where("part = 1")._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["y"], r["part"]): r["count"] for r in cut.groupBy("y", "part").count().collect() if r["y"] is not None and r["part"] < 2} == {
        (0, 0): 10, (0, 1): 20, (1, 0): 10, (1, 1): 20}
    assert [r["part"] for r in cut.where("y is null").select("part").distinct().collect()] == [3]

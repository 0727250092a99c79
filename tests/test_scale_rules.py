"""No caps, prefixes or switches by size; shared storage is required."""

import math

import pytest
from pyspark.sql import functions as F

from veldtab.functions.distributions import chi2_sf
from veldtab.operators import diagnostics as G
from veldtab.operators import models as I
from veldtab.operators import prep as E
from veldtab.operators.splits import stratified_holdout
from veldtab.sources import storage


def even_tail(stat: float, df: int) -> float:
    """The tail for even degrees of freedom as a sum of Poisson probabilities."""
    h = stat / 2
    return math.fsum(math.exp(i * math.log(h) - h - math.lgamma(i + 1)) for i in range(df // 2))


def test_chi_squared_tail_for_all_sizes(spark):
    rows = [(float(x), df) for df in (2, 10, 1000, 19_998, 20_002, 60_000) for x in (0.9 * df, float(df), df + 2 * math.sqrt(2 * df), 1.3 * df)]
    got = spark.createDataFrame(rows, "x double, df long").select("x", "df", chi2_sf(F.col("x"), F.col("df")).alias("p")).collect()
    assert all(r.p == pytest.approx(even_tail(r.x, r.df), abs=1e-9) for r in got)
    odd = spark.createDataFrame([(0.1, 1), (3.84, 1), (40.0, 1)], "x double, df long").select("x", chi2_sf(F.col("x"), F.col("df")).alias("p")).collect()
    assert all(r.p == pytest.approx(math.erfc(math.sqrt(r.x / 2)), rel=1e-6) for r in odd)


def test_long_names_keep_every_candidate(spark):
    names = [("column " * 13)[:85] + str(i) for i in range(3)]
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 3.0), (4.0, 7.0, 1.0)], names)
    fitted = E.fit_generated_features(df, names, max_features=100)
    assert len(fitted.names) == len(set(fitted.names)) == 6 and len(fitted.transform(df).columns) == 9
    clash = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 3.0), (4.0, 7.0, 1.0)], ["a b", "a_b", "c"])
    assert len(fit := E.fit_generated_features(clash, clash.columns, max_features=100).names) == len(set(fit)) == 6


def test_shared_folder_must_be_named(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(spark)


def test_splits_do_not_exchange_rows_by_class(spark):
    df = spark.range(20_000).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    out = stratified_holdout(df, "y", ["id"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan


def test_search_says_when_nothing_was_fitted(spark):
    from pyspark.ml.feature import VectorAssembler
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(spark.range(40).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("y")))
    with pytest.raises(ValueError):
        I.search(df, "classification", "roc_auc", "y", ["id"], n_trials=1, folds=1)
    with pytest.raises(ValueError):
        I.search(df, "classification", "roc_auc", "y", ["id"], n_trials=1, strategy="holdout")
    trials = I.search(df, "classification", "accuracy", "y", ["id"], n_trials=1, n_estimators=(2, 2), folds=3, strategy="time", time_col="id").collect()
    assert [t.state for t in trials] == ["complete"]


def test_places_are_a_permutation_without_one_task(spark):
    df = spark.range(500).withColumn("k", F.col("id") % 250)
    ranked = G._ranked(df, 3, ["id"], "n")
    assert sorted(r.n for r in ranked.collect()) == list(range(500))
    tied = G._ranked(df, 3, ["k"], "n")
    assert sorted(r.n for r in tied.collect()) == list(range(500))


def test_target_encoding_of_noise_tells_nothing_about_train_rows(spark):
    from veldtab.operators.profiling import FeatureRoles
    noise = spark.range(6_000).select("id", F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(1_500))).alias("c"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2))).cast("int").alias("y"))
    train, test = noise.where("id % 4 <> 0"), noise.where("id % 4 = 0")
    prep = I.fit_preparation(train, FeatureRoles((), (), ("c",)), "y")
    corr = lambda df: abs(df.select(F.corr("y", F.element_at(F.expr("transform(array(t_c), x -> x)"), 1))).first()[0])
    assert corr(prep.transform(train)) > 0.3
    assert corr(prep.transform_train(train, "y", ["id"])) < 0.15 and corr(prep.transform(test)) < 0.1

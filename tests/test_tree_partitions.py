"""Blocks of the booster and the partitions of ``pyspark.ml`` fits."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from veldtab.operators import boosting as B
from veldtab.operators import models as I


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 6000, 1, 2).select("id", F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("features"),
                                             (F.col("id") % 7 + F.col("id") % 11 > 8).cast("double").alias("y"))


def test_booster_keeps_blocks_not_rows(rows):
    fit = B.Boosting(rows, B.Loss("logistic"), B.TreeParams(1, 2, 0.5, 1.0, 1.0), key_cols=["id"], validation=rows.where("id < 10"))
    assert fit.rows.count() < 10
    kept = sum(len(b["y"]) // 8 for b in fit.rows.collect())
    assert kept == 6010 and all(len(b["bins"]) == 2 * len(b["held"]) == len(b["y"]) // 4 for b in fit.rows.collect())


def test_feature_vectors_of_other_lengths_are_refused():
    with pytest.raises(ValueError):
        B.matrix(pa.array([[1.0, 2.0], [1.0], [1.0, 2.0, 3.0]]))
    with pytest.raises(ValueError):
        B.matrix(pa.array([[1.0, 2.0], None]))
    assert np.array_equal(B.matrix(pa.array([[1.0, None], [2.0, 3.0]])), [[1.0, np.nan], [2.0, 3.0]], equal_nan=True)


def test_large_fits_are_dealt_into_bounded_partitions(spark, rows, monkeypatch):
    vectors = rows.withColumn("features", array_to_vector("features")).withColumn("weight", F.lit(1.0)).coalesce(1)
    seen = []

    class Recorded(I.GBTClassifier):
        def fit(self, df, params=None):
            seen.append((sorted(df.columns), sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())))
            return super().fit(df, params)

    make = lambda: Recorded(featuresCol="features", labelCol="y", weightCol="weight", maxIter=2, maxDepth=2, seed=1)
    whole = I.fit_spread(make(), vectors)
    monkeypatch.setattr(I, "ROWS_PER_TASK", 300)
    dealt = I.fit_spread(make(), vectors)
    assert seen[0][1] == [6000] and seen[1] == (["features", "weight", "y"], [300] * 20)
    assert np.allclose(whole.featureImportances.toArray(), dealt.featureImportances.toArray())


def test_trials_share_the_bins_of_their_rows(rows, monkeypatch):
    made = []
    binned = B.Boosting._binned
    monkeypatch.setattr(B.Boosting, "_binned", lambda self, df: made.append(1) or binned(self, df))
    trials = I.search(rows, "classification", "roc_auc", "y", ["id"], n_trials=3, n_estimators=(1, 2), folds=2)
    assert len(made) == 2 and trials.where("state = 'complete'").count() == 3
    members = I.fit_ensemble(rows, trials, "classification", 2, key_cols=["id"])
    assert len(made) == 3
    alone = I.fit_trees(rows, "classification", I.trial_params(I.best_trials(trials, 2)[1]), key_cols=["id"])
    assert members[1].rounds == alone.rounds and members[1].base == alone.base and members[1].rate == alone.rate

"""Block power iteration against singular values, and tree dependence against scoring every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from veldtab.operators import boosting as B
from veldtab.operators import components as P
from veldtab.operators import diagnostics as G


def frame(spark, x, parts=6):
    return spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(x)], "id long, v array<double>").repartition(parts)


def test_wide_table(spark):
    """2,000 columns, 50 components: the subspace of the exact decomposition."""
    rng = np.random.default_rng(1)
    n, d, k = 500, 2000, 50
    left, right = np.linalg.qr(rng.standard_normal((n, 80)))[0], np.linalg.qr(rng.standard_normal((d, 80)))[0]
    x = (left * np.geomspace(100, 0.05, 80)) @ right.T + 3.0 + np.arange(d) % 7
    found = P.fit_top_components(frame(spark, x, 4), "v", k)
    centred = x - x.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert found.n == n and found.basis.shape == (d, k)
    assert abs(found.basis.T @ found.basis - np.eye(k)).max() < 1e-10
    assert np.linalg.norm(found.basis - vt[:k].T @ (vt[:k] @ found.basis), 2) < 1e-6
    assert found.variances == pytest.approx(s[:k] ** 2 / (n - 1), rel=1e-8)


def test_coordinates_missing_values_and_few_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 5)) * [5, 3, 2, 1, 0.5]
    df = frame(spark, x).unionByName(spark.createDataFrame([(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [1.0, float("nan"), 1.0, 1.0, 1.0])], "id long, v array<double>"))
    found = P.fit_top_components(df, "v", 3)
    rows = {r.id: r.components for r in found.project(df, "v").collect()}
    got = np.array([rows[i] for i in range(60)])
    assert found.n == 60 and all(rows[i] is None for i in (100, 101, 102))
    assert np.cov(got.T) == pytest.approx(np.diag(found.variances), abs=1e-9)
    assert found.variances == pytest.approx(np.linalg.eigvalsh(np.cov(x.T))[::-1][:3], rel=1e-9)
    few = P.fit_top_components(frame(spark, x[:3]), "v", 5)
    assert len(few.variances) == 2 and P.fit_top_components(frame(spark, x[:1]), "v", 2).variances == pytest.approx([0.0])
    with pytest.raises(ValueError):
        P.fit_top_components(df.limit(0), "v", 2)


def test_tree_dependence_equals_scoring_every_row(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.standard_normal((400, 4)), 2)
    x[:, 1] = np.round(x[:, 0] + 0.3 * x[:, 1], 2)
    x[5, 2] = np.nan
    y = x[:, 0] * np.nan_to_num(x[:, 2]) + np.abs(x[:, 1])
    df = spark.createDataFrame([(i, list(map(float, r)), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, features array<double>, y double").repartition(3)
    model = B.fit_boosted(df, B.Loss("squared"), B.TreeParams(6, 3, 0.5, 1.0, 1.0, 3), key_cols=["id"])
    grid = {f: [-2.0, -0.31, 0.0, 0.7, 3.0] for f in range(4)}
    found = G.tree_dependence(model, df, grid).collect()
    assert len(found) == 20
    for r in found:
        moved = x.copy()
        moved[:, r.feature] = r.grid
        assert r.mean_value == pytest.approx(model.margins(moved)[:, 0].mean(), abs=1e-9) and r.n_rows == 400
    assert len({round(r.mean_value, 9) for r in found if r.feature == 0}) > 2
    three = B.fit_boosted(df.withColumn("y", F.col("id") % 3), B.Loss("softmax", 3), B.TreeParams(2, 2, 0.5, 1.0, 1.0, 1), key_cols=["id"])
    for r in G.tree_dependence(three, df, {1: [0.2]}, output=2).collect():
        moved = x.copy()
        moved[:, 1] = 0.2
        assert r.mean_value == pytest.approx(three.margins(moved)[:, 2].mean(), abs=1e-9)

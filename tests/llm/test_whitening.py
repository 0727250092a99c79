"""Operator 11 against numpy's eigenvalue routine and exact integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veldtab.llm import whitening
from veldtab.llm.common import table

SF = "/root/testdata/sf0.001"


def usable(vector, dims):
    return vector is not None and len(vector) == dims and all(c is not None and math.isfinite(c) for c in vector)


def on_grid(rows, dims):
    return [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if usable(v, dims)]


def check(rows, found, dims, error=1e-4):
    """Rows of (vec_id, component, n, deviation, whitened, explained, identity_error) against the plain computation."""
    kept = on_grid(rows, dims)
    n, x = len(kept), np.array([v for _, v in kept], float)
    sums = [sum(v[j] for _, v in kept) for j in range(dims)]
    z = x - x.mean(axis=0)
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(32, int((values > 1e-13 * np.trace(cov)).sum()))
    assert len(found) == n * count and {r.component for r in found} == set(range(1, count + 1))
    by_id = {i: v for i, v in kept}
    at = {i: k for k, (i, _) in enumerate(kept)}
    got = np.full((n, count), np.nan)
    for r in found:
        got[at[r.vec_id], r.component - 1] = r.whitened
        assert r.n == n and r.deviation == sum((n * c - s) ** 2 for c, s in zip(by_id[r.vec_id], sums))
        assert math.isclose(r.explained, values[r.component - 1] / np.trace(cov), rel_tol=1e-6) and r.identity_error <= error
    assert abs(got.T @ got / n - np.eye(count)).max() <= error
    gap = np.abs(np.subtract.outer(values[:count], values)) + np.eye(count, len(values)) * values[0]
    for k in np.flatnonzero(gap.min(axis=1) > 1e-6 * values[0]):
        want = z @ vectors[:, k] / math.sqrt(values[k])
        assert min(abs(got[:, k] - want).max(), abs(got[:, k] + want).max()) < 1e-6


def test_query(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    check(rows, whitening.op11_whitened_embeddings(spark, SF).collect(), 64)


ODD = [(1, [1.0, 2.0, -3.0]), (2, None), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 1.0, 1.0]), (6, []), (7, [1.0]),
       (8, [-0.01, 100.5, 7.0]), (9, [5.0, 5.0, 5.0]), (10, [1.0, 2.0, -3.0]), (11, [1e300, 0.0, 0.0]), (12, [2.5, -1.0, 0.3])]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.withColumns({c: F.lit("x") for c in ("id", "vector", "n", "whitened", "deviation", "row", "component")}).repartition(3)


def named(spark, df):
    model = whitening.fit_whitening(df)
    rows = whitening.whiten(df, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return [spark_row for spark_row in rows.withColumns({"component": F.col("at") + 1, "n": F.lit(model.centre.n), "identity_error": F.lit(model.identity_error),
                                                          "explained": F.get(F.array(*map(F.lit, model.explained.tolist())), "at")}).collect()]


def test_odd_rows(spark):
    check([r for r in ODD if r[0] != 11], named(spark, frame(spark, ODD)), 3)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None), (2, []), (3, [None])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = frame(spark, rows)
        assert whitening.whiten(df, whitening.fit_whitening(df)).collect() == []


def test_constant_and_dependent_dimensions(spark):
    rng = np.random.default_rng(5)
    a = rng.standard_normal((200, 3))
    check(rows := [(i, [float(r[0]), 4.0, float(r[1]), float(r[0])]) for i, r in enumerate(a)], named(spark, frame(spark, rows)), 4)


def test_large_deviations_are_null_and_exact_before(spark):
    centre = whitening.Centre(10 ** 9, [10 ** 15, 10 ** 15])
    assert centre.deviation(np.array([[10 ** 6, 10 ** 6 + 2], [10 ** 6, 10 ** 6 + 5]])) == [4 * 10 ** 18, None]


@pytest.mark.parametrize("values", [[1.0] * 7, [3.0] * 10 + [2.0] * 10 + [1e-9] * 10, list(np.geomspace(1, 1e-12, 40)), [0.0, 0.0, 5.0], [2.0, -1.0, -1.0, 0.0]])
def test_spectral(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(d).standard_normal((d, d)))[0]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    e, v = whitening.spectral(a)
    assert abs(np.sort(e) - np.sort(values)).max() < 1e-13 * max(map(abs, values)) * d
    assert abs(v.T @ v - np.eye(d)).max() < 1e-13 and abs(v.T @ a @ v - np.diag(e)).max() < 1e-13 * d
    few, w = whitening.spectral(a, 3)
    assert abs(few[:3] - np.sort(values)[::-1][:3]).max() < 1e-12 and w.shape[0] == d

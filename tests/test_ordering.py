"""Running sums, order statistics and splits against brute force, with ties, signs and hot keys."""

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veldtab.functions import ordering as O
from veldtab.functions.distributions import chi2_sf, ks_asymptotic, ks_exact, ks_pvalue
from veldtab.operators import drift as D
from veldtab.operators import splits as S


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1, 3000), rng.integers(-5, 5, 3000), 1.7e15 + rng.integers(0, 2000, 2000),
                        [0.0, -0.0, 1e-300, -1e-300, 1e300, -1e300, 5e-324], np.full(4000, 2.5)])
    return pd.DataFrame({"k": rng.choice(["a", "b"], len(v), p=[0.9, 0.1]), "v": v, "n": rng.integers(0, 4, len(v))})


@pytest.mark.parametrize("levels", [2, 3])
def test_prefix_sum(spark, values, levels):
    got = O.prefix_sum(spark.createDataFrame(values), ["k"], "v", ["n"], levels=levels).toPandas()
    want = (values.assign(v=values["v"] + 0.0).groupby(["k", "v"], as_index=False)["n"].sum().sort_values(["k", "v"]))
    want["below_n"] = want.groupby("k")["n"].cumsum() - want["n"]
    want["total_n"] = want.groupby("k")["n"].transform("sum")
    got = got.assign(v=got["v"] + 0.0).sort_values(["k", "v"])[["k", "v", "n", "below_n", "total_n"]]
    pd.testing.assert_frame_equal(got.reset_index(drop=True), want.reset_index(drop=True), check_dtype=False)


def test_bucket_keys_are_monotone(spark, values):
    ordered = spark.createDataFrame(values).select("v", O.coarse_key(F.col("v")).alias("c"), O.fine_key(F.col("v")).alias("f")).toPandas().sort_values("v")
    assert (ordered["c"].diff().dropna() >= 0).all() and (ordered["f"].diff().dropna() >= 0).all()


@pytest.mark.parametrize("leaf_rows", [O.LEAF_ROWS, 1])
def test_exact_quantiles(spark, values, leaf_rows, monkeypatch):
    monkeypatch.setattr(O, "LEAF_ROWS", leaf_rows)
    probs = [0.0, 0.001, 0.25, 0.5, 0.77, 1.0]
    got = O.exact_quantiles(spark.createDataFrame(values), ["k"], "v", probs).collect()
    assert len(got) == 2 * len(probs)
    for row in got:
        want = np.quantile(values.loc[values["k"] == row["k"], "v"], row["probability"])
        assert row["quantile"] == pytest.approx(want, rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("leaf_rows", [O.LEAF_ROWS, 1])
def test_split_sizes_are_exact_with_a_hot_class(spark, leaf_rows, monkeypatch):
    monkeypatch.setattr(O, "LEAF_ROWS", leaf_rows)
    n = 5000
    df = spark.createDataFrame(pd.DataFrame({"id": range(n), "c": ["hot" if i % 10 else "rare" for i in range(n)]}))
    got = {(r["c"], r["split"]): r["count"] for r in S.stratified_holdout(df, "c", ["id"]).groupBy("c", "split").count().collect()}
    assert got["hot", "test"] == 900 and got["rare", "test"] == 100
    assert got["hot", "val"] == 540 and got["rare", "val"] == 60
    assert sum(got.values()) == n


def test_rows_without_a_class_are_kept(spark):
    df = spark.createDataFrame([(i, None if i < 7 else "x") for i in range(50)], "id int, c string")
    out = S.stratified_holdout(df, "c", ["id"])
    assert out.count() == 50 and out.where("c is null and split = 'train'").count() == 7


def test_folds_cover_every_row_once(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "id int, c int")
    sizes = [r["count"] for r in S.stratified_folds(df, "c", ["id"], 5).groupBy("fold", "c").count().collect()]
    assert sizes == [20] * 15


def test_ks_against_equals_pairwise(spark):
    rng = np.random.default_rng(5)
    ref = spark.createDataFrame(pd.DataFrame({"x": rng.normal(0, 1, 2000).round(1)}))
    new = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 1500, p=[0.8, 0.15, 0.05]), "x": rng.normal(0.2, 1, 1500).round(1)})
    got = {r["g"]: r["statistic"] for r in D.ks_against(D.value_counts(ref, ["x"]), spark.createDataFrame(new), ["x"], ["g"]).collect()}
    a = np.sort(ref.toPandas()["x"])
    for g, part in new.groupby("g"):
        b = np.sort(part["x"])
        grid = np.concatenate([a, b])
        want = np.abs(np.searchsorted(a, grid, "right") / len(a) - np.searchsorted(b, grid, "right") / len(b)).max()
        assert got[g] == pytest.approx(want, abs=1e-12)


def test_tail_probabilities(spark):
    # Known values: chi-squared tails at the usual critical points, Kolmogorov tail at lambda = 1.36.
    rows = [(3.841458820694124, 1, .05), (5.991464547107979, 2, .05), (18.307038053275146, 10, .05), (124.3421134, 100, .05), (0.0, 3, 1.0)]
    df = spark.createDataFrame(rows, "x double, df int, p double")
    for r in df.select("p", chi2_sf(F.col("x"), F.col("df")).alias("q")).collect():
        assert r["q"] == pytest.approx(r["p"], abs=1e-7)
    p = spark.range(1).select(ks_asymptotic(F.lit(1.0), F.lit(6), F.lit(6)).alias("p")).first()["p"]
    assert p == pytest.approx(0.00496, abs=1e-5)


def arrangements(n, m):
    """Distance of every merged order of n and m values, in units of 1/(n m)."""
    out = []
    for mine in combinations(range(n + m), n):
        i, far = 0, 0
        for k in range(n + m):
            i += k in mine
            far = max(far, abs(i * m - (k + 1 - i) * n))
        out.append(far)
    return out


@pytest.mark.parametrize("n,m", [(1, 1), (1, 5), (2, 7), (3, 3), (4, 6), (5, 5), (6, 4), (6, 7)])
def test_exact_two_sample_law(spark, n, m):
    far = arrangements(n, m)
    rows = [(d / (n * m), n, m, sum(x >= d for x in far) / len(far)) for d in sorted(set(far))]
    df = spark.createDataFrame(rows, "d double, n long, m long, want double")
    assert all(abs(r.want - r.p) < 1e-12 for r in df.withColumn("p", ks_pvalue(F.col("d"), F.col("n"), F.col("m"))).collect())


def test_two_sample_law_for_more_values(spark):
    # all values of the smaller sample on one side: 2 of C(n+m, n) orders; the exact law nears the asymptotic one; beyond the limit it is used
    assert ks_exact(1.0, 30, 40) == pytest.approx(2 / math.comb(70, 30), rel=1e-9)
    rows = [(0.02, 10_000, 10_000), (0.02, 10_001, 10_000), (0.4238095, 20, 21), (8 / 11, 5, 11), (0.0, 5, 5)]
    df = spark.createDataFrame(rows, "d double, n long, m long")
    p = [r.p for r in df.select(ks_pvalue(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    q = [r.p for r in df.select(ks_asymptotic(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    assert p[0] != q[0] and p[0] == pytest.approx(q[0], abs=2e-3) and p[1] == q[1] and p[4] == 1
    assert p[2] == pytest.approx(0.0283, abs=1e-4) and p[3] == pytest.approx(0.0293, abs=1e-4)

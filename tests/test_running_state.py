"""Segmented scan, masked correlations, closing windows and triggers against plain versions."""

import random
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from veldtab.functions import ordering as O
from veldtab.operators import curves as L
from veldtab.operators import monitor as W
from veldtab.operators import prep as E
from veldtab.sources.storage import fresh_path
from veldtab.streaming import jobs as S


def plain_scan(rows):
    """(group, order) -> (position, since, high) of (group, order, reset, add, high)."""
    out, state = {}, {}
    for g, o, reset, add, high in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1])):
        n, since, top = state.get(g, (0, 0, None))
        since = (0 if reset else since) + (add or 0)
        top = high if top is None else top if high is None else max(top, high)
        state[g] = n + 1, since, top
        out[g, o] = state[g]
    return out


@pytest.mark.parametrize("kind", ["int", "negative", "double", "text", "time"])
def test_segmented_scan(spark, kind):
    rng = random.Random(kind)
    order = {"int": lambda k: k * 37, "negative": lambda k: k - 300, "double": lambda k: float(2.0 ** (k % 40) + k) * (-1) ** k, "text": lambda k: f"2024-{k // 40:02d}-{k % 40:02d} {k:05d}",
             "time": lambda k: datetime(2024, 1, 1) + timedelta(minutes=7 * k)}[kind]
    rows = [(g, order(k), rng.random() < rng.choice([0.02, 0.5]), rng.choice([None, 1, 1, 2]), rng.choice([None, rng.random()])) for g in ("a", None) for k in rng.sample(range(600), 500)]
    df = spark.createDataFrame(rows, f"g string, o {dict(int='long', negative='int', double='double', text='string', time='timestamp_ntz')[kind]}, r boolean, a int, h double").repartition(7)
    want = plain_scan(rows)
    got = O.segmented_scan(df, ["g"], "o", reset=F.col("r"), add=F.col("a"), high=F.col("h")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r._position, r._since, r._high) == want[r.g, r.o], (r.g, r.o)
    alone = O.segmented_scan(df.where("g = 'a'").drop("g"), [], "o", reset=F.col("r"), add=F.col("a"), high=F.col("h")).collect()
    assert len(alone) == 500 and max(r._position for r in alone) == 500
    assert O.segmented_scan(df.limit(0), ["g"], "o").count() == 0


def test_no_task_orders_all_rows(spark):
    """Many buckets, and no window without a key over rows."""
    n = 1_000_000
    df = spark.range(n).select("id", (F.col("id") % 1000 != 0).alias("drifting"))
    out = O.segmented_scan(df, [], "id", reset=~F.col("drifting"), add=F.col("drifting"), high=F.col("id").cast("double"))
    assert df.select(O.order_bucket(df, "id").alias("b")).groupBy("b").count().agg(F.max("count")).first()[0] <= n // 500
    wrong = out.where((F.col("_position") != F.col("id") + 1) | (F.col("_since") != F.col("id") % 1000) | (F.col("_high") != F.col("id")))
    assert wrong.count() == 0 and out.count() == n


def test_persistence_and_running_best_with_nulls(spark):
    checks = spark.createDataFrame([(i, d, 0.5 if d else 0.0, "low") for i, d in enumerate([True, True, False, True, None, True])], "k int, drifting boolean, drift_ratio double, severity string")
    rows = {r.k: r for r in W.with_persistence(checks, "k").collect()}
    assert [rows[i].consecutive_drift_checks for i in range(6)] == [1, 2, 0, 1, 1, 2] and [rows[i].check_id for i in range(6)] == [1, 2, 3, 4, 5, 6]
    trials = spark.createDataFrame([(3, 0.2), (1, None), (2, 0.4), (4, 0.9), (5, None)], "trial int, score double")
    assert {r.trial: r.best_so_far for r in L.running_best(trials).collect()} == {1: None, 2: 0.4, 3: 0.4, 4: 0.9, 5: 0.9}


def test_correlations_of_masked_columns(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 6)) * [1, 1e-3, 1e4, 1, 1, 1] + [0, 5, -1e6, 0, 3, 0]
    x[:, 3] = x[:, 0] * 2 + 1
    x[:, 5] = 7.25
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 4] = np.where(np.arange(300) < 298, np.nan, 3.0)
    frame = pd.DataFrame(x, columns=list("abcdef"))
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], "a double, b double, c double, d double, e double, f double").repartition(4)
    got = {(r.a, r.b): r.corr for r in E.correlation_pairs(df, list("abcdef")).collect()}
    want = frame.corr(min_periods=1)
    assert len(got) == 15
    for (a, b), c in got.items():
        if "e" in (a, b) or "f" in (a, b):
            assert c is None
        else:
            assert c == pytest.approx(want.loc[a, b], abs=1e-9)
    assert got["a", "d"] == pytest.approx(1)
    assert all(r.corr is None for r in E.correlation_pairs(df.limit(0), ["a", "b"]).collect())


def test_many_columns_in_one_scan(spark):
    width = 400
    df = spark.range(2000).select(*[(F.xxhash64("id", F.lit(k)) % 1000).cast("double").alias(f"c{k}") for k in range(width)])
    out = E.correlation_pairs(df, df.columns)
    assert out.count() == width * (width - 1) // 2
    some = {(r.a, r.b): r.corr for r in out.where("i = 3 and j < 8").collect()}
    for (a, b), c in some.items():
        assert c == pytest.approx(df.agg(F.corr(a, b)).first()[0], abs=1e-9)


def test_late_rows_are_counted_and_last_window_is_closed(spark):
    schema = "ts timestamp_ntz, value double"
    at = lambda day, v: (datetime(2024, 3, 1, 5) + timedelta(days=day), float(v))
    path, out = fresh_path(spark, "late_in"), fresh_path(spark, "late_out")
    late = {"width": "1 day", "delay": "2 days"}
    struct = spark.createDataFrame([], schema).schema

    def run(rows):
        if rows:
            spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(path)
        stream = S.read_files(spark, path, struct, kind="parquet")
        return S.run_once(S.window_counts(stream, "ts", ["value"], **late), f"{out}/counts", f"{out}/cp")

    assert run([at(0, 1), at(0, 1), at(1, 2), at(3, 4)]) == 0
    assert run([at(2, 3), at(6, 7)]) == 0
    assert run([at(0, 9), at(5, 6)]) == 1
    days = lambda: {(r.window_start.day, r.value): r.n for r in spark.read.parquet(f"{out}/counts").collect()}
    assert (7, 7.0) not in days()
    S.close_windows(spark, path, struct, "ts", at(6, 0)[0], **late)
    assert run([]) == 0
    assert days() == {(1, 1.0): 2, (2, 2.0): 1, (3, 3.0): 1, (4, 4.0): 1, (6, 6.0): 1, (7, 7.0): 1}


def test_monitor_stream_takes_other_triggers(spark):
    ref = spark.range(400).select((F.col("id") % 50).cast("double").alias("x"), (F.col("id") % 3).cast("string").alias("c"))
    profile = W.build_profile(ref, ["x"], ["c"], W.BatchColumns())
    path, out = fresh_path(spark, "trigger_in"), fresh_path(spark, "trigger_out")
    ref.repartition(2).write.parquet(path)
    stream = S.read_files(spark, path, ref.schema, kind="parquet", files_per_batch=1)
    query = S.monitor_stream(stream, profile, f"{out}/history", f"{out}/cp", trigger={"processingTime": "1 second"})
    try:
        deadline = time.time() + 120
        while time.time() < deadline and len([p for p in query.recentProgress if p["numInputRows"]]) < 2:
            time.sleep(0.5)
        assert query.isActive
    finally:
        query.stop()
    assert S.read_history(spark, f"{out}/history").agg(F.sum("n_rows")).first()[0] == 400

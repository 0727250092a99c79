"""A4 and M: streaming ingestion, scoring and monitoring over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import SQL_MONITOR, ks_sf, monitor_events, query, rounded, table
from catalog.drift_checks import _F14, _reference
from veldtab.operators import drift as D
from veldtab.operators import monitor as W
from veldtab.operators.scoring import ScoringSpec
from veldtab.operators.thresholds import apply_threshold
from veldtab.streaming import jobs as S
from veldtab.sources.storage import fresh_path


def _landed(df, spark, label, files):
    """Write a table as several files, to be picked up as a stream."""
    path = fresh_path(spark, label)
    df.repartition(files).write.parquet(path)
    return path


@query("a4_m1_chunked_ingestion", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def _(spark, sf):
    base = fresh_path(spark, "chunks")
    table(spark, sf, "events").select("event_id", "event_type", "value").repartition(6).write.option("header", True).csv(f"{base}/in.csv")
    stream = S.read_files(spark, f"{base}/in.csv", "event_id bigint, event_type string, value double", files_per_batch=2)
    S.run_once(stream, f"{base}/out", f"{base}/cp")
    return rounded(spark.read.parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 4)


@query("m2_stream_scoring", f"WITH {SQL_MONITOR} SELECT event_id, round(p, 6) AS p, CAST(p >= 0.4 AS INT) AS pred FROM me")
def _(spark, sf):
    """A stateless score (value over its maximum) with a threshold on a stream of files."""
    df = monitor_events(spark, sf).select("event_id", "p", "event_type")
    path = _landed(df, spark, "score_in", 4)
    stream = S.read_files(spark, path, df.schema, kind="parquet", files_per_batch=2)
    spec = ScoringSpec(("p",), threshold=0.4)
    scored = S.score_stream(stream, lambda rows: apply_threshold(rows, spec.threshold), spec, ["event_id"])
    out = fresh_path(spark, "score_out")
    S.run_once(scored, f"{out}/rows", f"{out}/cp")
    return rounded(spark.read.parquet(f"{out}/rows"))


@query("m2_stream_model_scoring")
def _(spark, sf):
    """A fitted preparation and tree model over a stream of files; same predictions as in batch."""
    from catalog.modelling import FEATURE_COLS, KEY, _fitted, part
    from veldtab.operators import scoring as K
    df, prep, model, spec = _fitted(spark, sf)
    test = part(df, "test").select(*KEY, *FEATURE_COLS)
    path = _landed(test, spark, "model_in", 4)
    stream = S.read_files(spark, path, test.schema, kind="parquet", files_per_batch=2)
    scored = S.score_stream(stream, lambda rows: K.predict(rows, prep, model, spec), spec, KEY).select(*KEY, "p", "prediction")
    out = fresh_path(spark, "model_out")
    S.run_once(scored, f"{out}/rows", f"{out}/cp")
    streamed = spark.read.parquet(f"{out}/rows").groupBy("prediction").agg(F.count("*").alias("n_stream"), F.avg("p").alias("mean_stream"))
    batch = K.predict(test, prep, model, spec).groupBy("prediction").agg(F.count("*").alias("n_batch"), F.avg("p").alias("mean_batch"))
    return rounded(streamed.join(batch, "prediction", "full_outer"))


@query("m3_stream_monitor")
def _(spark, sf):
    """One drift check per arriving micro-batch; counters come from the history."""
    profile = _reference(spark, sf)
    new = monitor_events(spark, sf).where("day > 10").drop("event_id", "ts", "day")
    path = _landed(new, spark, "monitor_in", 4)
    stream = S.read_files(spark, path, new.schema, kind="parquet", files_per_batch=2)
    out = fresh_path(spark, "monitor_out")
    roles = W.BatchColumns(label="y", probability="p")
    S.monitor_stream(stream, profile, f"{out}/history", f"{out}/cp", roles, W.MonitorConfig(persistence=2)).awaitTermination()
    return S.read_history(spark, f"{out}/history", W.MonitorConfig(persistence=2))


@query("m4_window_drift", f"{_F14.replace(chr(39) + 'p' + chr(39) + ' AS feature, p AS v', chr(39) + 'value' + chr(39) + ' AS feature, value AS v')} SELECT day, feature, n AS n_ref, m AS n_new, round(d, 6) AS statistic, round({ks_sf('d', 'n', 'm')}, 6) AS pvalue FROM ks")
def _(spark, sf):
    """Counts per event-time day of rows that arrive up to five days out of order in many files; the last windows are closed, and every day is tested."""
    events = monitor_events(spark, sf)
    reference = D.value_counts(events.where("day <= 10"), ["value"])
    new = events.where("day > 10").select("ts", "value", "day")
    path, out = fresh_path(spark, "window_in"), fresh_path(spark, "window_out")
    columns = new.drop("day")
    for first in range(11, 32, 5):
        new.where(F.col("day").between(first, first + 4)).drop("day").repartition(4).write.mode("append").parquet(path)
    late = {"width": "1 day", "delay": "6 days"}

    def go_on() -> None:
        stream = S.read_files(spark, path, columns.schema, kind="parquet", files_per_batch=3)
        S.run_once(S.window_counts(stream, "ts", ["value"], **late), f"{out}/counts", f"{out}/cp")

    go_on()
    S.close_windows(spark, path, columns.schema, "ts", new.agg(F.max("ts")).first()[0], **late)
    go_on()
    tested = S.window_drift(reference, spark.read.parquet(f"{out}/counts"))
    return rounded(tested.select(F.dayofmonth("window_start").alias("day"), "feature", "n_ref", "n_new", "statistic", "pvalue"))


@query("m5_keyed_persistence", """
WITH c AS (SELECT CAST(s_nationkey AS VARCHAR) AS model_id, s_suppkey AS check_id, s_acctbal > 2000 AS drifting FROM supplier),
g AS (SELECT *, count(*) FILTER (NOT drifting) OVER (PARTITION BY model_id ORDER BY check_id) AS island FROM c),
k AS (SELECT *, CAST(count(*) FILTER (drifting) OVER (PARTITION BY model_id, island ORDER BY check_id) AS INT) AS consecutive_drift_checks FROM g)
SELECT model_id, check_id, drifting, consecutive_drift_checks, consecutive_drift_checks >= 3 AS alert FROM k""")
def _(spark, sf):
    """Counters of many monitored models kept as keyed state over two micro-batches."""
    checks = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("string").alias("model_id"), F.col("s_suppkey").alias("check_id"),
                                                 (F.col("s_acctbal") > 2000).alias("drifting"))
    path, out = fresh_path(spark, "state_in"), fresh_path(spark, "state_out")
    ends = checks.agg(F.min("check_id").alias("low"), F.max("check_id").alias("high")).first()
    half = F.col("check_id") <= (ends["low"] + ends["high"]) // 2 if ends["low"] is not None else F.lit(True)
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for arrived in (half, ~half):
            checks.where(arrived).repartition(4).write.mode("append").parquet(path)
            S.run_once(S.persistence_stream(S.read_files(spark, path, checks.schema, kind="parquet")), f"{out}/rows", f"{out}/cp")
    finally:
        spark.conf.set(provider, before)
    return spark.read.parquet(f"{out}/rows")

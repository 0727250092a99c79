"""Streaming ingestion, scoring and drift monitoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from veldtab.functions.columns import long_form, name
from veldtab.operators.drift import finite, ks_counts
from veldtab.operators.monitor import BatchColumns, MonitorConfig, ReferenceProfile, check_batches, with_persistence
from veldtab.operators.scoring import ScoringSpec, check_input
from veldtab.sources.readers import file_kind, nan_to_null


def read_files(spark: SparkSession, path: str, schema: T.StructType | str, *, kind: str | None = None, files_per_batch: int = 100) -> DataFrame:
    """Files of a folder as a stream, a bounded number per micro-batch."""
    kind = kind or file_kind(path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if kind == "csv":
        reader = reader.option("header", True)
    return nan_to_null(reader.format({"jsonl": "json"}.get(kind, kind)).load(path))


def run_once(df: DataFrame, path: str, checkpoint: str, *, partition: str | None = None) -> int:
    """Append everything that is there to Parquet, exactly once, and stop; the number of rows that came too late for their window."""
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    if partition:
        writer = writer.partitionBy(partition)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], spec: ScoringSpec, keep: list[str] = ()) -> DataFrame:
    """Columns are checked once at the start; scoring itself keeps no state."""
    rows, _ = check_input(stream, spec, list(keep))
    return score(rows)


# -- drift per micro-batch -----------------------------------------------------------------------

def monitor_stream(stream: DataFrame, profile: ReferenceProfile, history_path: str, checkpoint: str, roles: BatchColumns = BatchColumns(),
                   config: MonitorConfig = MonitorConfig(), trigger: dict | None = None) -> StreamingQuery:
    """One drift check per micro-batch; ``trigger`` as Structured Streaming names it ({"processingTime": "1 minute"}), by default all that is there.

    A check is written under its batch id, so a repeated batch overwrites its own row. The counter of
    consecutive drift is derived from the history when it is read, so it needs no state of its own.
    """
    def check(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("check_key", F.lit(batch_id).cast("bigint")).persist()
        try:
            if not keyed.isEmpty():
                record = check_batches(profile, keyed, ["check_key"], roles, config)
                record.coalesce(1).write.mode("overwrite").parquet(f"{history_path}/check={batch_id}")
        finally:
            keyed.unpersist()

    return (stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def read_history(spark: SparkSession, history_path: str, config: MonitorConfig = MonitorConfig()) -> DataFrame:
    return with_persistence(spark.read.parquet(f"{history_path}/check=*"), "check_key", config)


# -- drift per event-time window -----------------------------------------------------------------

def window_counts(stream: DataFrame, time_col: str, cols: list[str], *, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """(window_start, feature, value, n) of finished windows; rows later than ``delay`` are dropped.

    State is one counter per distinct value and open window, so a window with a hot value stays small.
    """
    wall_clock = stream.schema[time_col].dataType.typeName() == "timestamp_ntz"
    zone = F.current_timezone()
    # Watermarks need an instant; wall-clock times are read as UTC so that windows start at midnight.
    ts = F.convert_timezone(F.lit("UTC"), zone, name(time_col)).cast("timestamp") if wall_clock else name(time_col)
    timed = stream.select(ts.alias("_ts"), *[name(c).cast("double").alias(c) for c in cols])
    long = long_form(timed.withWatermark("_ts", delay), ["_ts"], cols, "double")
    counted = (long.withColumn("value", finite(F.col("value"))).where("value is not null")
               .groupBy(F.window("_ts", width), "feature", "value").agg(F.count("*").alias("n")))
    start = F.col("window.start")
    if wall_clock:
        start = F.convert_timezone(zone, F.lit("UTC"), start.cast("timestamp_ntz"))
    return counted.select(start.alias("window_start"), "feature", "value", "n")


def close_windows(spark: SparkSession, path: str, schema: T.StructType, time_col: str, newest, *, width: str = "1 day", delay: str = "1 day") -> None:
    """Append a file with one row without values to the stream's Parquet folder, so late that the watermark passes the end of every open window.

    For the end of a stream: after the next run every window has been emitted, and whatever still arrives is late.
    """
    later = F.lit(newest) + F.expr(f"interval {width}") * 2 + F.expr(f"interval {delay}")
    row = [later.cast(f.dataType).alias(f.name) if f.name == time_col else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    spark.range(1).select(*row).write.mode("append").parquet(path)


def window_drift(reference: DataFrame, counts: DataFrame) -> DataFrame:
    """Test every finished window's counts against the reference (feature, value, n)."""
    return ks_counts(reference, counts, ["window_start"])


# -- persistence as keyed state ------------------------------------------------------------------

COUNTER_SCHEMA = "model_id string, check_id bigint, drifting boolean, consecutive_drift_checks int, alert boolean"


def persistence_stream(checks: DataFrame, persistence: int = 3) -> DataFrame:
    """Consecutive-drift counter of many monitored models at once: (model_id, check_id, drifting) rows in.

    State per model is one integer; a micro-batch's checks of a model are applied in check order.
    """
    class Counter(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.count = handle.getValueState("consecutive", "n int")

        def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
            state = self.count.get() if self.count.exists() else (0,)
            n = int(state[0])
            frame = pd.concat(list(rows)).sort_values("check_id")
            drifting = frame["drifting"].to_numpy(bool)
            at = np.arange(len(drifting))
            calm = np.maximum.accumulate(np.where(drifting, -1, at))
            counts = np.where(calm < 0, n + at + 1, at - calm)
            n = int(counts[-1])
            self.count.update((n,))
            yield pd.DataFrame({"model_id": key[0], "check_id": frame["check_id"].to_numpy(), "drifting": frame["drifting"].to_numpy(),
                                "consecutive_drift_checks": counts, "alert": counts >= persistence})

        def close(self) -> None:
            pass

    return checks.groupBy("model_id").transformWithStateInPandas(
        statefulProcessor=Counter(), outputStructType=COUNTER_SCHEMA, outputMode="Append", timeMode="None")

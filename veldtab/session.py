"""Local session for tests and the benchmark; on a cluster use the session you are given."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession


def local_session(cpus: str | None = None, shuffle_partitions: int | None = None, memory: str = "6g") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("veldtab")
             .config("spark.driver.memory", memory)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if not SparkConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="veldtab-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

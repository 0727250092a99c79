"""Batch readers: file type by extension, glob paths, many files with different columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldtab.functions.columns import float_columns, name
from veldtab.sources.storage import path_exists

EXTENSIONS = {".csv": "csv", ".parquet": "parquet", ".json": "json", ".jsonl": "jsonl"}
PROVENANCE = "_source_file"


def file_kind(path: str) -> str:
    for ext, kind in EXTENSIONS.items():
        if path.lower().rstrip("*/").endswith(ext) or path.lower().endswith(ext):
            return kind
    raise ValueError(f"unsupported file type: {path} (known: {sorted(EXTENSIONS)})")


def matching_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths a glob pattern stands for, sorted; folders written by Spark count as one path."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    paths = sorted(str(s.getPath().toString()) for s in (found or []))
    if not paths:
        raise FileNotFoundError(f"'{pattern}' matched no files")
    return paths


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark keeps NaN and null apart; a missing value is null from here on."""
    floats = float_columns(df)
    return df.withColumns({c: F.when(~F.isnan(name(c)), name(c)) for c in floats}) if floats else df


def read_csv(spark: SparkSession, paths: list[str], schema: T.StructType | str | None = None,
             sampling_ratio: float = 1.0) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred from the sampled rows.

    A value that does not fit its type would become null silently, so sampled inference is
    followed by a check of the corrupt-record column and a full scan when rows are corrupt.
    """
    def reader(**options):
        # A reader keeps the options it was given, so every read starts from a new one.
        return spark.read.options(header=True, **options)

    if schema is not None:
        return reader().schema(schema).csv(paths)
    if sampling_ratio >= 1.0:
        return reader(inferSchema=True).csv(paths)
    sampled = reader(inferSchema=True, samplingRatio=sampling_ratio).csv(paths).schema
    checked = T.StructType([*sampled.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = reader(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record").schema(checked).csv(paths)
    # The hash makes the aggregate read every column; a row is found corrupt only where it is parsed.
    seen = parsed.agg(F.count("_corrupt_record"), F.max(F.xxhash64(*[name(c) for c in sampled.names]))).first()
    if not seen[0]:
        return reader().schema(sampled).csv(paths)
    return reader(inferSchema=True).csv(paths)


def read_table(spark: SparkSession, pattern: str, *, schema: T.StructType | str | None = None,
               sampling_ratio: float = 1.0, provenance: bool = False) -> DataFrame:
    """Read every file a pattern matches; files of different types are united by column name.

    One read per file type, so the number of files does not add plan nodes.
    """
    by_kind: dict[str, list[str]] = {}
    for path in matching_files(spark, pattern):
        by_kind.setdefault(file_kind(path), []).append(path)

    frames = []
    for kind, paths in sorted(by_kind.items()):
        if kind == "csv":
            groups = _csv_groups(spark, paths) if schema is None else [paths]
            frames += [_traced(read_csv(spark, g, schema, sampling_ratio), provenance) for g in groups]
            continue
        reader = spark.read.schema(schema) if schema is not None else spark.read
        if kind == "parquet":
            # Footers of all files are only compared when several paths may differ in columns.
            frame = reader.option("mergeSchema", len(paths) > 1 and schema is None).parquet(*paths)
        else:
            frame = reader.option("multiLine", kind == "json").json(paths)
        frames.append(_traced(frame, provenance))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return nan_to_null(united)


def _csv_groups(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Files with the same header line are read together: CSV columns go by position."""
    if len(paths) == 1:
        return [paths]
    groups: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = tuple(spark.read.option("header", True).csv(path).columns)
        groups.setdefault(header, []).append(path)
    return list(groups.values())


def _traced(df: DataFrame, provenance: bool) -> DataFrame:
    return df.withColumn(PROVENANCE, F.col("_metadata.file_path")) if provenance else df


def source_fingerprint(spark: SparkSession, pattern: str, spec: str = "") -> str:
    """md5 of the source files' names, sizes and times and of the transform list."""
    paths = matching_files(spark, pattern)
    entry = F.concat_ws("|", "path", F.col("length").cast("string"),
                        F.unix_micros("modificationTime").cast("string"))
    # The binary reader lists files without opening them when the content column is not selected.
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
              .select(F.md5(entry).alias("h")))
    digest = listed.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("h")).alias("x"),
                        F.sum(F.xxhash64(F.concat("h", F.lit(spec))).cast("decimal(38,0)")).alias("s")).first()
    return spark.range(1).select(F.md5(F.lit(f"{digest['n']}|{digest['x']}|{digest['s']}|{spec}"))).first()[0]


def materialize(df: DataFrame, folder: str, key: str) -> DataFrame:
    """Write once under ``folder/key`` (zstd Parquet) and read from there ever after."""
    spark = df.sparkSession
    path = f"{folder.rstrip('/')}/{key}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def parse_types(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Cast text columns where possible; a value that does not fit becomes null."""
    casts: dict[str, Column] = {c: name(c).try_cast(t) for c, t in columns.items()}
    return df.withColumns(casts)

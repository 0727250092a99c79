"""Shared helpers of the text operators: Arrow batches, row passing and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldtab.sources.storage import write_through

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
#: Lower-cases A-Z and leaves every other byte alone.
LOWER_ASCII = bytes.maketrans(UPPER, LOWER)
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER.decode(), LOWER.decode())


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """The whole row as one struct beside the columns an operator works on, so that no name can clash."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW), *columns)


def unpacked(df: DataFrame, *columns: Column) -> DataFrame:
    return df.select(f"{ROW}.*", *columns)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_batches(df: DataFrame, schema: str | T.StructType, fn: Callable[[pa.RecordBatch], dict],
                prepare: Callable[[], object] | None = None) -> DataFrame:
    """Replace each Arrow batch by the columns that ``fn`` computes; rows may change in number.

    ``prepare`` builds per-task state, which is handed to ``fn`` as a second argument.
    """
    struct = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = prepare() if prepare else None
        for batch in batches:
            out = fn(batch, state) if prepare else fn(batch)
            yield pa.RecordBatch.from_arrays(
                [out[f.name] if isinstance(out[f.name], pa.Array) and out[f.name].type == f.type
                 else (out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)) for f in arrow],
                schema=arrow)

    return df.mapInArrow(run, struct)


def _edge_state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is the smallest node reachable.

    Alternating large-star and small-star steps: the edges of a component become a star around its smallest
    node after a number of rounds logarithmic in the component's size. Each round is two aggregations with map-side
    combining and two equi-joins whose hot side adaptive execution can split; its result goes to shared storage,
    so lineage stays short. Self links and repeated links are dropped; an empty table gives an empty result.
    """
    e = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    e = write_through(e, label)
    before = _edge_state(e)
    while before[0]:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))))
        e = write_through(small.distinct(), label)
        after = _edge_state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

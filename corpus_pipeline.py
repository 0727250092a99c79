"""The corpus pipeline: quality, near-duplicates, benchmark passages, secrets, source mix.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all return the columns of documents.
Nulls, empty texts, repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veldtab.llm import decontaminate, mixing, quality, secrets, simhash
from veldtab.llm.common import table
from veldtab.sources.storage import write_through


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality scorer does not reject."""
    return quality.keep_quality(docs, quality.fit_quality(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints of four-word shingles that differ in at most four bits: the one with the smallest id."""
    return simhash.drop_near_duplicates(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a placeholder and lengths brought up to date."""
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics."""
    return mixing.sample_mix(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("secrets", redact_secrets),
    ("mix", mix_sources),
]
#: The weak-label fit has no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

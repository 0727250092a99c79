"""Compare a Spark result with DuckDB on the same Parquet files."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v + 0.0, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    return v


def _sorted(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(cols), sorted(out, key=repr)


def differences(df, con, sql: str) -> str | None:
    """None when both results agree exactly, else a short description."""
    spark_cols, spark_rows = _sorted([tuple(x) for x in df.collect()], df.columns)
    result = con.execute(sql)
    duck_cols, duck_rows = _sorted(result.fetchall(), [d[0] for d in result.description])
    if spark_cols != duck_cols:
        return f"columns differ: {spark_cols} / {duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"row counts differ: {len(spark_rows)} / {len(duck_rows)}; {spark_rows[:3]} / {duck_rows[:3]}"
    for a, b in zip(spark_rows, duck_rows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            bad = sum(x != y for x, y in zip(spark_rows, duck_rows))
            return f"{bad} of {len(spark_rows)} rows differ: {spark_cols}\n  spark {a}\n  duck  {b}"
    return None

"""Row and column cleaning. Everything is a projection except duplicate removal (one shuffle)."""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldtab.functions.columns import (
    name, numeric_columns, one_row_agg, reject_nested, string_columns,
)

log = logging.getLogger(__name__)

# Markers that stand for a missing value.
NUMERIC_SENTINELS = (-999, -9999)
STRING_SENTINELS = ("N/A", "n/a", "NA", "none", "None", "")
# Date formats in the order they are tried.
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
    "dd/MM/yyyy HH:mm:ss",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
)
MIN_PARSED_SHARE = 0.5


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    reject_nested(df)
    return df.dropDuplicates()


def numeric_sentinels_to_null(df: DataFrame) -> DataFrame:
    cols = numeric_columns(df)
    return df.withColumns({c: F.when(~name(c).isin(*NUMERIC_SENTINELS), name(c)) for c in cols}) if cols else df


def stripped(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def clean_strings(df: DataFrame) -> DataFrame:
    """Strip white space and turn missing-value markers into null."""
    cols = string_columns(df)
    fixed = {c: F.when(~stripped(name(c)).isin(*STRING_SENTINELS), stripped(name(c))) for c in cols}
    return df.withColumns(fixed) if cols else df


def date_candidates(df: DataFrame) -> list[str]:
    return [c for c in string_columns(df) if "date" in c.lower() or "time" in c.lower()]


def detect_date_columns(df: DataFrame) -> dict[str, str]:
    """Format per string column that holds dates; all candidates and formats in one aggregate.

    The first format that parses every non-null value wins, else the one that parses most. A column
    counts as a date when more than half of *all* its rows parse.
    """
    candidates = date_candidates(df)
    if not candidates:
        return {}
    exprs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(candidates):
        exprs.append(F.count(name(c)).alias(f"n{i}"))
        exprs += [F.count(F.try_to_timestamp(name(c), F.lit(fmt))).alias(f"p{i}_{j}")
                  for j, fmt in enumerate(DATE_FORMATS)]
    stats = one_row_agg(df.select(*[name(c) for c in candidates]), exprs)
    found = {}
    for i, c in enumerate(candidates):
        parsed = [stats[f"p{i}_{j}"] for j in range(len(DATE_FORMATS))]
        best = next((j for j, n in enumerate(parsed) if n and n == stats[f"n{i}"]),
                    max(range(len(parsed)), key=lambda j: parsed[j]))
        if stats["rows"] and parsed[best] / stats["rows"] > MIN_PARSED_SHARE:
            found[c] = DATE_FORMATS[best]
    return found


def calendar_parts(ts: Column, prefix: str) -> dict[str, Column]:
    """Year, month, day of week (Monday 0), hour, and the last three as points on a circle."""
    parts = {"month": (F.month(ts), 12), "dayofweek": (F.weekday(ts), 7), "hour": (F.hour(ts), 24)}
    out = {f"{prefix}_year": F.year(ts)}
    out.update({f"{prefix}_{p}": c for p, (c, _) in parts.items()})
    for p, (c, period) in parts.items():
        angle = c * (2.0 * math.pi / period)
        out[f"{prefix}_{p}_sin"] = F.sin(angle)
        out[f"{prefix}_{p}_cos"] = F.cos(angle)
    return out


def calendar_features(df: DataFrame, formats: dict[str, str] | None = None) -> DataFrame:
    """Replace date strings (``formats``) and timestamp columns by their calendar parts."""
    formats = detect_date_columns(df) if formats is None else formats
    sources = {c: F.try_to_timestamp(name(c), F.lit(fmt)) for c, fmt in formats.items()}
    sources.update({f.name: name(f.name) for f in df.schema.fields
                    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))})
    new: dict[str, Column] = {}
    for c, ts in sources.items():
        new.update(calendar_parts(ts, c))
    return df.withColumns(new).drop(*sources) if new else df


def downcast_doubles(df: DataFrame) -> DataFrame:
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: name(c).cast("float") for c in cols}) if cols else df


def clean(df: DataFrame, *, dates: bool = True, downcast: bool = False) -> DataFrame:
    """Empty rows, exact duplicates, sentinels, strings, dates: in this order.

    Duplicates go before sentinels are replaced, so rows that only become equal later are kept.
    """
    out = clean_strings(numeric_sentinels_to_null(drop_duplicate_rows(drop_empty_rows(df))))
    if dates:
        out = calendar_features(out)
    return downcast_doubles(out) if downcast else out


def log1p_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    absent = [c for c in cols if c not in df.columns]
    if absent:
        log.warning("log1p asked for missing column(s): %s", absent)
    present = {c: F.log1p(name(c).cast("double")) for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def pretransform(df: DataFrame, log1p: list[str] = (), drop: list[str] = ()) -> DataFrame:
    return drop_columns(log1p_columns(df, list(log1p)), list(drop))


def log_target(df: DataFrame, target: str) -> tuple[DataFrame, bool]:
    """log1p of a regression target when its smallest value is positive; the flag says if it was."""
    smallest = df.agg(F.min(name(target))).first()[0]
    if smallest is None or smallest <= 0:
        return df, False
    return df.withColumn(target, F.log1p(name(target).cast("double"))), True


def undo_log(df: DataFrame, cols: list[str], logged: bool = True) -> DataFrame:
    return df.withColumns({c: F.expm1(name(c)) for c in cols}) if logged else df


def fit_labels(df: DataFrame, target: str, limit: int = 10_000) -> list:
    """Sorted distinct labels. A target with more labels than ``limit`` is not a class column."""
    rows = df.select(name(target).alias("label")).where(F.col("label").isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"'{target}' has more than {limit} distinct labels")
    return sorted(r["label"] for r in rows)


def encode_labels(df: DataFrame, col: str, labels: list, out: str) -> DataFrame:
    """Label to 0..k-1; an unknown label becomes null."""
    position = F.array_position(F.array(*[F.lit(v) for v in labels]), name(col)) - 1
    return df.withColumn(out, F.when(position >= 0, position).cast("int"))


def decode_labels(df: DataFrame, col: str, labels: list, out: str) -> DataFrame:
    values = F.array(*[F.lit(v) for v in labels])
    return df.withColumn(out, F.try_element_at(values, name(col).cast("int") + 1))


def infinities_to_null(df: DataFrame, cols: list[str]) -> DataFrame:
    finite = {c: F.when(~F.isnan(name(c)) & (F.abs(name(c)) != F.lit(float("inf"))), name(c)) for c in cols}
    return df.withColumns(finite) if cols else df


def all_null_columns(df: DataFrame) -> list[str]:
    counts = one_row_agg(df, [F.count(name(c)).alias(c) for c in df.columns])
    return [c for c in df.columns if counts[c] == 0]


def drop_null_columns(df: DataFrame) -> DataFrame:
    return df.drop(*all_null_columns(df))


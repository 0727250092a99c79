"""Small helpers on schemas and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType,
)
INTEGER_TYPES = (T.IntegerType, T.LongType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)
NESTED_TYPES = (T.ArrayType, T.MapType, T.StructType)

# One aggregate carries at most this many expressions; wider tables run in several passes so that
# the generated code of one aggregate stays compilable.
AGG_CHUNK = 200


def name(col_name: str) -> Column:
    """Column reference that survives dots and other special characters in the name."""
    return F.col(quoted(col_name))


def quoted(col_name: str) -> str:
    return "`" + col_name.replace("`", "``") + "`"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, FLOAT_TYPES)]


def require_columns(df: DataFrame, wanted: list[str]) -> None:
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"missing column(s): {missing}; available: {df.columns}")


def reject_nested(df: DataFrame, columns: list[str] | None = None) -> None:
    wanted = set(columns or df.columns)
    nested = [f.name for f in df.schema.fields
              if f.name in wanted and isinstance(f.dataType, NESTED_TYPES)]
    if nested:
        raise TypeError(f"nested column(s) are not tabular features: {nested}")


def chunks(items: list, size: int = AGG_CHUNK):
    for start in range(0, len(items), size):
        yield items[start:start + size]


def one_row_agg(df: DataFrame, exprs: list[Column]) -> dict:
    """Global aggregates as one dict; the result is one row per AGG_CHUNK expressions."""
    out: dict = {}
    for part in chunks(exprs):
        out.update(df.agg(*part).first().asDict())
    return out


def long_form(df: DataFrame, ids: list[str], columns: list[str], dtype: str,
              feature: str = "feature", value: str = "value") -> DataFrame:
    """(ids, feature, value): one row per row and column, values cast to one type."""
    cast = df.select(*[name(c) for c in ids], *[name(c).cast(dtype).alias(c) for c in columns])
    return cast.unpivot([name(c) for c in ids], [name(c) for c in columns], feature, value)

"""Row order that does not depend on physical layout: md5 of a seed and the row key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veldtab.functions.columns import name

# 15 hexadecimal digits fit a signed 64-bit integer.
HASH_DIGITS = 15
HASH_SPACE = 16 ** HASH_DIGITS


def hash_text(seed: int, key_cols: list[str]) -> Column:
    parts = [F.lit(str(seed))] + [name(c).cast("string") for c in key_cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_order(seed: int, key_cols: list[str]) -> Column:
    """Uniform integer in [0, 16^15), the same for the same seed and key everywhere."""
    digits = F.substring(hash_text(seed, key_cols), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint")

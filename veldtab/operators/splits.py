"""Deterministic samples and splits.

Rows are ordered by the md5 of a seed and the row key, never by their place in a file. Exact sizes
come from the k-th smallest hash per class (``select_ranks``), so no class is ever sorted in one
task: a split is a filter against a table of one cut-off per class and cut. Two rows of one class
with equal 60-bit hashes fall on the same side of a cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldtab.functions.columns import name
from veldtab.functions.hashing import HASH_SPACE, hash_order
from veldtab.functions.ordering import rank_list, select_ranks
from veldtab.sources.storage import write_through


def hash_cuts(df: DataFrame, class_col: str | None, key_cols: list[str], seed: int,
              sizes: Callable[[Column], list[Column]]) -> DataFrame:
    """Hash of the last row inside each cumulative size: (class, cuts array, group_rows).

    ``sizes(n)`` returns ascending numbers of rows to keep. A size of 0 gives the cut -1.
    """
    return _hash_cuts(df, class_col, hash_order(seed, key_cols), sizes)


def _hash_cuts(df: DataFrame, class_col: str | None, hashed: Column, sizes: Callable[[Column], list[Column]]) -> DataFrame:
    keys = ["_class"] if class_col else []
    keyed = df.select(*([name(class_col).alias("_class")] if class_col else []), hashed.alias("_hash"))
    n_cuts = len(sizes(F.lit(1)))

    def ranks(n: Column):
        cut = [(i, F.least(size.cast("bigint"), n) - 1) for i, size in enumerate(sizes(n))]
        return rank_list([*cut, (n_cuts, n - 1)])

    picked = select_ranks(keyed, keys, "_hash", ranks, integers=True)
    cut = lambda i: F.coalesce(F.max(F.when(F.col("tag") == i, F.col("_hash"))), F.lit(-1)).cast("bigint")
    return (picked.groupBy(*[name(k) for k in keys], "group_rows")
            .agg(F.array(*[cut(i) for i in range(n_cuts)]).alias("_cuts")))


def with_cut_index(df: DataFrame, class_col: str | None, key_cols: list[str], seed: int,
                   sizes: Callable[[Column], list[Column]], out: str) -> DataFrame:
    """Adds the number of cuts below each row: 0 inside the first size, 1 inside the second, ..."""
    return _with_index(df.withColumn("_hash", hash_order(seed, key_cols)), hash_cuts(df, class_col, key_cols, seed, sizes), class_col, sizes, out)


def _with_index(hashed: DataFrame, cuts: DataFrame, class_col: str | None, sizes: Callable[[Column], list[Column]], out: str) -> DataFrame:
    """The number of cuts below each row with its ``_hash``."""
    # Written, so that its size is known when the join is planned: with few classes the rows themselves are never exchanged.
    cuts = write_through(cuts.drop("group_rows"), "cuts")
    if class_col:
        hashed = hashed.withColumn("_class", name(class_col))
        # One row per class. Rows without a class have no cut-off and go after the last cut.
        joined = hashed.join(cuts, "_class", "left")
    else:
        joined = hashed.crossJoin(F.broadcast(cuts))  # one row
    n_cuts = len(sizes(F.lit(1)))
    # One comparison per cut: a filter of the array is not compiled, and every read of a part of the split takes it per row.
    below = sum(((F.get("_cuts", F.lit(i)) < F.col("_hash")).cast("int") for i in range(n_cuts)), F.lit(0))
    index = F.when(F.col("_cuts").isNull(), F.lit(n_cuts)).otherwise(below)
    return joined.withColumn(out, index).drop("_cuts", "_hash", "_class")


def _rounded(c: Column) -> Column:
    return F.rint(c).cast("bigint")


def stratified_holdout(df: DataFrame, class_col: str | None, key_cols: list[str], *,
                       test_size: float = 0.2, val_size: float = 0.15, seed: int = 42,
                       out: str = "split") -> DataFrame:
    """test / val / train per class: ``test_size`` of all rows, then ``val_size`` of the rest."""
    return _holdout(test_size, val_size, out, lambda sizes: with_cut_index(df, class_col, key_cols, seed, sizes, "_part"))


def _holdout(test_size: float, val_size: float, out: str, cut_by: Callable[[Callable[[Column], list[Column]]], DataFrame]) -> DataFrame:
    def sizes(n: Column):
        n_test = _rounded(n * test_size)
        return [n_test, n_test + _rounded((n - n_test) * val_size)]

    cut = cut_by(sizes)
    label = F.when(F.col("_part") == 0, "test").when(F.col("_part") == 1, "val").otherwise("train")
    return cut.withColumn(out, label).drop("_part")


def written_holdout(df: DataFrame, class_col: str | None, key_cols: list[str], *, label: str = "split", test_size: float = 0.2,
                    val_size: float = 0.15, seed: int = 42, out: str = "split") -> DataFrame:
    """``stratified_holdout`` of a table that is written first, together with the hash of its rows: its plan runs once, the passes that look for
    the cuts read two columns, and the split itself is added to what is read."""
    stored = write_through(df.withColumn("_hash", hash_order(seed, key_cols)), label)
    return _holdout(test_size, val_size, out, lambda sizes: _with_index(stored, _hash_cuts(stored, class_col, F.col("_hash"), sizes), class_col, sizes, "_part"))


def random_holdout(df: DataFrame, key_cols: list[str], *, test_size: float = 0.2,
                   val_size: float = 0.15, seed: int = 42, out: str = "split") -> DataFrame:
    """As above without classes, by hash thresholds alone: no pass over the data, sizes approximate."""
    h = hash_order(seed, key_cols)
    test_end = int(test_size * HASH_SPACE)
    val_end = test_end + int((1 - test_size) * val_size * HASH_SPACE)
    return df.withColumn(out, F.when(h < test_end, "test").when(h < val_end, "val").otherwise("train"))


def exact_holdout(df: DataFrame, key_cols: list[str], **options) -> DataFrame:
    return stratified_holdout(df, None, key_cols, **options)


def search_rows(n: int, fraction: float = 0.6, cap: int | None = None) -> int:
    """Rows a search works on: a fraction, at least 100, at most the table and ``cap`` where there is one."""
    return min(max(int(n * fraction), 100), n if cap is None else cap, n)


def stratified_sample(df: DataFrame, class_col: str, key_cols: list[str], n_wanted: int, *,
                      seed: int = 42) -> DataFrame:
    """``n_wanted`` rows in the class proportions of ``df``, at least one per class."""
    total = df.where(name(class_col).isNotNull()).count()
    share = float(n_wanted) / max(total, 1)
    sizes = lambda n: [F.least(n, F.greatest(F.lit(1), _rounded(n * share)))]
    return with_cut_index(df, class_col, key_cols, seed, sizes, "_part").where("_part = 0").drop("_part")


def random_sample(df: DataFrame, key_cols: list[str], n_wanted: int, *, seed: int = 42) -> DataFrame:
    """Exactly ``n_wanted`` rows without replacement."""
    return with_cut_index(df, None, key_cols, seed, lambda n: [F.least(n, F.lit(n_wanted))], "_part") \
        .where("_part = 0").drop("_part")


def fold_count(df: DataFrame, class_col: str, wanted: int = 5) -> int:
    """Folds the smallest class allows; 0 when cross-validation is not possible."""
    least = df.groupBy(name(class_col)).agg(F.count("*").alias("n")).agg(F.min("n")).first()[0] or 0
    return 0 if least < 2 else min(wanted, int(least))


def stratified_folds(df: DataFrame, class_col: str, key_cols: list[str], k: int = 5, *,
                     seed: int = 42, out: str = "fold") -> DataFrame:
    """Equal folds inside each class: fold j holds hash ranks floor(jn/k) to floor((j+1)n/k)."""
    sizes = lambda n: [F.floor(n * (j + 1) / k) for j in range(k - 1)]
    return with_cut_index(df, class_col, key_cols, seed, sizes, out)


def time_blocks(df: DataFrame, time_col: str, k: int = 5, *, out: str = "block") -> DataFrame:
    """Blocks 0..k for expanding-window folds: fold i trains on blocks < i and validates on i.

    Validation blocks have n // (k+1) rows and end with the newest row; the first block takes the
    rest. Rows with equal times stay in one block.
    """
    micros = _as_number(df, time_col)
    size = lambda n: F.floor(n / (k + 1))
    ranks = lambda n: rank_list([(i, n - size(n) * (k - i)) for i in range(k)])
    cuts = select_ranks(df.select(micros.alias("_t")), [], "_t", ranks)
    cuts = cuts.agg(F.array_sort(F.collect_list("_t")).alias("_cuts"))  # k numbers
    index = F.size(F.filter("_cuts", lambda c: c <= F.col("_t")))
    return (df.withColumn("_t", micros).crossJoin(F.broadcast(cuts))
            .withColumn(out, index).drop("_t", "_cuts"))


def _as_number(df: DataFrame, col: str) -> Column:
    dtype = df.schema[col].dataType.typeName()
    if dtype == "timestamp_ntz":
        # Wall-clock microseconds, whatever the session time zone is.
        origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", origin, name(col)).cast("double")
    if dtype in ("timestamp", "date"):
        return F.unix_micros(name(col).cast("timestamp")).cast("double")
    return name(col).cast("double")


def most_recent(df: DataFrame, time_col: str, n: int, key_cols: list[str]) -> DataFrame:
    """The newest ``n`` rows; equal times are ordered by key."""
    return df.orderBy(F.desc(time_col), *[F.desc(k) for k in key_cols]).limit(n)


# Training-set shares of a learning curve.
CURVE_SHARES = (0.10, 0.18, 0.32, 0.56, 1.0)


def nested_samples(df: DataFrame, class_col: str, key_cols: list[str], *, shares=CURVE_SHARES,
                   seed: int = 42, out: str = "level") -> DataFrame:
    """Adds the index of the smallest sample a row belongs to; sample i is ``level <= i``."""
    sizes = lambda n: [F.greatest(F.lit(1), _rounded(n * s)) for s in shares]
    return with_cut_index(df, class_col, key_cols, seed, sizes, out).where(F.col(out) < len(shares))

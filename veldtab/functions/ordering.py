"""Exact ordered work without a single-partition window and without sampling.

A double gets two bucket keys that sort like the number itself: the number rounded to 11 and to 32
mantissa bits. A first-level bucket holds about 2^21 second-level buckets and a second-level bucket
about 2^21 distinct numbers at most, so every window below has a fixed upper bound on its
partition, whatever the distribution, and every run of the job cuts the data in the same places.

``prefix_sum`` gives exact running sums over distinct values. ``select_ranks`` gives exact order
statistics from three histogram passes that shuffle histograms instead of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from veldtab.functions.columns import long_form, name
from veldtab.sources.storage import write_through

# Planned input size up to which a first-level bucket is sorted by one task.
TWO_LEVEL_BYTES = 4 << 30


def _leading_bits(value: Column, dropped: int) -> Column:
    """Round a finite double to ``53 - dropped`` mantissa bits with two products and two differences.

    Rounding to nearest is monotone, so the result sorts like the value. Very large magnitudes are
    scaled down first because the product would overflow.
    """
    def split(c: Column) -> Column:
        scaled = c * F.lit(float(2 ** dropped + 1))
        return scaled - (scaled - c)

    return (F.when(F.abs(value) < 1e290, split(value))
            .otherwise(split(value * F.lit(2.0 ** -60)) * F.lit(2.0 ** 60)))


def coarse_key(value: Column) -> Column:
    """First-level bucket of a finite double: the double rounded to 11 mantissa bits."""
    return _leading_bits(value, 42)


def fine_key(value: Column) -> Column:
    """Second-level bucket: the double rounded to 32 mantissa bits."""
    return _leading_bits(value, 21)


def integer_coarse_key(value: Column) -> Column:
    """First-level bucket of a non-negative 60-bit integer: its top 12 bits."""
    return F.shiftright(value, 48)


def integer_fine_key(value: Column) -> Column:
    return F.shiftright(value, 26)


def plan_bytes(df: DataFrame) -> int:
    """Size estimate of the analyzed plan, without a job; huge when a source does not know its size."""
    return int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())


def prefix_sum(df: DataFrame, keys: list[str], value: str, sums: list[str], *,
               levels: int | None = None, integers: bool = False) -> DataFrame:
    """Running sums of ``sums`` by ascending ``value`` inside each ``keys`` group.

    The result has one row per (keys, value) with, for every summed column ``s``: ``s``,
    ``below_s`` (sum over smaller values) and ``total_s`` (sum over the group).
    Values must be finite doubles, or non-negative 60-bit integers with ``integers``; null values are
    left out.

    Three levels bound every window. Inputs whose planned size is under ``TWO_LEVEL_BYTES`` skip the
    middle level, which saves two shuffles; both ways are exact.
    """
    if levels is None:
        levels = 2 if plan_bytes(df) <= TWO_LEVEL_BYTES else 3
    key_cols = [name(k) for k in keys]
    val = name(value).cast("bigint" if integers else "double")
    coarse_of, fine_of = (integer_coarse_key, integer_fine_key) if integers else (coarse_key, fine_key)
    distinct = (df.where(val.isNotNull())
                .groupBy(*key_cols, val.alias(value))
                .agg(*[F.sum(name(s)).alias(s) for s in sums])
                .withColumn("_coarse", coarse_of(name(value))))
    bucket = ["_coarse"]
    if levels == 3:
        distinct = distinct.withColumn("_fine", fine_of(name(value)))
        bucket = ["_coarse", "_fine"]

    def before(column: str, window: WindowSpec) -> Column:
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(name(column)).over(window), F.lit(0))

    inside = Window.partitionBy(*key_cols, *bucket).orderBy(name(value))
    rows = distinct.select(*key_cols, *bucket, name(value), *[name(s) for s in sums],
                           *[before(s, inside).alias(f"_in_{s}") for s in sums])
    offsets = distinct.groupBy(*key_cols, *bucket).agg(*[F.sum(name(s)).alias(f"_n_{s}") for s in sums])
    if levels == 3:
        coarse = (offsets.groupBy(*key_cols, "_coarse")
                  .agg(*[F.sum(name(f"_n_{s}")).alias(f"_n_{s}") for s in sums]))
        middle = Window.partitionBy(*key_cols, "_coarse").orderBy("_fine")
        offsets = offsets.select(*key_cols, *bucket,
                                 *[before(f"_n_{s}", middle).alias(f"_mid_{s}") for s in sums])
    else:
        coarse = offsets

    group = Window.partitionBy(*key_cols) if keys else Window.partitionBy(F.lit(0))
    coarse = coarse.select(*key_cols, "_coarse",
                           *[before(f"_n_{s}", group.orderBy("_coarse")).alias(f"_before_{s}") for s in sums],
                           *[F.sum(name(f"_n_{s}")).over(group).alias(f"total_{s}") for s in sums])
    if levels == 3:
        offsets = offsets.join(coarse, [*keys, "_coarse"]).select(
            *key_cols, *bucket,
            *[(name(f"_mid_{s}") + name(f"_before_{s}")).alias(f"_before_{s}") for s in sums],
            *[name(f"total_{s}") for s in sums])
    else:
        offsets = coarse
    return rows.join(offsets, [*keys, *bucket]).select(
        *key_cols, name(value), *[name(s) for s in sums],
        *[(name(f"_in_{s}") + name(f"_before_{s}")).alias(f"below_{s}") for s in sums],
        *[name(f"total_{s}") for s in sums])


# Rows of one first-level bucket that one task may sort.
LEAF_ROWS = 4_000_000
# Rank tables up to this many rows stay on the driver between two passes; larger ones go to storage.
PINNED_ROWS = 200_000


def pin(df: DataFrame) -> DataFrame:
    """Run a small table now, so that the passes that follow do not repeat its plan."""
    return _pin(df)[0]


def _pin(df: DataFrame, largest: str | None = None) -> tuple[DataFrame, int]:
    """The pinned table and the largest value of one of its integer columns."""
    head = df.limit(PINNED_ROWS + 1).toArrow()
    if head.num_rows <= PINNED_ROWS:
        top = max((v for v in head.column(largest).to_pylist()), default=0) if largest else 0
        return df.sparkSession.createDataFrame(head, df.schema), top
    stored = write_through(df, "ranks")
    return stored, (stored.agg(F.max(largest)).first()[0] if largest else 0)


def rank_list(pairs: list[tuple[int, Column]]) -> Column:
    return F.array(*[F.struct(F.lit(tag).cast("int").alias("tag"), rank.cast("bigint").alias("rank")) for tag, rank in pairs])


def select_ranks(df: DataFrame, keys: list[str], value: str,
                 ranks: Callable[[Column], Column], *, integers: bool = False) -> DataFrame:
    """Exact order statistics per group: rows (keys, tag, value, group_rows).

    ``ranks(n)`` gets the number of finite values in the group and returns an array of
    (tag, zero-based rank) structs (``rank_list``); a rank outside the group gives no row. Rows are never sorted or shuffled: each of at
    most three passes shuffles one histogram of the buckets that still hold a wanted rank. The tables carried
    from pass to pass have one row per group and rank. Groups with a null key are left out.

    The middle pass is left out when no wanted first-level bucket has more than ``LEAF_ROWS`` rows.
    """
    key_cols = [name(k) for k in keys]
    # Missing values go to one last bucket instead of through a filter, and the value is never null:
    # a null test on it would make the optimizer compute the value's expression once more per test.
    if integers:
        val = F.coalesce(name(value).cast("bigint"), F.lit(-1).cast("bigint"))
        coarse_of, fine_of = integer_coarse_key, integer_fine_key
    else:
        val = F.coalesce(name(value).cast("double"), F.lit(float("nan")))
        coarse_of, fine_of = coarse_key, fine_key
    rows = df.select(*key_cols, val.alias("_value"))
    rows = rows.withColumn("_coarse", coarse_of(F.col("_value")))
    group = Window.partitionBy(*key_cols) if keys else Window.partitionBy(F.lit(0))

    def below(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    present = (F.col("_coarse") >= 0) if integers else ~F.isnan("_coarse")
    first = (rows.groupBy(*key_cols, "_coarse").agg(F.count("*").alias("_n")).where(present)
             .withColumn("_below", below(group.orderBy("_coarse")))
             .withColumn("group_rows", F.sum("_n").over(group)))
    inside = (F.col("_want.rank") >= F.col("_below")) & (F.col("_want.rank") < F.col("_below") + F.col("_n"))
    first, crowded = _pin(
        first.withColumn("_want", F.explode(ranks(F.col("group_rows")))).where(inside)
        .select(*key_cols, "_coarse", "group_rows", F.col("_want.tag").alias("tag"), F.col("_n").alias("_bucket_rows"),
                (F.col("_want.rank") - F.col("_below")).alias("_rank")), "_bucket_rows")
    first = first.drop("_bucket_rows")

    hit = (F.col("_rank") >= F.col("_below")) & (F.col("_rank") < F.col("_below") + F.col("_n"))
    bucket = [*keys, "_coarse"]
    if crowded <= LEAF_ROWS:
        return _leaf_ranks(rows, first, key_cols, bucket, value, hit, below)
    second = (rows.join(F.broadcast(first.select(*bucket).distinct()), bucket, "left_semi")
              .withColumn("_fine", fine_of(F.col("_value")))
              .groupBy(*key_cols, "_coarse", "_fine").agg(F.count("*").alias("_n"))
              .withColumn("_below", below(Window.partitionBy(*key_cols, "_coarse").orderBy("_fine"))))
    second = pin(second.join(F.broadcast(first), bucket).where(hit)
                 .select(*key_cols, "_coarse", "_fine", "group_rows", "tag",
                         (F.col("_rank") - F.col("_below")).alias("_rank")))

    rows = rows.withColumn("_fine", fine_of(F.col("_value")))
    return _leaf_ranks(rows, second, key_cols, [*keys, "_coarse", "_fine"], value, hit, below)


def _leaf_ranks(rows: DataFrame, wanted: DataFrame, key_cols: list[Column], bucket: list[str], value: str,
                hit: Column, below: Callable[[WindowSpec], Column]) -> DataFrame:
    """Last pass: distinct values of the wanted buckets, each bucket in order."""
    by_bucket = [name(b) for b in bucket]
    counted = (rows.join(F.broadcast(wanted.select(*by_bucket).distinct()), bucket, "left_semi")
               .groupBy(*by_bucket, "_value").agg(F.count("*").alias("_n"))
               .withColumn("_below", below(Window.partitionBy(*by_bucket).orderBy("_value"))))
    return (counted.join(F.broadcast(wanted), bucket).where(hit)
            .select(*key_cols, "tag", F.col("_value").alias(value), "group_rows"))


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probabilities: list[float]) -> DataFrame:
    """Linearly interpolated exact quantiles: rows (keys, probability, quantile, group_rows)."""
    listed = F.lit([float(p) for p in probabilities])

    def ranks(n: Column) -> Column:
        # Even tags hold the lower neighbour of a probability's position, odd tags the upper one.
        def one(tag: Column) -> Column:
            low = F.floor((n - 1) * F.element_at(listed, F.shiftright(tag, 1) + 1))
            return F.struct(tag.alias("tag"), F.least(low + tag % 2, n - 1).cast("bigint").alias("rank"))
        return F.transform(F.sequence(F.lit(0), F.lit(2 * len(probabilities) - 1)), one)

    picked = select_ranks(df, keys, value, ranks)
    key_cols = [name(k) for k in keys]
    probability = F.element_at(listed, F.shiftright("tag", 1) + 1)
    sides = (picked.groupBy(*key_cols, probability.alias("probability"), "group_rows")
             .agg(F.min(name(value)).alias("_lo"), F.max(name(value)).alias("_hi")))
    position = (F.col("group_rows") - 1) * F.col("probability")
    weight = position - F.floor(position)
    return sides.select(*key_cols, "probability",
                        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * weight).alias("quantile"),
                        "group_rows")


def column_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Exact quantiles of many numeric columns at once: (feature, probability, quantile, group_rows)."""
    return exact_quantiles(long_form(df, [], columns, "double"), ["feature"], "value", probabilities)


def collect_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, dict[float, float]]:
    """``column_quantiles`` on the driver: one number per column and probability."""
    out: dict[str, dict[float, float]] = {c: {} for c in columns}
    if columns:
        for row in column_quantiles(df, columns, probabilities).collect():
            out[row["feature"]][row["probability"]] = row["quantile"]
    return out


# -- running state -------------------------------------------------------------------------------

def order_bucket(df: DataFrame, order: str) -> Column:
    """A bucket of the order column that sorts like it: leading bits of numbers and times, the first ten characters of texts."""
    kind, c = df.schema[order].dataType.typeName(), name(order)
    if kind in ("string", "varchar", "char"):
        return F.coalesce(F.substring(c, 1, 10), F.lit(""))
    if kind in ("date", "timestamp_ntz"):
        c = c.cast("timestamp")
    number = c.cast("double")
    kept = F.when(F.isnan(number) | (F.abs(number) == float("inf")), number).otherwise(coarse_key(number))
    return F.coalesce(kept, F.lit(float("-inf")))


def segmented_scan(df: DataFrame, keys: list[str], order: str, *, reset: Column | None = None, add: Column | None = None, high: Column | None = None) -> DataFrame:
    """Adds to every row, by ascending ``order`` inside each ``keys`` group: ``_position`` (from 1), ``_since`` (sum of ``add`` since the last
    row that meets ``reset``, that row included) and ``_high`` (greatest ``high`` so far, nulls left out).

    The state (rows, sum since a reset, maximum) adds up in any grouping, so each bucket of the order column is scanned by itself and gets the
    state of the buckets before it; only one row per bucket is ordered across buckets. Nulls come first; equal values in any order.
    """
    key_cols = [f"_k{i}" for i in range(len(keys))]
    rows = df.withColumns({k: name(c) for k, c in zip(key_cols, keys)} | {
        "_bucket": order_bucket(df, order), "_reset": F.coalesce(reset, F.lit(False)).cast("int") if reset is not None else F.lit(0),
        "_add": F.coalesce(add.cast("bigint"), F.lit(0)) if add is not None else F.lit(0).cast("bigint"), "_value": high if high is not None else F.lit(None).cast("double")})
    inside = Window.partitionBy(*key_cols, "_bucket").orderBy(name(order)).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_at": F.count(F.lit(1)).over(inside), "_part": F.sum("_reset").over(inside), "_top": F.max("_value").over(inside)})
    since = Window.partitionBy(*key_cols, "_bucket", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_run", F.sum("_add").over(since))
    last = rows.groupBy(*key_cols, "_bucket").agg(F.max("_at").alias("n"), F.max("_part").alias("parts"), F.max_by("_run", "_at").alias("tail"), F.max("_top").alias("top"))
    group = Window.partitionBy(*key_cols) if keys else Window.partitionBy(F.lit(0))  # one row per bucket
    ordered = group.orderBy("_bucket")
    before, upto = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumns({"_n": F.coalesce(F.sum("n").over(before), F.lit(0)), "_above": F.max("top").over(before),
                             "_stretch": F.sum((F.col("parts") > 0).cast("int")).over(upto)})
    stretch = Window.partitionBy(*key_cols, "_stretch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    last = last.withColumn("_open", F.sum("tail").over(stretch)).withColumn("_carry", F.coalesce(F.lag("_open").over(ordered), F.lit(0)))
    state = last.select(*[F.col(k).alias(f"{k}_") for k in key_cols], F.col("_bucket").alias("_bucket_"), "_n", "_above", "_carry")
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in [*key_cols, "_bucket"]])
    found = rows.join(state, same)
    return found.select(*[name(c) for c in df.columns], (F.col("_n") + F.col("_at")).alias("_position"),
                        (F.col("_run") + F.when(F.col("_part") == 0, F.col("_carry")).otherwise(0)).alias("_since"), F.greatest("_above", "_top").alias("_high"))

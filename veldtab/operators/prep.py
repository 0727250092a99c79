"""Feature preparation: fit on the training rows, apply anywhere.

A fit reads a few numbers per column (or one row per category) and a fitted object is a set of
column expressions with literals, so applying it never touches the training data again, works on
streams, and can be stored as SQL in a fitted pipeline (``sql`` methods).
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldtab.functions.columns import long_form, name, numeric_columns, one_row_agg, quoted
from veldtab.functions.ordering import collect_quantiles, prefix_sum
from veldtab.operators.drift import category_counts, numeric_long
from veldtab.sources.storage import write_through

# Encodings with at most this many categories are shipped to every task.
BROADCAST_CATEGORIES = 500_000


def number(v: float) -> str:
    """SQL literal of a double."""
    return f"{float(v)!r}D"


# -- imputation ----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Imputer:
    """Constant per column in place of null."""

    values: dict

    def sql(self, c: str) -> str:
        v = self.values.get(c)
        if v is None:
            return quoted(c)
        if isinstance(v, str):
            escaped = v.replace("\\", "\\\\").replace("'", "\\'")
            return f"coalesce({quoted(c)}, '{escaped}')"
        return f"coalesce(cast({quoted(c)} as double), {number(v)})" if isinstance(v, float) else f"coalesce({quoted(c)}, {v})"

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(self.sql(c)) for c in self.values if c in df.columns})


def fit_median_imputer(df: DataFrame, cols: list[str]) -> Imputer:
    quantiles = collect_quantiles(df, cols, [0.5])
    return Imputer({c: quantiles[c].get(0.5) for c in cols})


def mode_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, category, n): the most frequent value of each column, ties to the smallest.

    Counts per value come first, so the choice is between distinct values, not rows.
    """
    numbers = numeric_columns(df)
    counts = category_counts(df, cols)
    tops = counts.groupBy("feature").agg(F.max("n").alias("n"))
    as_number = F.when(F.col("feature").isin(*numbers), F.col("category").try_cast("double")) if numbers else F.lit(None).cast("double")
    order = F.struct(as_number.alias("number"), F.col("category").alias("text"))
    return (counts.join(tops, ["feature", "n"]).groupBy("feature")
            .agg(F.min_by("category", order).alias("category"), F.max("n").alias("n")))


def fit_mode_imputer(df: DataFrame, cols: list[str]) -> Imputer:
    types = dict(df.dtypes)
    found = {r["feature"]: r["category"] for r in mode_table(df, cols).collect()}
    whole = {"tinyint", "smallint", "int", "bigint"}
    convert = lambda c, v: int(v) if types[c] in whole else (v == "true" if types[c] == "boolean" else v)
    return Imputer({c: convert(c, found[c]) for c in cols if c in found})


# -- scaling -------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Scaler:
    """(x - centre) / spread per column."""

    centre: dict[str, float]
    spread: dict[str, float]

    def sql(self, c: str, inner: str | None = None) -> str:
        return f"((({inner or quoted(c)}) - {number(self.centre[c])}) / {number(self.spread[c])})"

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(self.sql(c)) for c in self.centre if c in df.columns})


def fit_robust_scaler(df: DataFrame, cols: list[str]) -> Scaler:
    """Median and interquartile range; a range of 0 counts as 1."""
    q = collect_quantiles(df, cols, [0.25, 0.5, 0.75])
    live = [c for c in cols if q[c]]
    return Scaler({c: q[c][0.5] for c in live}, {c: (q[c][0.75] - q[c][0.25]) or 1.0 for c in live})


def fit_standard_scaler(df: DataFrame, cols: list[str]) -> Scaler:
    """Mean and population standard deviation; a deviation of 0 counts as 1."""
    stats = one_row_agg(df, [e for i, c in enumerate(cols) for e in (
        F.avg(name(c)).alias(f"m_{i}"), F.stddev_pop(name(c)).alias(f"s_{i}"))])
    live = [(i, c) for i, c in enumerate(cols) if stats[f"m_{i}"] is not None]
    return Scaler({c: float(stats[f"m_{i}"]) for i, c in live}, {c: float(stats[f"s_{i}"]) or 1.0 for i, c in live})


# -- power transform -----------------------------------------------------------------------------

def yeo_johnson(x: Column, lam: float) -> Column:
    up = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    down = -F.log1p(-x) if abs(lam - 2) < 1e-12 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, up).otherwise(down)


def yeo_johnson_sql(inner: str, lam: float) -> str:
    up = f"ln(1D + ({inner}))" if abs(lam) < 1e-12 else f"((power(({inner}) + 1D, {number(lam)}) - 1D) / {number(lam)})"
    down = (f"(-ln(1D - ({inner})))" if abs(lam - 2) < 1e-12
            else f"(-(power(1D - ({inner}), {number(2 - lam)}) - 1D) / {number(2 - lam)})")
    return f"(case when ({inner}) >= 0 then {up} else {down} end)"


# Fixed grid of the search for lambda and the step of each refinement around the best point.
LAMBDA_GRID = tuple(-2 + 0.5 * i for i in range(13))
REFINEMENTS = (0.1, 0.02, 0.004)
REFINE_POINTS = 9


@dataclass(frozen=True)
class PowerTransform:
    lambdas: dict[str, float]
    scaler: Scaler

    def sql(self, c: str, inner: str | None = None) -> str:
        return self.scaler.sql(c, yeo_johnson_sql(inner or quoted(c), self.lambdas[c]))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.expr(self.sql(c)) for c in self.lambdas if c in df.columns})


def lambda_likelihoods(df: DataFrame, grid: dict[str, list[float]]) -> dict[tuple[str, float], float]:
    """Log-likelihood of every (column, lambda) in one pass: tasks take mean and squared deviations of their rows, which are merged by pairs of count, mean and deviation."""
    cols, lambdas = list(grid), [list(lams) for lams in grid.values()]
    schema = "i int, n long, logs double, mean array<double>, m2 array<double>"

    def table(found: dict[int, tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        return pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), *[pa.array([v[k] for v in found.values()], kind) for k, kind in enumerate(kinds)]],
                                          ["i", "n", "logs", "mean", "m2"])

    def merged(a: tuple | None, b: tuple) -> tuple:
        if a is None or not a[0]:
            return b
        n = a[0] + b[0]
        gap = b[2] - a[2]
        return n, a[1] + b[1], a[2] + gap * (b[0] / n), a[3] + b[3] + gap * gap * (a[0] * b[0] / n)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        with np.errstate(all="ignore"):
            for batch in batches:
                for i, lams in enumerate(lambdas):
                    x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                    if not len(x):
                        continue
                    low, size = x < 0, np.log1p(np.abs(x))
                    mean, m2 = np.empty(len(lams)), np.empty(len(lams))
                    for j, lam in enumerate(lams):
                        moved = _yeo_johnson_of(size, low, lam)
                        # From the first value, so that the deviation of a constant column is exactly zero.
                        gap = moved - moved[0]
                        mean[j] = moved[0] + gap.mean()
                        m2[j] = np.square(gap - gap.mean()).sum()
                    found[i] = merged(found.get(i), (len(x), float(np.where(low, -size, size).sum()), mean, m2))
        yield table(found)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple] = {}
        with np.errstate(all="ignore"):
            for batch in batches:
                for i, n, logs, mean, m2 in zip(*[batch.column(k).to_pylist() for k in range(3)], batch.column(3), batch.column(4)):
                    found[i] = merged(found.get(i), (n, logs, mean.values.to_numpy(), m2.values.to_numpy()))
        yield table(found)

    rows = df.select(*[name(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    stats = {r["i"]: r for r in rows.mapInArrow(moments, schema).repartition("i").mapInArrow(added, schema).collect()}
    out = {}
    for i, (c, lams) in enumerate(grid.items()):
        for j, lam in enumerate(lams):
            var = stats[i]["m2"][j] / stats[i]["n"] if i in stats else None
            if var is None or not var > 0 or math.isinf(var):
                out[c, lam] = -math.inf
                continue
            out[c, lam] = -stats[i]["n"] / 2 * math.log(var) + (lam - 1) * stats[i]["logs"]
    return out


def _yeo_johnson_of(size: np.ndarray, low: np.ndarray, lam: float) -> np.ndarray:
    """The transform of numbers given as log(1 + |x|) and whether they are below zero."""
    up = size if abs(lam) < 1e-12 else np.expm1(lam * size) / lam
    if not low.any():
        return up
    down = -size if abs(lam - 2) < 1e-12 else -np.expm1((2 - lam) * size) / (2 - lam)
    return np.where(low, down, up)


def fit_power_transform(df: DataFrame, cols: list[str]) -> PowerTransform:
    """Lambda by maximum likelihood on a grid with three refinements (four passes), then standardised."""
    grid = {c: list(LAMBDA_GRID) for c in cols}
    best: dict[str, float] = {}
    for step in (None, *REFINEMENTS):
        if step is not None:
            half = REFINE_POINTS // 2
            grid = {c: [round(best[c] + step * k, 6) for k in range(-half, half + 1)] for c in cols}
        scores = lambda_likelihoods(df, grid)
        best = {c: max(grid[c], key=lambda lam: (scores[c, lam], -abs(lam - 1))) for c in cols}
    moved = df.select(*[yeo_johnson(name(c).cast("double"), best[c]).alias(c) for c in cols])
    return PowerTransform(best, fit_standard_scaler(moved, cols))


# -- one-hot -------------------------------------------------------------------------------------

def known_categories(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, category, n): what the training data knows; kept with the model."""
    return category_counts(df, cols)


@dataclass(frozen=True)
class OneHot:
    levels: dict[str, list[str]]

    def columns(self, c: str) -> dict[str, Column]:
        return {f"{c}={v}": F.coalesce((name(c).cast("string") == v).cast("int"), F.lit(0)) for v in self.levels[c]}

    def transform(self, df: DataFrame) -> DataFrame:
        new = {k: e for c in self.levels for k, e in self.columns(c).items()}
        return df.withColumns(new).drop(*self.levels)


def fit_one_hot(df: DataFrame, cols: list[str], limit: int = 1000) -> OneHot:
    """Sorted levels per column. Columns with more than ``limit`` levels belong to target encoding."""
    rows = known_categories(df, cols).select("feature", "category").limit(limit * len(cols) + 1).collect()
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        levels[r["feature"]].append(r["category"])
    if any(len(v) > limit for v in levels.values()) or len(rows) > limit * len(cols):
        raise ValueError(f"a one-hot column has more than {limit} levels")
    return OneHot({c: sorted(v) for c, v in levels.items()})


# -- target encoding -----------------------------------------------------------------------------

def target_encoding(df: DataFrame, cols: list[str], y: str, keys: list[str] = ()) -> DataFrame:
    """(keys, feature, category, n, encoding) with empirical-Bayes smoothing.

    encoding = (n m + s g) / (n + s): m and v are mean and variance of y in the category, g and V
    over all rows, s = v / V. A category without spread keeps its own mean.
    """
    yv = name(y).cast("double")
    base = df.where(yv.isNotNull()).select(*[name(k) for k in keys], yv.alias("_y"), *[name(c) for c in cols])
    long = long_form(base, [*keys, "_y"], cols, "string", value="category").where("category is not null")
    stats = long.groupBy(*[name(k) for k in keys], "feature", "category").agg(
        F.count("*").alias("n"), F.avg("_y").alias("m"), F.var_pop("_y").alias("v"))
    overall = base.groupBy(*[name(k) for k in keys]).agg(F.avg("_y").alias("g"), F.var_pop("_y").alias("gv"))
    # One row without keys, one per fold with them.
    joined = stats.join(F.broadcast(overall), list(keys)) if keys else stats.crossJoin(F.broadcast(overall))
    s = F.when(F.col("gv") > 0, F.col("v") / F.col("gv")).otherwise(F.lit(0.0))
    encoding = (F.col("n") * F.col("m") + s * F.col("g")) / (F.col("n") + s)
    return joined.select(*[name(k) for k in keys], "feature", "category", "n", encoding.alias("encoding"))


@dataclass(frozen=True)
class TargetEncoder:
    """Encoding table plus the overall mean for unknown categories."""

    table: DataFrame
    overall: float
    cols: tuple[str, ...]
    n_categories: int

    def transform(self, df: DataFrame) -> DataFrame:
        for c in self.cols:
            part = self.table.where(F.col("feature") == c).select(F.col("category").alias("_k"), F.col("encoding").alias("_e"))
            if self.n_categories <= BROADCAST_CATEGORIES:
                part = F.broadcast(part)
            df = (df.join(part, name(c).cast("string") == F.col("_k"), "left")
                  .withColumn(c, F.coalesce("_e", F.lit(self.overall))).drop("_k", "_e"))
        return df


def fit_target_encoder(df: DataFrame, cols: list[str], y: str) -> TargetEncoder:
    table = write_through(target_encoding(df, cols, y), "encoding")
    overall = df.agg(F.avg(name(y).cast("double"))).first()[0]
    return TargetEncoder(table, float(overall), tuple(cols), table.count())


def cross_fit_encoding(df: DataFrame, col: str, y: str, fold: str, out: str) -> DataFrame:
    """Encode training rows with the statistics of the other folds.

    Sums per (fold, category) are subtracted from the sums per category, so the data is aggregated
    once and not once per fold.
    """
    yv = name(y).cast("double")
    cell = df.groupBy(name(fold).alias("_f"), name(col).cast("string").alias("_k")).agg(
        F.count(yv).alias("n"), F.sum(yv).alias("s"), F.sum(yv * yv).alias("q"))
    category = cell.groupBy(F.col("_k").alias("_c")).agg(F.sum("n").alias("cn"), F.sum("s").alias("cs"), F.sum("q").alias("cq"))
    fold_sums = cell.groupBy("_f").agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"), F.sum("q").alias("fq"))
    total = cell.agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"), F.sum("q").alias("tq"))
    frame = fold_sums.crossJoin(F.broadcast(total)).select(  # one row per fold
        "_f", (F.col("tn") - F.col("fn")).alias("gn"), ((F.col("ts") - F.col("fs")) / (F.col("tn") - F.col("fn"))).alias("g"),
        ((F.col("tq") - F.col("fq")) / (F.col("tn") - F.col("fn"))).alias("gq"))
    joined = cell.join(category, F.col("_k").eqNullSafe(F.col("_c"))).join(F.broadcast(frame), "_f")
    n = F.col("cn") - F.col("n")
    m = (F.col("cs") - F.col("s")) / F.nullif(n, F.lit(0))
    v = F.greatest(F.lit(0.0), (F.col("cq") - F.col("q")) / F.nullif(n, F.lit(0)) - m * m)
    overall_v = F.greatest(F.lit(0.0), F.col("gq") - F.col("g") * F.col("g"))
    s = F.when(overall_v > 0, v / overall_v).otherwise(F.lit(0.0))
    encoding = F.when(n > 0, (n * m + s * F.col("g")) / (n + s)).otherwise(F.col("g"))
    # Written, so that its size is known when the join is planned: with few categories the rows themselves are never exchanged.
    table = write_through(joined.select("_f", "_k", encoding.alias(out)), "encoding")
    same = (name(fold) == F.col("_f")) & name(col).cast("string").eqNullSafe(F.col("_k"))
    return df.join(table, same, "left").drop("_f", "_k")


# -- column selection and generation -------------------------------------------------------------

def column_variances(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Population variance after median imputation; nulls are counted, not filled row by row."""
    imputer = fit_median_imputer(df, cols)
    filled = df.select(*[F.expr(imputer.sql(c)).cast("double").alias(c) for c in cols])
    return one_row_agg(filled, [F.var_pop(name(c)).alias(c) for c in cols])


def filter_low_variance(df: DataFrame, cols: list[str], threshold: float = 0.0) -> list[str]:
    variances = column_variances(df, cols)
    return [c for c in cols if variances[c] is not None and variances[c] > threshold]


#: Variances below this share of the sum of squares are rounding.
ROUNDING = 1e-12


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, i, j, corr) of all column pairs i < j over the rows that have both; null where one of them does not vary there.

    One scan after the column minima, whatever the number of columns: tasks add up counts, sums, squares and products of
    masked blocks, a row of sums per column is added up by column, and that task turns it into correlations.
    """
    cols = list(cols)
    x = [name(c).cast("double") for c in cols]
    found = one_row_agg(df.select(*[v.alias(c) for v, c in zip(x, cols)]), [F.min(F.when(~F.isnan(name(c)), name(c))).alias(c) for c in cols])
    least = np.array([found[c] if found[c] is not None else 0.0 for c in cols])
    width = len(cols)
    schema = "i int, sums array<double>"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, 6, width))
        for batch in batches:
            values = np.column_stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns]) - least
            values, there = np.nan_to_num(values, nan=0.0, posinf=np.inf, neginf=-np.inf), (~np.isnan(values)).astype(float)
            square = values * values
            for at, (left, right) in enumerate(((there, there), (values, there), (there, values), (square, there), (there, square), (values, values))):
                total[:, at] += left.T @ right
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total.reshape(width, -1)), pa.list_(pa.float64()))], ["i", "sums"])

    def correlations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[i] = total.get(i, 0.0) + row.values.to_numpy()
        for i, row in total.items():
            n, sx, sy, sxx, syy, sxy = row.reshape(6, width)[:, i + 1:]
            with np.errstate(divide="ignore", invalid="ignore"):
                vx, vy = sxx - sx * sx / n, syy - sy * sy / n
                corr = np.where((vx > ROUNDING * sxx) & (vy > ROUNDING * syy), (sxy - sx * sy / n) / np.sqrt(vx * vy), np.nan)
            there = [None if np.isnan(c) else float(np.clip(c, -1, 1)) for c in corr]
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(there), pa.int32()), pa.array(range(i + 1, width), pa.int32()), pa.array(there, pa.float64())], ["i", "j", "corr"])

    sums = df.select(*[v.alias(c) for v, c in zip(x, cols)]).mapInArrow(blocks, schema)
    pairs = sums.repartition("i").mapInArrow(correlations, "i int, j int, corr double")
    names = F.array(*[F.lit(c) for c in cols])
    return pairs.select(F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), "i", "j", "corr")


MIN_PAIR_CORRELATION = 0.05


def interaction_pairs(train: DataFrame, cols: list[str], top_k: int = 10) -> DataFrame:
    """Strongest pairs on the median-imputed training columns: (rank, a, b, abs_corr)."""
    imputer = fit_median_imputer(train, cols)
    filled = train.select(*[F.expr(imputer.sql(c)).cast("double").alias(c) for c in cols])
    strong = correlation_pairs(filled, cols).withColumn("abs_corr", F.abs("corr")).where(F.col("abs_corr") >= MIN_PAIR_CORRELATION)
    return strong.orderBy(F.desc("abs_corr"), "i", "j").limit(top_k).select("a", "b", "abs_corr")


def add_interactions(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Product columns of the raw values; null where either is null."""
    new = {f"{a}__x__{b}": name(a).cast("double") * name(b) for a, b in pairs}
    return df.withColumns(new) if new else df


def generated_candidates(cols: list[str], depth: int = 1) -> dict[str, Column]:
    """Pairwise sums and products; deeper levels combine the last level with the source columns."""
    source = [(c, name(c).cast("double")) for c in cols]
    level, out = list(source), {}
    for d in range(depth):
        pairs = list(combinations(level, 2)) if d == 0 else [(x, s) for x in level for s in source]
        level = [(f"{a} {op} {b}", x + y if op == "+" else x * y) for (a, x), (b, y) in pairs for op in ("+", "*")]
        out.update(dict(level))
    return out


def _generated_names(raw: list[str]) -> dict[str, str]:
    """Whole expressions as names; where two would be equal, each gets the md5 of its expression."""
    plain = {r: "ft__" + r.replace(" ", "_") for r in raw}
    seen = Counter(plain.values())
    return {r: n if seen[n] == 1 else f"{n}__{hashlib.md5(r.encode()).hexdigest()}" for r, n in plain.items()}


@dataclass(frozen=True)
class GeneratedFeatures:
    expressions: dict[str, Column]

    @property
    def names(self) -> list[str]:
        return list(self.expressions)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.expressions) if self.expressions else df


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def generated_variances(train: DataFrame, cols: list[str], depth: int = 1) -> dict[str, float]:
    items = list(generated_candidates(cols, depth).items())
    stats = one_row_agg(train, [F.var_samp(_finite(e)).alias(f"v_{i}") for i, (_, e) in enumerate(items)])
    return {raw: stats[f"v_{i}"] for i, (raw, _) in enumerate(items)}


def fit_generated_features(train: DataFrame, cols: list[str], *, max_features: int = 25, depth: int = 1) -> GeneratedFeatures:
    """Keep the generated columns with the largest variance on the training rows."""
    if len(cols) < 2:
        return GeneratedFeatures({})
    variances = generated_variances(train, cols, depth)
    kept = sorted((r for r, v in variances.items() if v is not None and v > 0), key=lambda r: (-variances[r], r))[:max_features]
    expressions = generated_candidates(cols, depth)
    names = _generated_names(kept)
    return GeneratedFeatures({names[r]: _finite(expressions[r]) for r in kept})


# Names of the per-entity features of a numeric column.
SERIES_FEATURES = ("sum_values", "median", "mean", "length", "standard_deviation", "variance",
                   "root_mean_square", "maximum", "absolute_maximum", "minimum")


def entity_features(df: DataFrame, entity: str, cols: list[str], *, exact_median: bool = True) -> DataFrame:
    """One row per entity with ten features per column, named tsfresh__<column>__<feature>.

    All but the median are plain aggregates. The median is exact by rank selection, so an entity
    with a third of the rows is no larger a task than any other.
    """
    aggs = []
    for c in cols:
        x = name(c).cast("double")
        aggs += [F.sum(x).alias(f"tsfresh__{c}__sum_values"), F.avg(x).alias(f"tsfresh__{c}__mean"),
                 F.count(F.lit(1)).cast("double").alias(f"tsfresh__{c}__length"),
                 F.stddev_pop(x).alias(f"tsfresh__{c}__standard_deviation"), F.var_pop(x).alias(f"tsfresh__{c}__variance"),
                 F.sqrt(F.avg(x * x)).alias(f"tsfresh__{c}__root_mean_square"), F.max(x).alias(f"tsfresh__{c}__maximum"),
                 F.max(F.abs(x)).alias(f"tsfresh__{c}__absolute_maximum"), F.min(x).alias(f"tsfresh__{c}__minimum")]
    out = df.groupBy(name(entity).alias(entity)).agg(*aggs)
    if not exact_median:
        return out
    return out.join(entity_medians(df, entity, cols), entity, "left")


def entity_medians(df: DataFrame, entity: str, cols: list[str]) -> DataFrame:
    """Exact median of each column per entity, by running counts over distinct values.

    With many entities the wanted ranks are as many as the entities, so the rank table is joined
    and not broadcast.
    """
    long = numeric_long(df.where(name(entity).isNotNull()), cols, [entity]).withColumn("n", F.lit(1).cast("bigint"))
    sums = prefix_sum(long, [entity, "feature"], "value", ["n"])
    lo, hi = F.floor((F.col("total_n") - 1) / 2), F.floor(F.col("total_n") / 2)

    def value_at(c: str, rank: Column) -> Column:
        here = (F.col("feature") == c) & (F.col("below_n") <= rank) & (rank < F.col("below_n") + F.col("n"))
        return F.max(F.when(here, F.col("value")))

    medians = sums.groupBy(name(entity).alias(entity)).agg(*[
        ((value_at(c, lo) + value_at(c, hi)) / 2).alias(f"tsfresh__{c}__median") for c in cols])
    return medians


def keep_by_variance(features: DataFrame, entity: str, max_features: int = 25) -> list[str]:
    cols = [c for c in features.columns if c != entity]
    stats = one_row_agg(features, [F.var_samp(_finite(name(c))).alias(c) for c in cols])
    return sorted(cols, key=lambda c: (-(stats[c] if stats[c] is not None else -1.0), c))[:max_features]


def attach_entity_features(df: DataFrame, features: DataFrame, entity: str) -> DataFrame:
    """Left join by entity; a hot entity is split by adaptive execution (the right side is unique)."""
    return df.join(features, entity, "left")


def align_columns(df: DataFrame, columns: list[str], dtype: str = "double") -> DataFrame:
    """Exactly these columns in this order; missing ones are null."""
    return df.select(*[name(c) if c in df.columns else F.lit(None).cast(dtype).alias(c) for c in columns])


def class_weights(df: DataFrame, target: str, weight: float | None, positive=1, out: str = "weight") -> DataFrame:
    """Weight column for the positive class."""
    w = F.when(name(target) == positive, F.lit(float(weight or 1.0))).otherwise(F.lit(1.0))
    return df.withColumn(out, w)


def balanced_weights(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """n / (k n_class), from one row per class."""
    counts = {r[0]: r[1] for r in df.groupBy(name(target)).agg(F.count("*")).collect() if r[0] is not None}
    total, k = sum(counts.values()), max(len(counts), 1)
    w = F.lit(1.0)
    for label, n in counts.items():
        w = F.when(name(target) == label, F.lit(total / (k * n))).otherwise(w)
    return df.withColumn(out, w)

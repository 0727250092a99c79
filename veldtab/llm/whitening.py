"""Whitening of embeddings on principal components found by QDWH spectral divide-and-conquer.

Entries become whole numbers x = floor(64 c) + 1,000,000. One pass adds them up exactly, a second adds up products of centred
values, block by block; both results have the size of the dimension, whatever the number of rows. The eigenvectors
of the covariance are found without an eigenvalue routine: the unitary polar factor of the shifted matrix, by the QR-based
dynamically weighted Halley iteration (QDWH), is the sign of its eigenvalues, so half of it plus the identity projects onto
the components above the shift. The matrix is cut along the projector's range and the parts are treated alike until they are diagonal.
The scaled components are broadcast and applied in a third pass, which measures the covariance of what
comes out, and in the result.

Rows are dropped whose vector is null or empty, holds a null or an entry that is not finite (or too large for x to be
a long), or has another length than most rows (ties: the greater length). Components whose variance is not above rounding (1e-13 of all
variance) are left out; without two different rows there is none and the result is empty, as it is for an empty table. Equal variances have
components in any orthonormal basis. Null and repeated ids are kept; extra columns are dropped. A deviation beyond
the range of a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldtab.llm.common import table

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
_EPS = np.finfo(float).eps
_LARGEST = 2.0 ** 62
#: Variances below this share of the whole are rounding.
ROUNDING = 1e-13


def grid(batch: pa.RecordBatch, dims: int | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Usable rows of (id, vector) by length: their places in the batch and x as a matrix of longs."""
    column = batch.column(1).cast(pa.list_(pa.float64()))
    length = np.asarray(pa.compute.list_value_length(column).fill_null(0))
    flat = column.flatten()
    # a null entry is as unusable as one that is not a number
    values = np.asarray(pa.compute.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False), float)
    start = np.concatenate(([0], np.cumsum(length)))
    out = {}
    for d in {dims} if dims is not None else set(length.tolist()) - {0}:
        rows = np.flatnonzero(length == d)
        if not len(rows) or not d:
            continue
        scaled = np.floor(SCALE * values[start[rows][:, None] + np.arange(d)])
        with np.errstate(invalid="ignore"):
            usable = (np.abs(scaled) < _LARGEST).all(axis=1)
        if usable.any():
            out[d] = rows[usable], scaled[usable].astype(np.int64) + OFFSET
    return out


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of usable rows of the commonest length and the exact sum of x per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, (rows, x) in grid(batch).items():
                small = float(np.abs(x).max()) * len(x) < _LARGEST
                count[d] = count.get(d, 0) + len(rows)
                total[d] = total.get(d, np.zeros(d, object)) + (x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0))
        for d, sums in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([count[d]] * d, pa.int64()),
                                              pa.array([str(int(s)) for s in sums])], ["d", "j", "n", "s"])

    parts = vectors.mapInArrow(run, "d int, j int, n long, s string")
    rows = parts.groupBy("d", "j").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    most = rows.where("j = 0").orderBy(F.desc("n"), F.desc("d")).limit(1).select("d")
    found = sorted(rows.join(F.broadcast(most), "d", "left_semi").collect(), key=lambda r: r["j"])
    return (found[0]["n"], [int(r["s"]) for r in found]) if found else (0, [])


class Centre:
    """The mean of x as its whole part and the rest, so that centring loses no digits."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], np.int64)
        self.over = np.array([s % n for s in sums], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.over / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n x - S)^2."""
        away = x - self.whole
        most = float(np.abs(away).max(initial=0)) + 1
        if (most * self.n) ** 2 * away.shape[1] < _LARGEST:
            gap = away * self.n - self.over
            return (gap * gap).sum(axis=1).tolist()
        gap = away.astype(object) * self.n - self.over.astype(object)
        return [d if d < 1 << 63 else None for d in (gap * gap).sum(axis=1).tolist()]


def covariance(vectors: DataFrame, centre: Centre, weights: np.ndarray | None = None) -> np.ndarray:
    """Covariance (divisor n) of the centred rows, or of the rows times ``weights``; each task adds up its own block."""
    shared = vectors.sparkSession.sparkContext.broadcast((centre, weights))
    dims = len(centre.sums)
    size = dims if weights is None else weights.shape[1]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, w = shared.value
        total, seen = np.zeros((size, size)), False
        for batch in batches:
            for _, x in grid(batch, dims).values():
                z = mean.centred(x) if w is None else mean.centred(x) @ w
                total += z.T @ z
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[i] = total.get(i, 0.0) + row.values.to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], ["i", "row"])

    # first the blocks of a few tasks each, then of all: no task adds up more than the square root of their number times a row
    schema = "i int, row array<double>"
    some = vectors.mapInArrow(blocks, schema).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(16)))
    some = some.repartition("i", "part").select("i", "row").mapInArrow(added, schema)
    rows = some.repartition("i").mapInArrow(added, schema).collect()
    out = np.zeros((size, size))
    for r in rows:
        out[r["i"]] = r["row"]
    out /= centre.n
    return (out + out.T) / 2


def polar_sign(a: np.ndarray) -> np.ndarray:
    """Unitary polar factor of a symmetric matrix by the QR-based dynamically weighted Halley iteration."""
    x = a / np.linalg.norm(a, 1)
    try:
        low = 0.9 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(1.0, max(low, _EPS)) if np.isfinite(low) else _EPS
    size, eye = len(x), np.eye(len(x))
    for _ in range(30):
        d = (4 * (1 - low ** 2) / low ** 4) ** (1 / 3)
        root = np.sqrt(1 + d)
        p = root + np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * root))) / 2
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        before = x
        if r > 100:
            both = np.linalg.qr(np.vstack((np.sqrt(r) * x, eye)))[0]
            x = q / r * x + (p - q / r) / np.sqrt(r) * both[:size] @ both[size:].T
        else:
            x = q / r * x + (p - q / r) * np.linalg.solve(eye + r * x.T @ x, x.T).T
        x = (x + x.T) / 2
        low = min(1.0, low * (p + q * low ** 2) / (1 + r * low ** 2))
        if abs(1 - low) < 10 * _EPS and np.linalg.norm(x - before) < 1e-8 * np.sqrt(size):
            break
    return 1.5 * x - 0.5 * x @ x @ x


def _cut(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below some shift, or None where no shift parts them."""
    size, diagonal = len(a), np.sort(np.diag(a))
    gaps = np.argsort(diagonal[:-1] - diagonal[1:], kind="stable")[:3]
    shifts = [np.median(diagonal), diagonal.mean(), *[(diagonal[g] + diagonal[g + 1]) / 2 for g in gaps],
              *[diagonal.mean() + f * np.linalg.norm(a - np.diag(np.diag(a))) / size for f in (0.1, -0.1, 0.5, -0.5)]]
    start = np.random.default_rng(size).standard_normal((size, size))
    for shift in shifts:
        moved = a - shift * np.eye(size)
        if not moved.any():
            continue
        project = (polar_sign(moved) + np.eye(size)) / 2
        above = int(round(np.trace(project)))
        if not 0 < above < size:
            continue
        high = np.linalg.qr(project @ start[:, :above])[0]
        high = np.linalg.qr(project @ high)[0]
        both = np.linalg.qr(high, mode="complete")[0]
        high, low = both[:, :above], both[:, above:]
        if np.linalg.norm(low.T @ a @ high) <= 100 * _EPS * scale * np.sqrt(size):
            return high, low
    return None


def spectral(a: np.ndarray, wanted: int | None = None, scale: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order, at least the ``wanted`` first, and their vectors as columns."""
    size = len(a)
    wanted = size if wanted is None else min(wanted, size)
    scale = np.linalg.norm(a) if scale is None else scale
    rest = a - np.diag(np.diag(a))
    cut = None if np.linalg.norm(rest) <= _EPS * scale else _cut(a, scale)
    if cut is None:
        if np.linalg.norm(rest) > 1e-10 * scale:
            raise ArithmeticError("no shift parts the matrix")
        order = np.argsort(-np.diag(a), kind="stable")
        return np.diag(a)[order], np.eye(size)[:, order]
    values, vectors = [], []
    for basis in cut:
        if sum(map(len, values)) >= wanted:
            break
        part = basis.T @ a @ basis
        e, v = spectral((part + part.T) / 2, wanted - sum(map(len, values)), scale)
        values.append(e)
        vectors.append(basis @ v)
    return np.concatenate(values), np.hstack(vectors)


class Whitening:
    """Centre, eigenvalues, scaled components and the share of variance they hold."""

    def __init__(self, centre: Centre | None, values: np.ndarray, weights: np.ndarray, explained: np.ndarray, identity_error: float | None):
        self.centre, self.values, self.weights, self.explained, self.identity_error = centre, values, weights, explained, identity_error


def fit_whitening(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Fit on all usable rows; ``identity_error`` is measured on the whitened rows."""
    vectors = df.select(F.lit(0).alias("id"), F.col(vector_col).alias("vector"))
    n, sums = exact_sums(vectors)
    if not n:
        return Whitening(None, np.zeros(0), np.zeros((0, 0)), np.zeros(0), None)
    centre = Centre(n, sums)
    v = covariance(vectors, centre)
    trace = float(np.trace(v))
    if trace <= 0:
        return Whitening(centre, np.zeros(0), np.zeros((len(sums), 0)), np.zeros(0), None)
    values, vectors_ = spectral(v, components)
    order = np.argsort(-values, kind="stable")[:components]
    values, basis = values[order], vectors_[:, order]
    real = values > ROUNDING * trace
    values, basis = values[real], basis[:, real]
    weights = basis / np.sqrt(values)
    error = np.abs(covariance(vectors, centre, weights) - np.eye(len(values))).max()
    return Whitening(centre, values, weights, values / trace, float(error))


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, deviation, whitened) per usable row; whitened holds one value per component."""
    source = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    schema = T.StructType([T.StructField("vec_id", source.schema["vec_id"].dataType), T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model.centre is None or not len(model.values):
        return df.sparkSession.createDataFrame([], schema)
    shared = df.sparkSession.sparkContext.broadcast((model.centre, model.weights))
    dims, count = model.weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, weights = shared.value
        for batch in batches:
            for rows, x in grid(batch, dims).values():
                y = centre.centred(x) @ weights
                ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * count)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(centre.deviation(x), pa.int64()),
                                                  pa.ListArray.from_arrays(ends, pa.array(y.ravel()))], ["vec_id", "deviation", "whitened"])

    return source.mapInArrow(run, schema)


def op11_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = fit_whitening(vectors)
    shares = F.array(*[F.lit(float(s)) for s in model.explained]) if len(model.explained) else F.array().cast("array<double>")
    rows = whiten(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.centre.n if model.centre else 0).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))

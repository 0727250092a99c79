"""Second-order boosted trees on histograms: squared, logistic, softmax and pinball loss.

Features are cut into at most ``BINS`` bins at approximate quantiles of the training rows and written once, one byte per
feature and row, with the running margins, a block of rows (an Arrow batch) in one row, so that a pass takes no row apart. A round grows one tree per output from the same gradients, level by level: every task adds
gradients and their derivatives up by (output, node, feature, bin), the blocks are added up by (output, node, feature), and the task that
holds a block returns the best cut of it. What reaches the driver is one row per output, node and feature. A split gains

    (T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2)) / 2,  T(G) = sign(G) max(|G| - l1, 0),

and a leaf is -T(G) / (H + l2). Leaves of a pinball loss are the exact quantile of their rows' residuals instead. Nodes follow from the
trees themselves, so a lost task is simply run again; margins are written anew every ``WRITTEN`` rounds, which keeps later
passes short. Rows and columns are drawn by hashes of row key, seed and round, the same in every attempt.

Missing values (null or NaN) count as smaller than any number. Rows without a label are left out of the fit.
"""

from __future__ import annotations

import copy
import json
import math
import random
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veldtab.functions.columns import name
from veldtab.functions.ordering import exact_quantiles
from veldtab.sources.storage import write_through

BINS = 64
#: Rounds after which the margins are written.
WRITTEN = 8
#: Features whose quantiles are taken in one aggregate.
AT_ONCE = 200
LEAST_GAIN = 1e-10
#: Nodes up to which the trees of a model of values are written as one column expression; the method made of it stays one that is compiled.
EXPRESSION_NODES = 150
#: Limit between missing values and numbers.
LOWEST = -np.finfo(float).max


@dataclass(frozen=True)
class TreeParams:
    n_estimators: int = 50
    max_depth: int = 4
    learning_rate: float = 0.1
    subsample: float = 0.8
    colsample: float = 0.8
    min_child_weight: float = 1
    l1: float = 0.0
    l2: float = 1.0

    def replaced(self, **changes) -> "TreeParams":
        return TreeParams(**{**self.__dict__, **changes})


# -- losses --------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Loss:
    """Gradients, curvature and value of a loss of (margins, label)."""

    kind: str
    outputs: int = 1
    quantile: float = 0.5

    def slopes(self, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.kind == "squared":
            return margin - y[:, None], np.ones_like(margin)
        if self.kind == "pinball":
            return np.where(y[:, None] > margin, -self.quantile, 1 - self.quantile), np.ones_like(margin)
        p = self.probabilities(margin)[:, -self.outputs:]
        hit = y[:, None] == (np.arange(self.outputs) if self.outputs > 1 else 1)
        return p - hit, np.maximum(p * (1 - p), 1e-16)

    def values(self, margin: np.ndarray, y: np.ndarray) -> np.ndarray:
        gap = y - margin[:, 0]
        if self.kind == "squared":
            return gap * gap
        if self.kind == "pinball":
            return np.maximum(self.quantile * gap, (self.quantile - 1) * gap)
        p = self.probabilities(margin)
        return -np.log(np.maximum(p[np.arange(len(y)), y.astype(int)], 1e-15))

    def probabilities(self, margin: np.ndarray) -> np.ndarray:
        """One column per class; a single margin is that of class 1 against class 0."""
        both = np.hstack((np.zeros_like(margin), margin)) if self.outputs == 1 else margin
        e = np.exp(both - both.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    @property
    def classifies(self) -> bool:
        return self.kind in ("logistic", "softmax")


def loss_for(task: str, n_classes: int = 2) -> Loss:
    if task == "regression":
        return Loss("squared")
    return Loss("logistic") if n_classes <= 2 else Loss("softmax", n_classes)


# -- trees ---------------------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes as lists; the children of node i are 2i+1 and 2i+2, a feature of -1 is a leaf. ``cut`` is the last bin that goes left."""

    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0])
    threshold: list = field(default_factory=lambda: [0.0])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, threshold: float, gain: float, left: float, right: float) -> None:
        need = 2 * node + 3 - len(self.feature)
        for values, empty in ((self.feature, -1), (self.cut, 0), (self.threshold, 0.0), (self.value, 0.0), (self.gain, 0.0)):
            values += [empty] * max(0, need)
        self.feature[node], self.cut[node], self.threshold[node], self.gain[node] = feature, cut, threshold, gain
        self.value[2 * node + 1], self.value[2 * node + 2] = left, right

    def nodes(self, table: np.ndarray, limits: list) -> np.ndarray:
        """The node every row of a table of bins (or of values, with thresholds) ends in; NaN goes left."""
        return self.walk(limits)(table)

    def walk(self, limits: list) -> Callable[[np.ndarray], np.ndarray]:
        """``nodes`` of any number of tables: leaves above the last level pass their rows on to the left, so that all rows go down alike."""
        depth = len(self.feature).bit_length() - 1
        size = 2 ** (depth + 1) - 1
        feature, limit, end = np.zeros(size, np.int64), np.full(size, np.inf), np.zeros(size, np.int64)
        for i in range(size):
            above = (i - 1) // 2
            if i and self._leaf(above):
                end[i] = end[above]
            else:
                end[i] = i
                if not self._leaf(i):
                    feature[i], limit[i] = self.feature[i], limits[i]

        def run(table: np.ndarray) -> np.ndarray:
            if not depth:
                return np.zeros(len(table), np.int64)
            flat, start = table.reshape(-1), np.arange(0, table.size, table.shape[1])
            at = 1 + (table[:, feature[0]] > limit[0])
            for _ in range(1, depth):
                right = flat[start + feature[at]] > limit[at]
                at = 2 * at + 1 + right
            return end[at]

        return run

    def _leaf(self, node: int) -> bool:
        return node >= len(self.feature) or self.feature[node] < 0

    def leaves(self) -> list[int]:
        out, open_ = [], [0]
        while open_:
            node = open_.pop()
            if self.feature[node] < 0:
                out.append(node)
            else:
                open_ += [2 * node + 1, 2 * node + 2]
        return sorted(out)


@dataclass(frozen=True)
class BoostedModel:
    """Rounds of one tree per output, on thresholds of the feature values."""

    loss: Loss
    base: tuple
    rate: float
    rounds: tuple
    width: int
    features: str = "features"
    losses: tuple = ()

    @property
    def getNumTrees(self) -> int:
        return len(self.rounds)

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gain of all splits."""
        total = np.zeros(self.width)
        for trees in self.rounds:
            for tree in trees:
                for f, g in zip(tree.feature, tree.gain):
                    if f >= 0:
                        total[f] += g
        return DenseVector(total / total.sum() if total.sum() else total)

    def upto(self, n: int) -> "BoostedModel":
        """The model after its first n rounds."""
        return BoostedModel(self.loss, self.base, self.rate, self.rounds[:n], self.width, self.features, self.losses)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(np.array(self.base, float), (len(x), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += (self.rate * np.array(tree.value))[tree.nodes(x, tree.threshold)]
        return out

    def margin_sql(self, x: str) -> str | None:
        """The margin of a model of one output as SQL over the columns ``x``0, ``x``1, .. of ``slots``, added up as in ``margins``; None beyond ``EXPRESSION_NODES`` nodes."""
        trees = [own[0] for own in self.rounds]
        if self.loss.outputs > 1 or sum(2 * len(tree.leaves()) - 1 for tree in trees) > EXPRESSION_NODES:
            return None

        def of(tree: Tree, node: int) -> str:
            if tree.feature[node] < 0:
                return _literal(self.rate * tree.value[node])
            return f"case when {x}{tree.feature[node]} <= {_literal(tree.threshold[node])} then {of(tree, 2 * node + 1)} else {of(tree, 2 * node + 2)} end"

        return " + ".join([_literal(self.base[0]), *[f"({of(tree, 0)})" for tree in trees]])

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds probs, p and pred for classes, yhat for values. Works on streams. Small models of values are column expressions, so that no row leaves the JVM."""
        sql = None if self.loss.classifies else self.margin_sql("_x")
        if sql:
            used = {f for own in self.rounds for f in own[0].feature if f >= 0}
            x = as_array(df, self.features)
            whole = F.when(F.size(x) == self.width, x).otherwise(F.raise_error("feature vectors are missing or differ in length"))
            lowest = F.lit(float("-inf"))
            return with_slots(df, whole, used, lambda v: F.nanvl(F.coalesce(v, lowest), lowest), {"yhat": sql})
        shared = df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def score(features: pa.Array) -> pa.Array:
            model = shared.value
            margin = model.margins(matrix(features))
            return lists(model.loss.probabilities(margin) if model.loss.classifies else margin)

        out = df.withColumn("_out", score(as_array(df, self.features)))
        if not self.loss.classifies:
            return out.withColumn("yhat", F.col("_out")[0]).drop("_out")
        out = out.withColumnRenamed("_out", "probs")
        if self.loss.outputs == 1:
            return out.withColumn("p", F.col("probs")[1]).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
        return out.withColumn("pred", F.array_position("probs", F.array_max("probs")).cast("int") - 1)

    def save(self, path: str) -> None:
        about = json.dumps(asdict(self))
        SparkSession.active().createDataFrame([(about,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(path: str) -> "BoostedModel":
        d = json.loads(SparkSession.active().read.text(path).first()["value"])
        rounds = tuple(tuple(Tree(**t) for t in trees) for trees in d["rounds"])
        return BoostedModel(Loss(**d["loss"]), tuple(d["base"]), d["rate"], rounds, d["width"], d["features"], tuple(map(tuple, d["losses"])))


def _literal(v: float) -> str:
    """SQL literal of a double, finite or not."""
    return f"{float(v)!r}D" if math.isfinite(v) else f"double('{float(v)!r}')"


def as_array(df: DataFrame, features: str) -> Column:
    return vector_to_array(features) if isinstance(df.schema[features].dataType, VectorUDT) else name(features).cast("array<double>")


def with_slots(df: DataFrame, x: Column | list[Column], used: set[int], known: Callable[[Column], Column], added: dict[str, str]) -> DataFrame:
    """Adds columns given as SQL over ``_x0``, ``_x1``, ..: the ``known`` values, never null, of the ``used`` slots of an array (or list of columns). Each slot is a column that is
    computed once a row, however often the SQL names it; an array looked into at every node would be taken apart at every node."""
    names = {i: f"_x{i}" for i in sorted(used)}
    if isinstance(x, list):
        slots = df.withColumns({c: known(x[i]) for i, c in names.items()})
    else:
        slots = df.withColumn("_x", x).withColumns({c: known(F.col("_x")[i]) for i, c in names.items()})
    return slots.withColumns({c: F.expr(sql) for c, sql in added.items()}).drop("_x", *names.values())


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of an array column, nulls as NaN."""
    if not len(column):
        return np.zeros((0, 1))
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if (sizes != sizes[0]).any():
        raise ValueError("feature vectors are missing or differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def lists(values: np.ndarray) -> pa.Array:
    """A table of numbers as an array column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.reshape(-1)))


def bin_limits(rows: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Upper limits of the bins of each feature, but for the last: approximate quantiles, each once."""
    # one bin is left for missing values
    wanted = F.array(*[F.lit(i / (bins - 1)) for i in range(1, bins - 1)])
    out = []
    for at in range(0, width, AT_ONCE):
        some = range(at, min(width, at + AT_ONCE))
        x = lambda j: F.when(~F.isnan(F.col("x")[j]), F.col("x")[j])
        found = rows.agg(*[F.percentile_approx(x(j), wanted, 20 * bins).alias(f"q{j}") for j in some], *[F.max(x(j)).alias(f"m{j}") for j in some],
                         *[F.count_if(x(j).isNull()).alias(f"n{j}") for j in some]).first()
        for j in some:
            limits = {q for q in found[f"q{j}"] or [] if q < found[f"m{j}"]} | ({LOWEST} if found[f"n{j}"] else set())
            out.append(np.array(sorted(limits), float))
    return out


# -- fit -----------------------------------------------------------------------------------------

class Boosting:
    """A fit that goes on round by round; ``train_losses`` and ``held_losses`` hold the loss after each round."""

    def __init__(self, train: DataFrame, loss: Loss, params: TreeParams, *, label: str = "y", features: str = "features", weight: str | None = None,
                 key_cols: list[str] = (), validation: DataFrame | None = None, seed: int = 42, bins: int = BINS):
        if not 3 <= bins <= 256:
            raise ValueError("3 to 256 bins")
        self.loss, self.params, self.seed, self.features, self.validated = loss, params, seed, features, validation is not None
        parts = [self._rows(df, label, features, weight, key_cols, held) for df, held in ((train, False), (validation, True)) if df is not None]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        first = parts[0].select(F.size("x").alias("n")).first()
        if first is None:
            raise ValueError("no row to learn from")
        self.width = first["n"]
        self.limits = bin_limits(parts[0], self.width, bins)
        self.bins = bins
        self.base = self._base(parts[0])
        self.rows = write_through(self._binned(rows), "boosting")
        self.trees: list[tuple] = []
        self.fresh = 0
        self.train_losses, self.held_losses = [], []

    def afresh(self, params: TreeParams) -> "Boosting":
        """Another fit of the same rows, from their bins; only before the first round."""
        if self.trees:
            raise ValueError("rounds have been fitted")
        other = copy.copy(self)
        other.params, other.trees, other.train_losses, other.held_losses = params, [], [], []
        return other

    @staticmethod
    def _rows(df: DataFrame, label: str, features: str, weight: str | None, key_cols: list[str], held: bool) -> DataFrame:
        x = as_array(df, features)
        key = F.xxhash64(*[name(c) for c in key_cols]) if key_cols else F.xxhash64(x, name(label))
        return df.where(name(label).isNotNull()).select(
            F.lit(held).alias("held"), name(label).cast("double").alias("y"), (name(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
            key.alias("key"), x.alias("x"))

    def _base(self, rows: DataFrame) -> np.ndarray:
        """The best constant: mean, log-odds, log shares of the classes, or quantile."""
        if self.loss.kind == "pinball":
            return np.array([exact_quantiles(rows.select(F.lit(0).alias("g"), "y"), ["g"], "y", [self.loss.quantile]).first()["quantile"]])
        if self.loss.kind == "softmax":
            sizes = {int(r["y"]): r["w"] for r in rows.groupBy("y").agg(F.sum("w").alias("w")).collect()}
            if max(sizes) >= self.loss.outputs or min(sizes) < 0:
                raise ValueError(f"labels must be 0 to {self.loss.outputs - 1}")
            share = np.array([sizes.get(k, 0.0) for k in range(self.loss.outputs)]) + 1e-9
            return np.log(share / share.sum())
        mean = rows.agg((F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("m")).first()["m"]
        if self.loss.kind == "squared":
            return np.array([mean])
        mean = min(max(mean, 1e-9), 1 - 1e-9)
        return np.array([math.log(mean / (1 - mean))])

    def _binned(self, rows: DataFrame) -> DataFrame:
        limits, base = self.limits, self.base.tolist()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = matrix(batch.column("x")).T
                if len(x) != len(limits):
                    raise ValueError("feature vectors are missing or differ in length")
                binned = np.empty((batch.num_rows, len(limits)), np.uint8)
                for j, c in enumerate(limits):
                    binned[:, j] = np.searchsorted(c, np.where(np.isnan(x[j]), -np.inf, x[j]), "left")
                yield block(*[batch.column(c).to_numpy(zero_copy_only=False) for c in ("held", "y", "w", "key")], binned, np.tile(base, (batch.num_rows, 1)))

        return rows.mapInArrow(run, _BLOCK)

    def _reader(self, fresh: list):
        """The blocks of a task as arrays, with the margins after the ``fresh`` rounds."""
        width, rate = self.width, self.params.learning_rate
        steps = [(k, tree.walk(tree.cut), rate * np.array(tree.value)) for trees in fresh for k, tree in enumerate(trees)]

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    held, y, w, key, binned, margin = (np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in _KINDS.items())
                    binned, margin = binned.reshape(-1, width), margin.reshape(len(y), -1).copy()
                    for k, walk, value in steps:
                        margin[:, k] += value[walk(binned)]
                    yield held, y, w, key, binned, margin

        return read

    def _level(self, trees: list[Tree], nodes: list[list[int]], columns: list[int], with_loss: bool) -> list:
        """Best cut of every (output, open node, feature), and the sums of the losses."""
        loss, seed, number, bins, params = self.loss, self.seed, len(self.trees), self.bins, self.params
        read = self._reader(self.trees[len(self.trees) - self.fresh:])
        sizes = [len(c) for c in self.limits]
        walks = [tree.walk(tree.cut) for tree in trees]
        places = [np.full(len(tree.feature), -1) for tree in trees]
        for place, own in zip(places, nodes):
            place[own] = range(len(own))

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros((2, len(columns), len(own) * bins)) for own in nodes]
            sums = np.zeros(4)
            for held, y, w, key, binned, margin in read(batches):
                if with_loss:
                    value = loss.values(margin, y) * w
                    sums += [value[~held].sum(), w[~held].sum(), value[held].sum(), w[held].sum()]
                use = ~held & drawn(key, seed, number, params.subsample)
                g, h = (s * w[:, None] for s in loss.slopes(margin, y))
                for k, walk in enumerate(walks):
                    if not nodes[k]:
                        continue
                    where = places[k][walk(binned)]
                    mine = np.flatnonzero(use & (where >= 0))
                    start, gk, hk = where[mine] * bins, g[mine, k], h[mine, k]
                    features = np.ascontiguousarray(binned[mine].T)
                    for c, j in enumerate(columns):
                        cell = start + features[j]
                        total[k][0, c] += np.bincount(cell, gk, len(nodes[k]) * bins)
                        total[k][1, c] += np.bincount(cell, hk, len(nodes[k]) * bins)
            out = [(k, s, j, total[k][0, c, s * bins:(s + 1) * bins], total[k][1, c, s * bins:(s + 1) * bins])
                   for k, own in enumerate(nodes) for s in range(len(own)) for c, j in enumerate(columns)]
            if with_loss:
                out.append((-1, 0, 0, sums[:2], sums[2:]))
            yield _table(out)

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple, list] = {}
            for batch in batches:
                for k, s, j, g, h in zip(*[batch.column(i).to_pylist() for i in range(3)], batch.column(3), batch.column(4)):
                    own = total.setdefault((k, s, j), [0.0, 0.0])
                    own[0], own[1] = own[0] + g.values.to_numpy(), own[1] + h.values.to_numpy()
            out = []
            for (k, s, j), (g, h) in total.items():
                if k < 0:
                    out.append((k, s, j, g, h))
                    continue
                cut, gain, left = best_cut(g, h, sizes[j], params)
                out.append((k, s, j, [float(cut), gain, *left], [g.sum(), h.sum()]))
            yield _table(out)

        made = self.rows.mapInArrow(blocks, _SCHEMA).repartition("k", "s", "j").mapInArrow(best, _SCHEMA).collect()
        if with_loss:
            sums = next(r for r in made if r["k"] < 0)
            self._note(sums["a"], sums["b"])
        return [(r["k"], nodes[r["k"]][r["s"]], r["j"], r["a"], r["b"]) for r in made if r["k"] >= 0]

    def _note(self, train: list[float], held: list[float]) -> None:
        if self.trees and len(self.train_losses) < len(self.trees):
            self.train_losses.append(train[0] / train[1] if train[1] else float("nan"))
            self.held_losses.append(held[0] / held[1] if held[1] else float("nan"))

    def step(self, patience: int | None = None) -> bool:
        """One more round, unless the losses up to here show that ``patience`` rounds have not bettered the least one on the held rows."""
        p, number = self.params, len(self.trees)
        chosen = max(1, round(p.colsample * self.width))
        columns = sorted(random.Random(f"{self.seed}:{number}").sample(range(self.width), chosen))
        trees = [Tree() for _ in range(self.loss.outputs)]
        nodes = [[0] for _ in trees]
        for depth in range(p.max_depth):
            found: dict[tuple, tuple] = {}
            level = self._level(trees, nodes, columns, depth == 0)
            if no_better_for(self.held_losses, patience):
                return False
            for k, node, j, (cut, gain, gl, hl), (g, h) in level:
                if (k, node) not in found or (-gain, j) < (-found[k, node][0], found[k, node][1]):
                    found[k, node] = gain, j, int(cut), gl, hl, g, h
            nodes = [[] for _ in trees]
            for (k, node), (gain, j, cut, gl, hl, g, h) in sorted(found.items()):
                if not node:
                    trees[k].value[0] = leaf(g, h, p)
                if gain > LEAST_GAIN:
                    trees[k].split(node, j, cut, float(self.limits[j][cut]), gain, leaf(gl, hl, p), leaf(g - gl, h - hl, p))
                    nodes[k] += [2 * node + 1, 2 * node + 2]
            if not any(nodes):
                break
        if self.loss.kind == "pinball":
            self._refit(trees[0])
        self.trees.append(tuple(trees))
        self.fresh += 1
        if self.fresh == WRITTEN:
            self._write()
        return True

    def recentre(self) -> None:
        """Add the exact quantile of all residuals to the constant: slow learning leaves a quantile too far out, by the same amount everywhere."""
        stump = Tree()
        self._refit(stump, 1.0)
        self.base = self.base + stump.value[0]

    def _refit(self, tree: Tree, rows_drawn: float | None = None) -> None:
        """Leaves become the exact quantile of their rows' residuals."""
        read, seed, number, share = self._reader(self.trees[len(self.trees) - self.fresh:]), self.seed, len(self.trees), rows_drawn or self.params.subsample

        walk = tree.walk(tree.cut)

        def residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for held, y, _, key, binned, margin in read(batches):
                use = ~held & drawn(key, seed, number, share)
                yield pa.RecordBatch.from_arrays([pa.array(walk(binned)[use]), pa.array((y - margin[:, 0])[use])], ["leaf", "r"])

        rows = write_through(self.rows.mapInArrow(residuals, "leaf long, r double"), "boosting-residuals")
        for r in exact_quantiles(rows, ["leaf"], "r", [self.loss.quantile]).collect():
            tree.value[r["leaf"]] = r["quantile"]

    def _write(self) -> None:
        read = self._reader(self.trees[len(self.trees) - self.fresh:])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in read(batches):
                yield block(*rows)

        self.rows, self.fresh = write_through(self.rows.mapInArrow(run, _BLOCK), "boosting"), 0

    def measure(self) -> None:
        """Note the losses after the last round."""
        if len(self.train_losses) < len(self.trees):
            self._level([Tree() for _ in range(self.loss.outputs)], [[] for _ in range(self.loss.outputs)], [], True)

    def model(self, rounds: int | None = None) -> BoostedModel:
        losses = tuple(zip(self.train_losses, self.held_losses))
        return BoostedModel(self.loss, tuple(self.base.tolist()), self.params.learning_rate, tuple(self.trees[:rounds]), self.width, self.features, losses)


#: The columns of a block of rows, one after the other.
_KINDS = {"held": np.bool_, "y": np.float64, "w": np.float64, "key": np.int64, "bins": np.uint8, "margin": np.float64}
_BLOCK = ", ".join(f"{c} binary" for c in _KINDS)


def block(*columns: np.ndarray) -> pa.RecordBatch:
    """One row with the bytes of each column of a block of rows."""
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v, kind).tobytes()], pa.binary()) for v, kind in zip(columns, _KINDS.values())], list(_KINDS))


def drawn(key: np.ndarray, seed: int, number: int, share: float) -> np.ndarray:
    """Rows that take part in a round, by the hash of their key."""
    if share >= 1:
        return np.ones(len(key), bool)
    h = (key.view(np.uint64) ^ np.uint64((seed * 1_000_003 + number) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (h >> np.uint64(11)).astype(float) / 2.0 ** 53 < share


_SCHEMA = "k int, s int, j int, a array<double>, b array<double>"


def _table(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    kinds = [pa.int32()] * 3 + [pa.list_(pa.float64())] * 2
    return pa.RecordBatch.from_arrays([pa.array([list(v) for v in c] if i > 2 else list(c), kind) for i, (c, kind) in enumerate(zip(columns, kinds))], ["k", "s", "j", "a", "b"])


def leaf(g: float, h: float, p: TreeParams) -> float:
    return -math.copysign(max(abs(g) - p.l1, 0.0), g) / (h + p.l2) if h + p.l2 > 0 else 0.0


def best_cut(g: np.ndarray, h: np.ndarray, cuts: int, p: TreeParams) -> tuple[int, float, tuple]:
    """(last bin to the left, gain, (GL, HL)) of the best cut of one node by one feature; no cut has gain 0."""
    left_g, left_h = np.cumsum(g)[:cuts], np.cumsum(h)[:cuts]
    all_g, all_h = g.sum(), h.sum()

    def worth(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        kept = np.maximum(np.abs(a) - p.l1, 0.0)
        return np.divide(kept * kept, b + p.l2, out=np.zeros_like(kept), where=b + p.l2 > 0)

    if not cuts:
        return 0, 0.0, (0.0, 0.0)
    gain = (worth(left_g, left_h) + worth(all_g - left_g, all_h - left_h) - worth(np.array([all_g]), np.array([all_h]))) / 2
    gain[(left_h < p.min_child_weight) | (all_h - left_h < p.min_child_weight)] = 0.0
    at = int(gain.argmax())
    return at, float(max(gain[at], 0.0)), (float(left_g[at]), float(left_h[at]))


def no_better_for(losses: list[float], patience: int | None) -> bool:
    """Whether ``patience`` losses follow the least one; losses that are not numbers (no held rows) never end a fit."""
    return bool(patience and losses) and not math.isnan(losses[0]) and len(losses) - 1 - int(np.argmin(losses)) >= patience


def fit_boosted(train: DataFrame, loss: Loss, params: TreeParams = TreeParams(), *, validation: DataFrame | None = None, patience: int | None = None, **options) -> BoostedModel:
    """Fit ``n_estimators`` rounds. With validation rows the model is cut after the round of the least loss on them, and stops early once
    ``patience`` rounds have not bettered it; ``losses`` has all rounds fitted."""
    return fit_rounds(Boosting(train, loss, params, validation=validation, **options), patience)


def fit_rounds(fit: Boosting, patience: int | None = None) -> BoostedModel:
    """All rounds of a fit that has been set up, as in ``fit_boosted``."""
    for _ in range(fit.params.n_estimators):
        if not fit.step(patience):
            break
    if not fit.validated:
        if fit.loss.kind == "pinball":
            fit.recentre()
        return fit.model()
    fit.measure()
    return fit.model(int(np.argmin(fit.held_losses)) + 1)

"""Model diagnostics as tables. Each takes a ``score`` function: DataFrame with the feature columns in,
the same rows with a ``value`` column (score or prediction) out."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veldtab.functions.columns import chunks, name
from veldtab.functions.hashing import hash_order
from veldtab.functions.ordering import collect_quantiles, exact_quantiles, integer_coarse_key
from veldtab.operators.boosting import BoostedModel, as_array, matrix
from veldtab.operators.models import TreeParams, components_kept, fit_spread, score_model, tree_estimator
from veldtab.operators.prep import fit_median_imputer
from veldtab.sources.storage import write_through
from veldtab.operators.splits import CURVE_SHARES, nested_samples, stratified_sample

Scorer = Callable[[DataFrame], DataFrame]
#: Buckets of ``integer_coarse_key``.
BUCKETS = 4096
#: Pairs of features whose scores of a row are held side by side.
PAIRS_AT_ONCE = 45


def _ranked(df: DataFrame, seed: int, columns: list[str], out: str, first: int | None = None) -> DataFrame:
    """Adds the place of each row, 0.., in the order of a hash of the columns (of the ``first`` rows only); no task ever holds the whole order.
    The rows before each bucket are one value of the query, so that no pass is run for places that are not read."""
    hashed = df.withColumn("_h", hash_order(seed, columns)).withColumn("_bucket", integer_coarse_key(F.col("_h")))
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    counted = hashed.groupBy("_bucket").agg(F.count("*").alias("_n")).select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_below"))
    every = df.sparkSession.range(BUCKETS).withColumnRenamed("id", "_bucket").join(counted, "_bucket", "left")
    below = every.agg(F.array_sort(F.collect_list(F.struct("_bucket", "_below")))["_below"].alias("_list")).scalar()
    ranked = hashed.withColumn("_below", F.get(below, F.col("_bucket").cast("int")))
    if first is not None:
        ranked = ranked.where(F.col("_below") < first)
    inside = Window.partitionBy("_bucket").orderBy("_h", *[name(c) for c in columns])
    ranked = ranked.withColumn(out, F.col("_below") + F.row_number().over(inside) - 1)
    return (ranked if first is None else ranked.where(F.col(out) < first)).drop("_h", "_bucket", "_below")


def _sample(df: DataFrame, key_cols: list[str], rows: int | None, seed: int) -> DataFrame:
    """All rows, or the first ``rows`` in hash order, numbered 0.. in that order."""
    return _ranked(df, seed, key_cols, "_row", rows)


def permutation_importance(df: DataFrame, score: Scorer, metric: Callable[[DataFrame], float], features: list[str], key_cols: list[str], *,
                           repeats: int = 3, max_rows: int | None = None, top: int | None = None, seed: int = 42) -> DataFrame:
    """(feature, mean_drop, std_drop): metric lost when one column is shuffled among the rows (all, or ``max_rows`` of them)."""
    base = write_through(_sample(df, key_cols, max_rows, seed), "permutation")
    whole = metric(score(base))
    drops: dict[str, list[float]] = {f: [] for f in features}
    for k in range(repeats):
        # A second hash order gives every row another row: a join on the two places, once for all features.
        again = _ranked(base.select("_row", *[name(f) for f in features]), seed + 1 + k, ["_row"], "_place")
        donors = again.select(F.col("_place").alias("_row"), F.struct(*[name(f) for f in features]).alias("_donor"))
        paired = write_through(base.join(donors, "_row"), "permutation")
        for f in features:
            drops[f].append(whole - metric(score(paired.withColumn(f, F.col("_donor")[f]).drop("_donor"))))
    mean = {f: sum(d) / repeats for f, d in drops.items()}
    rows = [(f, mean[f], math.sqrt(sum((x - mean[f]) ** 2 for x in d) / repeats)) for f, d in drops.items()]
    rows.sort(key=lambda x: (-x[1], x[0]))
    return df.sparkSession.createDataFrame(rows[:top], "feature string, mean_drop double, std_drop double")


def learning_curve(prepared: DataFrame, validation: DataFrame, task: str, metric: str, class_col: str, key_cols: list[str], *,
                   params: TreeParams = TreeParams(20, 3), label: str = "y", max_rows: int | None = None) -> DataFrame:
    """(share, n_rows, train_score, val_score) on nested samples of all rows, or of ``max_rows`` in the proportions of the classes."""
    capped = prepared if max_rows is None else stratified_sample(prepared, class_col, key_cols, min(max_rows, prepared.count()))
    levels = nested_samples(capped, class_col, key_cols).persist()
    rows = []
    try:
        for i, share in enumerate(CURVE_SHARES):
            part = levels.where(F.col("level") <= i)
            model = fit_spread(tree_estimator(task, params, label=label), part)
            rows.append((float(share), part.count(), score_model(model, part, task, metric, label), score_model(model, validation, task, metric, label)))
    finally:
        levels.unpersist()
    return prepared.sparkSession.createDataFrame(rows, "share double, n_rows bigint, train_score double, val_score double")


# -- principal components ------------------------------------------------------------------------

def fit_components(df: DataFrame, cols: list[str] | None = None, vector: str | None = None):
    """Centred principal components of numeric columns or of a vector column: (transform, explained)."""
    source = vector or "_v"
    def assemble(x: DataFrame) -> DataFrame:
        return x if vector else VectorAssembler(inputCols=cols, outputCol="_v", handleInvalid="skip").transform(x)
    base = assemble(df)
    width = len(base.select(source).first()[0])
    centre = StandardScaler(inputCol=source, outputCol="_c", withMean=True, withStd=False).fit(base)
    pca = PCA(k=width, inputCol="_c", outputCol="_pc").fit(centre.transform(base))
    return (lambda x: pca.transform(centre.transform(assemble(x)))), [float(v) for v in pca.explainedVariance.toArray()]


def scree(explained: list[float], df: DataFrame, variance: float = 0.95) -> DataFrame:
    """(component, explained, cumulative, kept)."""
    rows = [(i + 1, v) for i, v in enumerate(explained)]
    table = df.sparkSession.createDataFrame(rows, "component int, explained double")
    running = Window.partitionBy(F.lit(0)).orderBy("component").rowsBetween(Window.unboundedPreceding, 0)  # one row per component
    kept = components_kept(explained, variance)
    return table.withColumn("cumulative", F.sum("explained").over(running)).withColumn("kept", F.col("component") <= kept)


def projection(df: DataFrame, transform: Scorer, keep: list[str], k: int = 3) -> DataFrame:
    """First ``k`` components next to the kept columns."""
    parts = vector_to_array("_pc")
    return transform(df).select(*[name(c) for c in keep], *[parts[i].alias(f"pc{i + 1}") for i in range(k)])


# -- outliers ------------------------------------------------------------------------------------

TREES = 100
TREE_ROWS = 256


def isolation_trees(train: DataFrame, cols: list[str], key_cols: list[str], *, trees: int = TREES, rows_per_tree: int = TREE_ROWS, seed: int = 42) -> str:
    """Random isolation trees, one group of at most a few hundred sampled rows per tree, as JSON."""
    n = train.count()
    wanted = min(n, trees * rows_per_tree)
    h = hash_order(seed, key_cols)
    # Hash threshold instead of a sort; a little more than needed so that groups are filled.
    limit = int(min(1.0, 1.2 * wanted / max(n, 1)) * 16 ** 15)
    sample = (train.select(*[name(c).cast("double").alias(c) for c in cols], h.alias("_h")).where(F.col("_h") < limit)
              .na.drop(subset=cols).withColumn("tree", (F.col("_h") % trees).cast("int")))

    def build(pdf):
        import numpy as np
        tree_id = int(pdf["tree"].iloc[0])
        data = pdf.sort_values("_h")[cols].to_numpy()[:rows_per_tree]
        rng = np.random.default_rng(seed + tree_id)
        depth_limit = int(np.ceil(np.log2(max(len(data), 2))))
        nodes = []

        def grow(part, depth):
            node = len(nodes)
            nodes.append(None)
            spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(len(cols))
            splittable = np.flatnonzero(spread > 0)
            if depth >= depth_limit or len(part) <= 1 or len(splittable) == 0:
                nodes[node] = [-1, 0.0, int(len(part)), depth]
                return node
            f = int(rng.choice(splittable))
            cut = float(rng.uniform(part[:, f].min(), part[:, f].max()))
            left, right = grow(part[part[:, f] < cut], depth + 1), grow(part[part[:, f] >= cut], depth + 1)
            nodes[node] = [f, cut, left, right]
            return node

        grow(data, 0)
        return pd.DataFrame({"tree": [tree_id], "nodes": [json.dumps(nodes)], "rows": [len(data)]})

    built = sample.groupBy("tree").applyInPandas(build, "tree int, nodes string, rows int").orderBy("tree").collect()
    return json.dumps({"trees": [json.loads(b["nodes"]) for b in built], "rows": max((b["rows"] for b in built), default=1)})


def outlier_scores(df: DataFrame, cols: list[str], forest: str, out: str = "outlier_score") -> DataFrame:
    """Anomaly score in (0, 1) by mean path length; vectorised over Arrow batches."""
    @F.pandas_udf("double")
    def score(frame: pd.DataFrame) -> pd.Series:
        import numpy as np
        parsed = json.loads(forest)
        x = frame.fillna(0.0).to_numpy(dtype=float)

        def expected(n):
            return 0.0 if n <= 1 else 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n

        total = np.zeros(len(x))
        for nodes in parsed["trees"]:
            stack = [(0, np.arange(len(x)))]
            while stack:
                node, idx = stack.pop()
                f, cut, a, b = nodes[node]
                if f < 0:
                    total[idx] += b + expected(a)
                elif len(idx):
                    left = x[idx, f] < cut
                    stack += [(a, idx[left]), (b, idx[~left])]
        mean = total / max(len(parsed["trees"]), 1)
        return pd.Series(np.power(2.0, -mean / max(expected(parsed["rows"]), 1e-9)))

    return df.withColumn(out, score(F.struct(*[name(c).cast("double").alias(c) for c in cols])))


def outlier_report(train: DataFrame, test: DataFrame, cols: list[str], key_cols: list[str], *, contamination: float = 0.05, trees: int = TREES) -> DataFrame:
    """Test rows with score and flag, missing values replaced by the train medians; the cut-off is the train quantile at 1 - contamination."""
    medians = fit_median_imputer(train, cols)
    train, test = medians.transform(train), medians.transform(test)
    forest = isolation_trees(train, cols, key_cols, trees=trees)
    scores = outlier_scores(train.select(*[name(c) for c in cols]), cols, forest).select("outlier_score")
    cut = exact_quantiles(scores, [], "outlier_score", [1 - contamination]).first()["quantile"]
    return outlier_scores(test, cols, forest).withColumn("is_outlier", F.col("outlier_score") > cut)


# -- dependence and contributions ----------------------------------------------------------------

def dependence_grid(df: DataFrame, features: list[str], points: int = 40) -> dict[str, list[float]]:
    ends = collect_quantiles(df, features, [0.05, 0.95])
    return {f: [e[0.05] + (e[0.95] - e[0.05]) * i / (points - 1) for i in range(points)] for f, e in ends.items() if e}


def individual_curves(df: DataFrame, score: Scorer, features: list[str], key_cols: list[str], *, points: int = 40, max_rows: int | None = None, seed: int = 42) -> DataFrame:
    """(feature, grid, row, value): each row (all, or ``max_rows`` of them) scored at every grid point of every feature."""
    grid = dependence_grid(df, features, points)
    base = _sample(df, key_cols, max_rows, seed)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f"), F.lit(v).alias("v")) for i, (f, values) in enumerate(grid.items()) for v in values])
    wide = base.withColumn("_cell", F.explode(cells)).withColumns({
        f: F.when(F.col("_cell.i") == i, F.col("_cell.v")).otherwise(name(f).cast("double")) for i, f in enumerate(grid)})
    return score(wide).select(F.col("_cell.f").alias("feature"), F.col("_cell.v").alias("grid"), F.col("_row").alias("row"), "value")


def partial_dependence(curves: DataFrame) -> DataFrame:
    return curves.groupBy("feature", "grid").agg(F.avg("value").alias("mean_value"), F.count("*").alias("n_rows"))


def tree_dependence(model: BoostedModel, rows: DataFrame, grid: dict[int, list[float]], output: int = 0) -> DataFrame:
    """(feature, grid, mean_value, n_rows): the mean margin of one output over all rows with one feature set to a value, from one aggregate.

    A row with a feature set ends in the leaves whose path it fits but for the conditions on that feature. One pass counts for every leaf, and for every
    feature on its path, the rows that fit the rest; each point of the grid is then a sum over leaves.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    trees = [own[output] for own in model.rounds]

    def paths(tree) -> list[tuple[int, list[tuple[int, bool]]]]:
        out = []
        for end in tree.leaves():
            steps, node = [], end
            while node:
                steps.append(((node - 1) // 2, node % 2 == 0))
                node = (node - 1) // 2
            out.append((end, steps))
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, int] = {}
        own = [t[output] for t in shared.value.rounds]
        routes = [paths(t) for t in own]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.ascontiguousarray(matrix(batch.column(0)).T)
            for number, (tree, leaves) in enumerate(zip(own, routes)):
                right = {node: x[tree.feature[node]] > tree.threshold[node] for _, steps in leaves for node, _ in steps}
                for end, steps in leaves:
                    for without in {-1, *(tree.feature[node] for node, _ in steps)}:
                        fits = np.ones(x.shape[1], bool)
                        for node, goes_right in steps:
                            if tree.feature[node] != without:
                                fits &= right[node] == goes_right
                        total[number, end, without] = total.get((number, end, without), 0) + int(np.count_nonzero(fits))
        yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in total], pa.int32()) for i in range(3)] + [pa.array(list(total.values()), pa.int64())], ["tree", "leaf", "without", "n"])

    counted = rows.select(as_array(rows, model.features).alias("x")).mapInArrow(count, "tree int, leaf int, without int, n long")
    fits = {(r["tree"], r["leaf"], r["without"]): r["n"] for r in counted.groupBy("tree", "leaf", "without").agg(F.sum("n").alias("n")).collect()}
    n_rows = sum(n for (tree, _, without), n in fits.items() if not tree and without < 0)
    points = []
    for feature, values in grid.items():
        for v in values:
            mean = model.base[output]
            for number, tree in enumerate(trees):
                for end, steps in paths(tree):
                    own = [(node, goes_right) for node, goes_right in steps if tree.feature[node] == feature]
                    if all((v > tree.threshold[node]) == goes_right for node, goes_right in own):
                        mean += model.rate * tree.value[end] * fits.get((number, end, feature if own else -1), 0) / max(1, n_rows)
            points.append((feature, float(v), float(mean), n_rows))
    return rows.sparkSession.createDataFrame(points, "feature int, grid double, mean_value double, n_rows long")


def _with_background(df: DataFrame, features: list[str], key_cols: list[str], rows: int | None, background: int, draws: int, seed: int) -> DataFrame:
    """Rows x draws, each next to one background row picked by hash (an equi-join on its number). All that comes of a row stays in one partition."""
    base = _sample(df, key_cols, rows, seed).select("_row", F.struct(*[name(f).alias(f) for f in features]).alias("_x")).repartition("_row")
    back = _sample(df, key_cols, background, seed + 1).select(F.col("_row").alias("_b"), F.struct(*[name(f).alias(f) for f in features]).alias("_z"))
    drawn = base.withColumn("_draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    picked = drawn.withColumn("_b", F.pmod(F.xxhash64("_row", "_draw", F.lit(seed)), F.lit(background)).cast("int"))
    return picked.join(F.broadcast(back), "_b")  # at most ``background`` rows


def contributions(df: DataFrame, score: Scorer, features: list[str], key_cols: list[str], *, max_rows: int | None = None, background: int = 64, draws: int = 4, seed: int = 42) -> DataFrame:
    """(row, feature, phi): sampled Shapley values by switching features one by one in a random order."""
    pairs = _with_background(df, features, key_cols, max_rows, background, draws, seed)
    # Random order of the features per (row, draw): sorted by hash.
    tagged = F.array(*[F.struct(F.xxhash64("_row", "_draw", F.lit(f), F.lit(seed)).alias("h"), F.lit(f).alias("f")) for f in features])
    order = F.sort_array(tagged)["f"]
    steps = pairs.withColumn("_order", order).withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(features)))))
    wide = steps.withColumns({f: F.when(F.array_position("_order", f) <= F.col("_step"), F.col("_x")[f]).otherwise(F.col("_z")[f]) for f in features})
    # One value per step, without ordering the steps; the order of the features follows from the row and the draw once more.
    chain = score(wide).groupBy("_row", "_draw").agg(*[F.max(F.when(F.col("_step") == i, F.col("value"))).alias(f"_v{i}") for i in range(len(features) + 1)])
    moves = F.array(*[F.struct(F.col("_order")[i].alias("feature"), (F.col(f"_v{i + 1}") - F.col(f"_v{i}")).alias("d")) for i in range(len(features))])
    moved = chain.withColumn("_order", order).select("_row", F.explode(moves).alias("_move"))
    return moved.groupBy(F.col("_row").alias("row"), F.col("_move.feature").alias("feature")).agg(F.avg("_move.d").alias("phi"))


def contribution_summary(phi: DataFrame) -> DataFrame:
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi")).orderBy(F.desc("mean_abs_phi"), "feature")


def interaction_strength(df: DataFrame, score: Scorer, features: list[str], key_cols: list[str], *, max_rows: int | None = None, background: int = 64, draws: int = 1,
                         seed: int = 42) -> DataFrame:
    """(a, b, strength): mean absolute second difference of the score over pairs of features.

    The score with no, one or two features switched is the same for all pairs that need it, so it is taken once a row.
    """
    pairs = list(combinations(features, 2))
    base = _with_background(df, features, key_cols, max_rows, background, draws, seed)
    blocks = list(chunks(pairs, PAIRS_AT_ONCE))
    if len(blocks) > 1:
        base = write_through(base, "interactions")
    return reduce(DataFrame.unionByName, [_second_differences(base, score, features, block) for block in blocks]).orderBy(F.desc("strength"), "a", "b")


def _second_differences(base: DataFrame, score: Scorer, features: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """(a, b, strength) of some of the pairs."""
    switched = list(dict.fromkeys([(), *[(f,) for pair in pairs for f in pair], *pairs]))
    wide = base.withColumn("_cell", F.explode(F.sequence(F.lit(0), F.lit(len(switched) - 1)))).withColumns({
        f: F.when(F.col("_cell").isin([i for i, own in enumerate(switched) if f in own]), F.col("_x")[f]).otherwise(F.col("_z")[f]) for f in features})
    held = score(wide).groupBy("_row", "_draw").agg(*[F.max(F.when(F.col("_cell") == i, F.col("value"))).alias(f"_v{i}") for i in range(len(switched))])

    def difference(a: str, b: str) -> Column:
        none, only_b, only_a, both = v = [F.col(f"_v{switched.index(own)}") for own in ((), (b,), (a,), (a, b))]
        known = [F.coalesce(c, F.lit(0.0)) for c in v]
        # A score that is missing counts as nothing, as in a sum.
        return F.when(F.coalesce(none, only_b, only_a, both).isNotNull(), known[0] - known[1] - known[2] + known[3])

    one = held.agg(*[F.avg(F.abs(difference(a, b))).alias(f"_d{i}") for i, (a, b) in enumerate(pairs)], F.count("*").alias("_n"))
    moves = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_d{i}").alias("strength")) for i, (a, b) in enumerate(pairs)])
    return one.where("_n > 0").select(F.explode(moves).alias("_move")).select("_move.a", "_move.b", "_move.strength")

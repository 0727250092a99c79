"""Trained models: preparation, fits of boosted trees, search, ensemble, calibration."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache, reduce

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    PCA, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldtab.functions.columns import name, quoted
from veldtab.functions.hashing import hash_order
from veldtab.functions.jobs import in_parallel
from veldtab.operators import metrics as M
from veldtab.operators import prep as E
from veldtab.operators.boosting import BoostedModel, Boosting, Loss, TreeParams, fit_boosted, fit_rounds, loss_for, no_better_for, with_slots
from veldtab.operators.profiling import PROBABILITY_METRICS, FeatureRoles
from veldtab.operators.splits import fold_count, most_recent, search_rows, stratified_folds, stratified_sample, time_blocks
from veldtab.operators.thresholds import ThresholdPolicy, tune_threshold
from veldtab.sources.storage import write_through

FEATURES = "features"
#: What a fit raises on data it cannot use; anything else is a fault and is not caught.
FIT_ERRORS = (PySparkException, Py4JJavaError)
SEED = 42
#: Rows of one task of a ``pyspark.ml`` fit.
ROWS_PER_TASK = 250_000
#: Nodes up to which trees of ``pyspark.ml`` are written as one column expression.
EXPRESSION_NODES = 600


# -- preparation ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class PrepOptions:
    robust_cols: tuple[str, ...] = ()
    power: bool = False
    pca_threshold: int = 10
    pca_variance: float = 0.95
    pca_components: int | None = None


@dataclass(frozen=True)
class Preparation:
    """Fitted feature preparation: optional target encoding, then a savable ML pipeline."""

    pipeline: PipelineModel
    encoder: E.TargetEncoder | None = None
    fill: E.Imputer = E.Imputer({})

    @property
    def slots(self) -> list[str] | None:
        """The columns of a prepared table whose numbers are the slots of its vectors one by one; None where a block of the vector is a vector itself."""
        kinds = [type(s) for s in self.pipeline.stages]
        return list(self.pipeline.stages[-1].getInputCols()) if kinds == [SQLTransformer, VectorAssembler] else None

    def transform(self, df: DataFrame) -> DataFrame:
        """Prepare rows that the encoder was not fitted on."""
        return self.pipeline.transform(self.encoder.transform(self.fill.transform(df)) if self.encoder else df)

    def transform_train(self, train: DataFrame, target: str, key_cols: list[str], *, folds: int = 5, seed: int = SEED) -> DataFrame:
        """Prepare the training rows: each is encoded with the targets of the other folds only, so its own target does not leak."""
        if not self.encoder:
            return self.pipeline.transform(train)
        out = self.fill.transform(train).withColumn("_fold", hash_order(seed, key_cols) % folds)
        for c in self.encoder.cols:
            out = E.cross_fit_encoding(out, c, target, "_fold", "_encoded").withColumn(c, F.col("_encoded")).drop("_encoded")
        return self.pipeline.transform(out.drop("_fold"))


def sql_projection(expressions: dict[str, str]) -> SQLTransformer:
    """All columns plus new ones, as a stage that is stored with the pipeline."""
    listed = ", ".join(f"{e} AS {quoted(c)}" for c, e in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")


def fit_preparation(train: DataFrame, roles: FeatureRoles, target: str, options: PrepOptions = PrepOptions()) -> Preparation:
    """Fit on the training rows: medians, scaling, power, PCA, one-hot and target encoding.

    One pass for all numeric columns, one for all categories; the stages hold literals only.
    """
    numeric, hot, te = list(roles.numeric), list(roles.one_hot), list(roles.target_encoded)
    robust = [c for c in numeric if c in options.robust_cols]
    plain = [c for c in numeric if c not in robust]
    medians = E.fit_median_imputer(train, numeric) if numeric else E.Imputer({})
    scaler = E.fit_robust_scaler(train, robust) if robust else None
    expressions = {f"n_{c}": medians.sql(c) for c in plain}
    expressions.update({f"n_{c}": scaler.sql(c, medians.sql(c)) for c in robust})
    if options.power and plain:
        filled = train.select(*[F.expr(medians.sql(c)).cast("double").alias(c) for c in plain])
        power = E.fit_power_transform(filled, plain)
        expressions.update({f"n_{c}": power.sql(c, medians.sql(c)) for c in plain})
    modes = E.fit_mode_imputer(train, hot + te) if hot + te else E.Imputer({})
    expressions.update({f"c_{c}": f"cast({modes.sql(c)} as string)" for c in hot})

    encoder, fill = None, E.Imputer({c: v for c, v in modes.values.items() if c in te})
    if te:
        encoder = E.fit_target_encoder(fill.transform(train), te, target)
        expressions.update({f"t_{c}": f"cast({quoted(c)} as double)" for c in te})
    stages = [sql_projection(expressions)]
    blocks = [f"n_{c}" for c in robust] + [f"t_{c}" for c in te]
    numeric_plain = [f"n_{c}" for c in plain]
    if len(plain) > options.pca_threshold:
        stages += [VectorAssembler(inputCols=numeric_plain, outputCol="_plain", handleInvalid="keep"),
                   StandardScaler(inputCol="_plain", outputCol="_centred", withMean=True, withStd=False),
                   PCA(k=len(plain), inputCol="_centred", outputCol="_components")]
        blocks.append("_pca")
    else:
        blocks = numeric_plain + blocks
    if hot:
        # The unknown slot is the last index and dropped, so an unseen category is all zeros.
        stages += [StringIndexer(inputCols=[f"c_{c}" for c in hot], outputCols=[f"i_{c}" for c in hot],
                                 handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=[f"i_{c}" for c in hot], outputCols=[f"h_{c}" for c in hot], dropLast=True, handleInvalid="keep")]
        blocks += [f"h_{c}" for c in hot]

    base = train
    if encoder:
        base = encoder.transform(fill.transform(train))
    fitted = Pipeline(stages=stages).fit(base)
    final = list(fitted.stages)
    if "_pca" in blocks:
        pca = next(s for s in final if hasattr(s, "explainedVariance"))
        final.append(VectorSlicer(inputCol="_components", outputCol="_pca", indices=list(range(components_kept(
            pca.explainedVariance.toArray().tolist(), options.pca_variance, options.pca_components)))))
    final.append(VectorAssembler(inputCols=blocks, outputCol=FEATURES, handleInvalid="keep"))
    return Preparation(PipelineModel(final), encoder, fill)


def components_kept(explained: list[float], variance: float, fixed: int | None = None) -> int:
    if fixed:
        return min(fixed, len(explained))
    total = 0.0
    for i, share in enumerate(explained, 1):
        total += share
        if total >= variance:
            return i
    return len(explained)


def feature_names(prepared: DataFrame) -> list[str]:
    """Names of the vector's slots, from the column metadata."""
    attrs = prepared.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])
    return [a.get("name", f"f{a['idx']}") for a in slots]


# -- fits ----------------------------------------------------------------------------------------

def fit_trees(train: DataFrame, task: str, params: TreeParams = TreeParams(), *, label: str = "y", weight: str | None = None, n_classes: int = 2,
              key_cols: list[str] = (), **options) -> BoostedModel:
    """Second-order trees with leaf penalties; more than two classes share their gradients by softmax."""
    return fit_boosted(train, loss_for(task, n_classes), params, label=label, weight=weight, key_cols=key_cols, features=FEATURES, **options)


def tree_estimator(task: str, params: TreeParams = TreeParams(), *, label: str = "y", weight: str | None = None,
                   validation: str | None = None, tolerance: float = 0.01, seed: int = SEED):
    """Trees of ``pyspark.ml``, which know no leaf penalties."""
    cls = GBTClassifier if task == "classification" else GBTRegressor
    est = cls(featuresCol=FEATURES, labelCol=label, maxIter=params.n_estimators, maxDepth=params.max_depth,
              stepSize=params.learning_rate, subsamplingRate=params.subsample, minInstancesPerNode=max(1, int(params.min_child_weight)),
              featureSubsetStrategy="all" if params.colsample >= 1 else str(params.colsample), seed=seed,
              maxMemoryInMB=512, cacheNodeIds=False, validationTol=tolerance)
    if weight:
        est = est.setWeightCol(weight)
    return est.setValidationIndicatorCol(validation) if validation else est


def fit_spread(estimator, train: DataFrame):
    """Fit a ``pyspark.ml`` estimator on ``spread`` rows."""
    used = {estimator.getFeaturesCol(), estimator.getLabelCol()} | {estimator.getOrDefault(p) for p in ("weightCol", "validationIndicatorCol")
                                                                  if estimator.hasParam(p) and estimator.isDefined(p) and estimator.getOrDefault(p)}
    return estimator.fit(spread(train, used))


def spread(df: DataFrame, used, n_rows: int | None = None) -> DataFrame:
    """The used columns in partitions of at most about ``ROWS_PER_TASK`` rows: files hold vectors far smaller than a fit does in memory, so that
    the parts they are read in would grow with the table. Tables that the session's tasks share out in smaller parts are left as they are."""
    wanted = math.ceil((df.count() if n_rows is None else n_rows) / ROWS_PER_TASK)
    if wanted <= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return exchanged_once(df.select(*[name(c) for c in df.columns if c in used]).repartition(wanted))


def exchanged_once(df: DataFrame) -> DataFrame:
    """The same rows as a table over the result of one run of the plan's exchanges: each job of a ``pyspark.ml`` fit would plan and run them anew.
    What is exchanged is kept as shuffle files, which a lost task has made again."""
    plan = df._jdf.queryExecution()
    return DataFrame(df._jdf.sparkSession().internalCreateDataFrame(plan.toRdd(), df._jdf.schema(), False), df.sparkSession)


@dataclass(frozen=True)
class ClassModels:
    """One tree ensemble per class; probabilities are normalised over the classes."""

    models: tuple = ()

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for k, model in enumerate(self.models):
            scored = model.transform(out)
            out = (scored.withColumn(f"_p{k}", vector_to_array("probability")[1])
                   .drop("rawPrediction", "probability", "prediction"))
        total = reduce(Column.__add__, [F.col(f"_p{k}") for k in range(len(self.models))])
        probs = F.array(*[F.col(f"_p{k}") / total for k in range(len(self.models))])
        out = out.withColumn("probs", probs)
        pred = F.array_position("probs", F.array_max("probs")).cast("int") - 1
        return out.withColumn("pred", pred).drop(*[f"_p{k}" for k in range(len(self.models))])


def fit_multiclass(train: DataFrame, n_classes: int, params: TreeParams = TreeParams(), *, label: str = "y", **options) -> BoostedModel:
    """One tree per class and round, from the gradients of one softmax loss."""
    return fit_boosted(train, Loss("softmax", n_classes), params, label=label, features=FEATURES, **options)


def fit_one_vs_rest(train: DataFrame, n_classes: int, params: TreeParams = TreeParams(), *, label: str = "y") -> ClassModels:
    """The classes are fitted at the same time from one cached table."""
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)

    def fit_one(k: int):
        marked = cached.withColumn("_is", (name(label) == k).cast("double"))
        return fit_spread(tree_estimator("classification", params, label="_is"), marked)

    try:
        return ClassModels(tuple(in_parallel(fit_one, range(n_classes), min(4, n_classes))))
    finally:
        cached.unpersist()


def margin_sql(model, x: str) -> str | None:
    """The weighted sum of the trees of ``pyspark.ml`` as SQL over the columns ``x``0, ``x``1, .. of the slots of a vector; None for other models, for
    more than ``EXPRESSION_NODES`` nodes and for cuts by categories."""
    if not isinstance(model, (GBTClassificationModel, GBTRegressionModel)) or model.totalNumNodes > EXPRESSION_NODES:
        return None

    def of(node, weight: float) -> str:
        if node.getClass().getSimpleName() == "LeafNode":
            return E.number(weight * node.prediction())
        cut = node.split()
        if cut.getClass().getSimpleName() != "ContinuousSplit":
            raise LookupError
        return (f"case when {x}{cut.featureIndex()} <= {E.number(cut.threshold())} then {of(node.leftChild(), weight)} "
                f"else {of(node.rightChild(), weight)} end")

    try:
        return " + ".join(f"({of(tree._java_obj.rootNode(), float(w))})" for tree, w in zip(model.trees, model.treeWeights))
    except LookupError:
        return None


def _by_margin(sql: str, df: DataFrame, features: str, task: str, slots: list[str] | None) -> DataFrame:
    used = {int(i) for i in re.findall(r"_x(\d+) <=", sql)}
    x = [name(c).cast("double") for c in slots] if slots else vector_to_array(features)
    out = with_slots(df, x, used, lambda v: F.coalesce(v, F.lit(float("nan"))), {"yhat": sql})
    if task == "regression":
        return out
    # A quotient counts as one that may be null, and a test for null would make the optimizer compute all trees once more.
    low = out.withColumn("_low", F.coalesce(1 / (1 + F.exp(2 * F.col("yhat"))), F.lit(float("nan")))).drop("yhat")
    return low.withColumn("probs", F.array("_low", 1 - F.col("_low"))).drop("_low")


def scored(model, df: DataFrame, task: str, slots: list[str] | None = None) -> DataFrame:
    """Scored rows in one shape: probs, p, pred for classes, yhat for values. Small models of ``pyspark.ml`` trees are column expressions,
    which cost a fraction of their ``transform``; they take the numbers from the ``slots``, where columns hold them, so that no vector is made."""
    if isinstance(model, (ClassModels, BoostedModel)):
        return model.transform(df)
    sql = margin_sql(model, "_x")
    if sql:
        out = _by_margin(sql, df, model.getFeaturesCol(), task, slots)
        return out if task == "regression" else out.withColumn("p", F.col("probs")[1]).withColumn("pred", (F.col("p") >= 0.5).cast("int"))
    out = model.transform(df)
    if task == "regression":
        return out.withColumnRenamed("prediction", "yhat")
    out = out.withColumn("probs", vector_to_array("probability")).drop("rawPrediction", "probability", "prediction")
    return out.withColumn("p", F.col("probs")[1]).withColumn("pred", (F.col("p") >= 0.5).cast("int"))


@dataclass(frozen=True)
class EarlyStopped:
    model: object
    best_iteration: int
    rounds: list = field(default_factory=list)


def fit_early_stopped(train: DataFrame, val: DataFrame, task: str, params: TreeParams = TreeParams(), *, label: str = "y",
                      weight: str | None = None, patience: int = 30, n_classes: int = 2, key_cols: list[str] = ()) -> EarlyStopped:
    """Stop after ``patience`` rounds without a better validation loss; the model ends at the best round, ``rounds`` has all that were fitted."""
    model = fit_trees(train, task, params, label=label, weight=weight, n_classes=n_classes, key_cols=key_cols, validation=val, patience=patience)
    return EarlyStopped(model, model.getNumTrees, list(model.losses))


def round_log(stopped: EarlyStopped, df: DataFrame) -> DataFrame:
    rows = [(i + 1, a, b) for i, (a, b) in enumerate(stopped.rounds)]
    return df.sparkSession.createDataFrame(rows, "round int, train_loss double, val_loss double")


def fit_final(df: DataFrame, task: str, params: TreeParams, best_n: int, *, split: str = "split", label: str = "y", weight: str | None = None, **options):
    """Fit on train and val together with the tuned number of trees."""
    return fit_trees(df.where(F.col(split).isin("train", "val")), task, params.replaced(n_estimators=max(1, int(best_n))), label=label, weight=weight, **options)


# -- search --------------------------------------------------------------------------------------

# Search ranges (low, high, step or None, log scale).
NARROW = {"max_depth": (3, 7, 1, False), "learning_rate": (0.01, 0.2, None, True), "subsample": (0.6, 1.0, None, False),
          "colsample": (0.6, 1.0, None, False), "min_child_weight": (1, 5, 1, False), "l1": (1e-4, 1.0, None, True), "l2": (0.1, 5.0, None, True)}
WIDE = {"max_depth": (3, 10, 1, False), "learning_rate": (0.001, 0.3, None, True), "subsample": (0.5, 1.0, None, False),
        "colsample": (0.4, 1.0, None, False), "min_child_weight": (1, 10, 1, False), "l1": (1e-5, 10.0, None, True), "l2": (1e-2, 10.0, None, True)}


def draw_params(n_trials: int, *, wide: bool = False, n_estimators: tuple[int, int] = (100, 500), seed: int = SEED) -> list[TreeParams]:
    rng, space, out = random.Random(seed), (WIDE if wide else NARROW), []
    for _ in range(n_trials):
        picked = {}
        for key, (lo, hi, step, log_scale) in space.items():
            if step:
                picked[key] = rng.randrange(lo, hi + 1, step)
            elif log_scale:
                picked[key] = round(math.exp(rng.uniform(math.log(lo), math.log(hi))), 5)
            else:
                picked[key] = round(rng.uniform(lo, hi), 5)
        out.append(TreeParams(n_estimators=rng.randint(*n_estimators), **picked))
    return out


def score_model(model, df: DataFrame, task: str, metric: str, label: str = "y") -> float:
    """Exact metric of a model on a prepared table, higher is better."""
    rows = scored(model, df, task)
    # Written, so that the passes of a metric do not score the rows anew.
    rows = write_through(rows.select(name(label), *[c for c in ("probs", "pred", "p", "yhat") if c in rows.columns]), "scored")
    cols = dict(y=label, yhat="yhat") if task == "regression" else dict(y=label)
    binary = not isinstance(model, ClassModels) and not (isinstance(model, BoostedModel) and model.loss.outputs > 1)
    if not binary and metric in PROBABILITY_METRICS and metric not in ("log_loss", "cross_entropy"):
        raise ValueError(f"{metric} needs a binary target")
    return float(M.score(rows, metric, probs=None if binary else "probs", **cols).first()["value"])


TRIAL_SCHEMA = ("trial int, n_estimators int, max_depth int, learning_rate double, subsample double, colsample double, "
                "min_child_weight int, l1 double, l2 double, score double, state string")


def search(prepared: DataFrame, task: str, metric: str, class_col: str | None, key_cols: list[str], *, n_trials: int = 30, wide: bool = False,
           n_estimators: tuple[int, int] = (100, 500), folds: int = 5, validation: DataFrame | None = None, fraction: float = 0.6,
           label: str = "y", parallelism: int = 4, seed: int = SEED, strategy: str = "cv", max_rows: int | None = None, time_col: str | None = None, n_classes: int = 2) -> DataFrame:
    """Trial table: ``fraction`` of the rows (at most ``max_rows``) in folds (``cv``), folds in order of time (``time``), or one fit against ``validation`` (``holdout``).

    Folds are reduced to what the smallest class allows. Folds in time validate on block i what was fitted on the blocks before it; where ``max_rows`` is
    given they work on the newest rows. The prepared vectors are cached once, and the rows of each fit are cut into bins once for all trials; trials differ only in the estimator. A trial whose fit fails is
    a row with state 'failed'; a search without any complete trial raises.
    """
    if strategy not in ("cv", "time", "holdout"):
        raise ValueError(f"unknown strategy: {strategy}")
    if strategy == "holdout" and validation is None:
        raise ValueError("holdout needs validation rows")
    work, fold, use_cv = prepared, "fold", strategy != "holdout"
    if strategy == "cv":
        if class_col:
            folds = fold_count(prepared, class_col, folds)
            work = stratified_sample(prepared, class_col, key_cols, search_rows(prepared.count(), fraction, max_rows), seed=seed)
        if folds < 2:
            raise ValueError("cross-validation needs two rows of every class and two folds")
        work = stratified_folds(work, class_col, key_cols, folds, seed=seed)
    elif strategy == "time":
        work, fold = time_blocks(most_recent(prepared, time_col, max_rows, key_cols) if max_rows else prepared, time_col, folds), "block"
    work = work.persist(StorageLevel.MEMORY_AND_DISK)

    earlier = (lambda f: F.col(fold) < f) if strategy == "time" else (lambda f: F.col(fold) != f)
    held = (range(1, folds + 1) if strategy == "time" else range(folds)) if use_cv else (None,)

    def start(f: int | None) -> Boosting | Exception:
        try:
            return Boosting(work if f is None else work.where(earlier(f)), loss_for(task, n_classes), TreeParams(), label=label, features=FEATURES, key_cols=key_cols, seed=seed)
        except FIT_ERRORS as exc:  # of every trial
            return exc

    def fit(f: int | None, params: TreeParams) -> BoostedModel:
        if isinstance(starts[f], Exception):
            raise starts[f]
        return fit_rounds(starts[f].afresh(params))

    def run(item):
        i, params = item
        try:
            if use_cv:
                scores = [score_model(fit(f, params),
                                      work.where(F.col(fold) == f), task, metric, label) for f in held]
                score = sum(scores) / len(scores)
            else:
                score = score_model(fit(None, params), validation, task, metric, label)
            return (*_trial(i, params), score, "complete")
        except FIT_ERRORS as exc:  # a failed fit is recorded, the search goes on
            return (*_trial(i, params), None, f"failed: {type(exc).__name__}")

    try:
        starts = dict(zip(held, in_parallel(start, held, parallelism)))
        rows = in_parallel(run, list(enumerate(draw_params(n_trials, wide=wide, n_estimators=n_estimators, seed=seed))), parallelism)
    finally:
        work.unpersist()
    if not any(r[-1] == "complete" for r in rows):
        raise RuntimeError(f"no trial was completed: {rows[0][-1] if rows else 'no trials'}")
    return prepared.sparkSession.createDataFrame(rows, TRIAL_SCHEMA)


def _trial(i: int, p: TreeParams) -> tuple:
    return i, p.n_estimators, p.max_depth, float(p.learning_rate), float(p.subsample), float(p.colsample), int(p.min_child_weight), float(p.l1), float(p.l2)


def trial_params(row) -> TreeParams:
    return TreeParams(*[row[k] for k in ("n_estimators", "max_depth", "learning_rate", "subsample", "colsample", "min_child_weight", "l1", "l2")])


def best_trials(trials: DataFrame, k: int = 1) -> list:
    return trials.where("score is not null").orderBy(F.desc("score"), "trial").limit(k).collect()


def tree_count_by_folds(prepared: DataFrame, task: str, params: TreeParams, class_col: str | None, key_cols: list[str], *, folds: int = 3,
                        label: str = "y", parallelism: int = 4, seed: int = SEED, patience: int = 20, n_classes: int = 2) -> tuple[int, DataFrame]:
    """Mean held-out loss per boosting round over the folds, round by round until ``patience`` rounds have not bettered it; the best round is the tree count."""
    work = stratified_folds(prepared, class_col, key_cols, folds, seed=seed).persist(StorageLevel.MEMORY_AND_DISK)
    options = dict(label=label, features=FEATURES, key_cols=key_cols, seed=seed)

    def further(fit: Boosting) -> None:
        fit.step()
        fit.measure()

    try:
        fits = in_parallel(lambda f: Boosting(work.where(F.col("fold") != f), loss_for(task, n_classes), params, validation=work.where(F.col("fold") == f), **options),
                           range(folds), parallelism)
        mean: list[float] = []
        while len(mean) < params.n_estimators and not no_better_for(mean, patience):
            in_parallel(further, fits, parallelism)
            mean.append(sum(fit.held_losses[-1] for fit in fits) / folds)
    finally:
        work.unpersist()
    table = prepared.sparkSession.createDataFrame([(i + 1, m) for i, m in enumerate(mean)], "round int, mean_loss double")
    return min(range(len(mean)), key=lambda i: mean[i]) + 1, table


def fit_quantiles(train: DataFrame, params: TreeParams = TreeParams(), *, label: str = "y", quantiles: tuple[float, ...] = (0.05, 0.95), **options) -> list[BoostedModel]:
    """One model per quantile, by pinball loss with leaves at the exact quantile of their residuals."""
    return in_parallel(lambda q: fit_boosted(train, Loss("pinball", quantile=q), params, label=label, features=FEATURES, **options), quantiles, len(quantiles))


# -- baselines -----------------------------------------------------------------------------------

def evaluate_baselines(train: DataFrame, test: DataFrame, task: str, metric: str, *, label: str = "y", logged: bool = False,
                       policy: ThresholdPolicy = ThresholdPolicy(), trees: TreeParams = TreeParams(50, 3, 0.08, 1.0, 1.0, 1)) -> DataFrame:
    """(model, metric, value, status) of the simple models; a failed fit is a row, not a stop."""
    spark = train.sparkSession
    parts: list[DataFrame] = []

    def add(label_: str, rows: DataFrame) -> None:
        parts.append(rows.select(F.lit(label_).alias("model"), "metric", "value", F.lit("ok").alias("status")))

    def attempt(label_: str, fn: Callable[[], DataFrame]) -> None:
        try:
            add(label_, fn())
        except FIT_ERRORS as exc:
            parts.append(spark.createDataFrame([(label_, None, None, f"failed: {type(exc).__name__}")],
                                               "model string, metric string, value double, status string"))

    def class_rows(rows: DataFrame) -> DataFrame:
        # Written, so that the threshold and each metric do not score the rows anew.
        rows = write_through(rows.select(name(label), "p"), "scored")
        best = tune_threshold(rows, policy, metric, y=label).first()["threshold"]
        cut = rows.withColumn("pred", (F.col("p") >= best).cast("int"))
        suite = M.classification_suite(cut, y=label)
        return suite.unionByName(spark.createDataFrame([("threshold", float(best))], "metric string, value double"))

    # Exchanged once for all fits.
    rows_to_fit = cache(lambda: spread(train, {FEATURES, label}))
    if task == "classification":
        def majority() -> DataFrame:
            shares = train.agg(F.mode(label, True).alias("m")).first()["m"]
            return M.classification_suite(test.withColumns({"p": F.lit(float(shares)), "pred": F.lit(int(shares))}), y=label)
        attempt("majority", majority)
        attempt("logistic", lambda: class_rows(scored(LogisticRegression(featuresCol=FEATURES, labelCol=label, weightCol="weight").fit(
            E.balanced_weights(rows_to_fit(), label)), test, task)))
        attempt("default_trees", lambda: class_rows(scored(tree_estimator(task, trees, label=label).fit(rows_to_fit()), test, task)))
    else:
        rows = lambda df: M.metric_rows(M.regression_metrics(df, label, "yhat", logged=logged))
        attempt("mean", lambda: rows(test.withColumn("yhat", F.lit(float(train.agg(F.avg(label)).first()[0])))))
        attempt("ridge", lambda: rows(scored(LinearRegression(featuresCol=FEATURES, labelCol=label, regParam=1.0).fit(rows_to_fit()), test, task)))
        attempt("default_trees", lambda: rows(scored(tree_estimator(task, trees, label=label).fit(rows_to_fit()), test, task)))
    return reduce(DataFrame.unionByName, parts)


# -- ensemble and calibration --------------------------------------------------------------------

def average_probabilities(arrays: list[Column]) -> Column:
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), arrays)
    return F.transform(total, lambda x: x / len(arrays))


def fit_ensemble(train: DataFrame, trials: DataFrame, task: str, top_k: int = 3, *, label: str = "y", parallelism: int = 3, n_classes: int = 2, patience: int | None = None, **options) -> list:
    """Models of the best trials, from rows cut into bins once; fewer than two complete trials give an empty ensemble."""
    chosen = best_trials(trials, top_k)
    if len(chosen) < 2:
        return []
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        start = Boosting(cached, loss_for(task, n_classes), TreeParams(), label=label, features=FEATURES, **options)
        return in_parallel(lambda row: fit_rounds(start.afresh(trial_params(row)), patience), chosen, parallelism)
    finally:
        cached.unpersist()


def ensemble_scores(models: list, df: DataFrame, task: str) -> DataFrame:
    """Soft vote (or mean): members score the same rows one after the other, no joins."""
    out = df
    for i, model in enumerate(models):
        value = "probs" if task == "classification" else "yhat"
        out = scored(model, out, task).withColumnRenamed(value, f"_m{i}").drop("p", "pred")
    members = [F.col(f"_m{i}") for i in range(len(models))]
    if task == "classification":
        out = out.withColumn("probs", average_probabilities(members))
        out = out.withColumns({"p": F.when(F.size("probs") == 2, F.col("probs")[1]), "pred": F.array_position("probs", F.array_max("probs")).cast("int") - 1})
    else:
        out = out.withColumn("yhat", reduce(Column.__add__, members) / len(members))
    return out.drop(*[f"_m{i}" for i in range(len(models))])


@dataclass(frozen=True)
class SigmoidCalibration:
    slope: float
    intercept: float

    def transform(self, df: DataFrame, p: str = "p", out: str = "p_calibrated") -> DataFrame:
        return df.withColumn(out, 1 / (1 + F.exp(-(self.slope * _logit(name(p)) + self.intercept))))


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-12)), F.lit(1 - 1e-12))
    return F.log(inside / (1 - inside))


def fit_calibration(val: DataFrame, y: str = "y", p: str = "p") -> SigmoidCalibration:
    """Logistic regression of the label on the score's log-odds."""
    rows = val.select(name(y).cast("double").alias("label"), _logit(name(p)).alias("_x"))
    vectors = VectorAssembler(inputCols=["_x"], outputCol=FEATURES).transform(rows)
    fitted = fit_spread(LogisticRegression(featuresCol=FEATURES, labelCol="label"), vectors)
    return SigmoidCalibration(float(fitted.coefficients[0]), float(fitted.intercept))


# -- recursive elimination -----------------------------------------------------------------------

def select_features(prepared: DataFrame, task: str, metric: str, class_col: str | None, key_cols: list[str], *, min_features: int = 3,
                    folds: int = 3, params: TreeParams = TreeParams(20, 3, 0.1, 1.0, 1.0, 1), label: str = "y", step: int = 1) -> tuple[list[int], DataFrame]:
    """Recursive elimination: per size the mean fold score; the weakest slot goes each time.

    Returns the slots of the best size and the (n_features, mean_score) table. Under five slots
    nothing is removed.
    """
    width = len(prepared.select(FEATURES).first()[0])
    slots = list(range(width))
    spark = prepared.sparkSession
    if width < 5:
        return slots, spark.createDataFrame([(width, None)], "n_features int, mean_score double")
    folded = stratified_folds(prepared, class_col, key_cols, folds).select(name(label), FEATURES, "fold")
    work = spread(folded, set(folded.columns), prepared.count())
    if work is folded:
        work = folded.persist(StorageLevel.MEMORY_AND_DISK)
    history: list[tuple[list[int], float]] = []
    try:
        while True:
            part = work
            if len(slots) < width:
                part = VectorSlicer(inputCol=FEATURES, outputCol="_slice", indices=slots).transform(work).drop(FEATURES).withColumnRenamed("_slice", FEATURES)

            def run(f: int):
                model = tree_estimator(task, params, label=label).fit(part.where(F.col("fold") != f))
                return score_model(model, part.where(F.col("fold") == f), task, metric, label), model.featureImportances.toArray()

            results = in_parallel(run, range(folds), folds)
            history.append((slots, sum(s for s, _ in results) / folds))
            if len(slots) <= min_features:
                break
            weight = sum(w for _, w in results)
            gone = set(sorted(range(len(slots)), key=lambda i: (weight[i], -i))[:min(step, len(slots) - min_features)])
            slots = [s for i, s in enumerate(slots) if i not in gone]
    finally:
        work.unpersist()
    best = max(history, key=lambda h: (h[1], -len(h[0])))
    return best[0], spark.createDataFrame([(len(s), v) for s, v in history], "n_features int, mean_score double")


def importances(model, prepared: DataFrame, top: int | None = None) -> DataFrame:
    """(feature, importance), strongest first."""
    values = model.featureImportances.toArray()
    names = feature_names(prepared) or [f"f{i}" for i in range(len(values))]
    rows = sorted(zip(names, [float(v) for v in values]), key=lambda x: (-x[1], x[0]))[:top]
    return prepared.sparkSession.createDataFrame(rows, "feature string, importance double")

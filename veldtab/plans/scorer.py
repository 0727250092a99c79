"""A fitted scorer as one artifact: preparation, encodings, model, spec and known categories, saved and loaded together."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession

from veldtab.operators.boosting import BoostedModel
from veldtab.operators.models import ClassModels, Preparation, SigmoidCalibration
from veldtab.operators.prep import Imputer, TargetEncoder
from veldtab.operators.scoring import ScoringSpec, check_input, envelope, predict, unseen_report

KINDS = {c.__name__: c for c in (GBTClassificationModel, GBTRegressionModel, BoostedModel)}


@dataclass(frozen=True)
class Scorer:
    """All that is needed to score rows like the training run did."""

    preparation: Preparation
    model: object
    spec: ScoringSpec
    known: DataFrame | None = None
    calibration: SigmoidCalibration | None = None

    def score(self, df: DataFrame, keep: list[str] = ()) -> tuple[DataFrame, list[str]]:
        """Checked and scored rows, and the warnings of the check; streams are scored alike."""
        rows, warnings = check_input(df, self.spec, list(keep), refuse_empty=not df.isStreaming)
        out = predict(rows, self.preparation, self.model, self.spec)
        return (self.calibration.transform(out) if self.calibration and "p" in out.columns else out), warnings

    def unseen(self, df: DataFrame, cols: list[str]) -> DataFrame:
        return unseen_report(df, self.known, cols)

    def respond(self, df: DataFrame, order: str, request: str | None = None) -> DataFrame:
        rows, warnings = self.score(df, [c for c in (order, request) if c])
        return envelope(rows, self.spec, warnings, order, request)


def save_scorer(scorer: Scorer, path: str) -> str:
    spark = SparkSession.active()
    prep, models = scorer.preparation, scorer.model.models if isinstance(scorer.model, ClassModels) else (scorer.model,)
    prep.pipeline.write().overwrite().save(f"{path}/pipeline")
    for i, model in enumerate(models):
        if isinstance(model, BoostedModel):
            model.save(f"{path}/model_{i}")
        else:
            model.write().overwrite().save(f"{path}/model_{i}")
    if prep.encoder:
        prep.encoder.table.write.mode("overwrite").parquet(f"{path}/encoding")
    if scorer.known is not None:
        scorer.known.write.mode("overwrite").parquet(f"{path}/known")
    about = {
        "spec": asdict(scorer.spec), "fill": prep.fill.values, "kinds": [type(m).__name__ for m in models], "per_class": isinstance(scorer.model, ClassModels),
        "encoder": {"overall": prep.encoder.overall, "cols": prep.encoder.cols, "n_categories": prep.encoder.n_categories} if prep.encoder else None,
        "known": scorer.known is not None, "calibration": asdict(scorer.calibration) if scorer.calibration else None}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return path


def load_scorer(path: str) -> Scorer:
    spark = SparkSession.active()
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    encoder = None
    if e := about["encoder"]:
        encoder = TargetEncoder(spark.read.parquet(f"{path}/encoding"), e["overall"], tuple(e["cols"]), e["n_categories"])
    models = tuple(KINDS[kind].load(f"{path}/model_{i}") for i, kind in enumerate(about["kinds"]))
    spec = {k: tuple(v) if isinstance(v, list) else v for k, v in about["spec"].items()}
    return Scorer(Preparation(PipelineModel.load(f"{path}/pipeline"), encoder, Imputer(about["fill"])), ClassModels(models) if about["per_class"] else models[0],
                  ScoringSpec(**spec), spark.read.parquet(f"{path}/known") if about["known"] else None,
                  SigmoidCalibration(**about["calibration"]) if about["calibration"] else None)

"""Saving and loading fitted pipelines and per-label models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    GBTClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    NaiveBayesModel,
    RandomForestClassificationModel,
)
from pyspark.sql import SparkSession

from toxiscope.session import path_exists

MODEL_CLASSES = {
    "nb": NaiveBayesModel,
    "lr": LogisticRegressionModel,
    "svm": LinearSVCModel,
    "mlp": MultilayerPerceptronClassificationModel,
    "dt": DecisionTreeClassificationModel,
    "rf": RandomForestClassificationModel,
    "gbt": GBTClassificationModel,
}


def save_model(model, path: str, overwrite: bool = True) -> None:
    w = model.write()
    (w.overwrite() if overwrite else w).save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def label_model_path(base: str, kind: str, label: str) -> str:
    return f"{base.rstrip('/')}/{kind}_{label}"


def features_path(base: str, feature_kind: str) -> str:
    """Folder of the fitted feature chain; every label of a model folder shares it."""
    return f"{base.rstrip('/')}/features_{feature_kind}"


def load_features(spark: SparkSession, base: str, feature_kind: str) -> PipelineModel | None:
    """The folder's fitted feature chain of this kind, if it has one."""
    path = features_path(base, feature_kind)
    return load_pipeline(path) if path_exists(spark, path) else None


def save_label_models(models: dict, base: str, kind: str) -> None:
    """Save every fitted model; a label without one (a single class) leaves no folder."""
    for label, m in models.items():
        if m is not None:
            save_model(m, label_model_path(base, kind, label))


def load_label_models(base: str, kind: str, labels: list[str]) -> dict:
    """``{label: model}``; the reference loads six networks the same way. A label without a
    saved model gets None and is scored as NULL."""
    cls, spark = MODEL_CLASSES[kind], SparkSession.active()
    paths = {label: label_model_path(base, kind, label) for label in labels}
    found = {label: cls.load(p) if path_exists(spark, p) else None for label, p in paths.items()}
    if not any(found.values()):
        raise ValueError(f"{base} has no {kind} model of {labels}")
    return found

"""Prediction and multi-label scoring."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxiscope.operators.calibration import calibrate
from toxiscope.session import cut_lineage


def predict(model, df: DataFrame) -> DataFrame:
    """M7: the fitted model's ``transform`` (lazy; coefficients shipped with the tasks)."""
    return model.transform(df)


def score_labels(
    features: DataFrame, models: dict, key: str, features_col: str = "features", calibrations: dict | None = None
) -> DataFrame:
    """Apply one fitted model per label in one wide plan, then unpivot.

    Every model writes its own prediction / probability / raw columns, so the
    features are computed once per row and no result goes through the driver.
    Output: ``key, label, prediction int, probability double`` (NULL for models
    without probabilities, e.g. LinearSVC; both are NULL for a label without a model).
    ``calibrations`` gives labels the blocks of :func:`calibration.fit_calibration` over their
    models' margins; their probabilities come from these (not on streams).
    """
    calibrations = calibrations or {}
    df = features
    names = list(models)
    for i, label in enumerate(names):
        if models[label] is None:
            df = df.withColumn(f"_pred{i}", F.lit(None).cast("double"))
            continue
        m = models[label].copy()
        m.setFeaturesCol(features_col)
        m.setPredictionCol(f"_pred{i}")
        if m.hasParam("rawPredictionCol"):
            m.setRawPredictionCol(f"_raw{i}")
        if m.hasParam("probabilityCol"):
            m.setProbabilityCol(f"_prob{i}")
        df = m.transform(df)
    cols = []
    for i, label in enumerate(names):
        prob = (
            vector_to_array(F.col(f"_prob{i}"))[1]
            if f"_prob{i}" in df.columns
            else F.lit(None).cast("double")
        )
        raw = F.lit(None).cast("double")
        if label in calibrations and models[label] is not None:
            raw = vector_to_array(F.col(f"_raw{i}"))[1]
        cols += [F.lit(label), F.col(f"_pred{i}").cast("int"), prob, raw]
    parts = ", ".join(f"c{j}" for j in range(len(cols)))
    wide = df.select(key, *[c.alias(f"c{j}") for j, c in enumerate(cols)])
    scored = wide.select(key, F.expr(f"stack({len(names)}, {parts}) as (label, prediction, probability, _margin)"))
    if not calibrations:
        return scored.drop("_margin")
    scored = cut_lineage(scored)  # read once a calibrated label
    out = scored.where(~F.col("label").isin(list(calibrations)))
    for label, blocks in calibrations.items():
        out = out.unionByName(calibrate(scored.where(F.col("label") == label), blocks, "_margin"))
    return out.drop("_margin")

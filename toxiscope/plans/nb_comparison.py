"""Naive Bayes over labels × rebalancing methods, evaluated and ranked.

All runs share one scan, one token explode, one ``groupBy(term)`` (fit) and one
join + ``groupBy(doc)`` (predict); evaluation is one ``groupBy(run)`` aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxiscope.operators.balance import METHODS, method_weight_expr
from toxiscope.operators.evaluate import best_per_group, class_metrics, confusion_counts, metrics_wide
from toxiscope.operators.naive_bayes import NBModel, NBRun, nb_fit, nb_predict
from toxiscope.operators.profile import label_counts
from toxiscope.schema import TEXT_COL


def run_name(label: str, method: str) -> str:
    return f"{label}__{method}"


def make_runs(train: DataFrame, labels: list[str], methods: list[str], key: str) -> list[NBRun]:
    """Row weights of every (label, method); class counts of all labels from one job."""
    counts = {r["label"]: (int(r["total"]), int(r["positives"])) for r in label_counts(train, labels).collect()}
    runs = []
    for label in labels:
        n, pos = counts[label]
        for method in methods:
            runs.append(NBRun(run_name(label, method), label, method_weight_expr(method, label, key, pos, n)))
    return runs


def fit_runs(
    train: DataFrame, labels: list[str], methods: list[str], key: str = "doc_id", smoothing: float = 1.0
) -> NBModel:
    return nb_fit(train, make_runs(train, labels, methods, key), smoothing=smoothing, text_col=TEXT_COL)


def predict_runs(model: NBModel, test: DataFrame, labels: list[str], key: str = "doc_id") -> DataFrame:
    """Long predictions ``key, run, label_name, method, label (true), prediction, …``."""
    preds = nb_predict(model, test, key, keep_cols=labels, text_col=TEXT_COL)
    parts = F.split(F.col("run"), "__")
    label_name = parts.getItem(0)
    truth = F.coalesce(*[F.when(label_name == F.lit(l), F.col(l)) for l in labels])
    return preds.select(
        key,
        "run",
        label_name.alias("label_name"),
        parts.getItem(1).alias("method"),
        truth.alias("label"),
        "prediction",
        "margin",
        "probability",
    )


def run_metrics(predictions: DataFrame) -> DataFrame:
    """One row per run with every metric (wide)."""
    counts = confusion_counts(predictions, "label", "prediction", ["label_name", "method"])
    return metrics_wide(counts, ["label_name", "method"])


def best_model(
    train: DataFrame, test: DataFrame, labels: list[str], methods: list[str] = list(METHODS), key: str = "doc_id"
) -> DataFrame:
    """Best method per label by class-1 F1 (ties: method name)."""
    model = fit_runs(train, labels, methods, key)
    wide = run_metrics(predict_runs(model, test, labels, key)).select(
        F.col("label_name").alias("label"),
        F.lit("naive_bayes").alias("model"),
        "method",
        F.round("f1_1", 6).alias("f1"),
        F.round("precision_1", 6).alias("precision"),
        F.round("recall_1", 6).alias("recall"),
        F.round("acc", 6).alias("accuracy"),
    )
    return best_per_group(wide, "label", "f1", ["model", "method"])


def long_metrics(predictions: DataFrame, digits: int = 6) -> DataFrame:
    return class_metrics(predictions, "label", "prediction", ["label_name", "method"], digits)

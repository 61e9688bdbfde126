"""One-call jobs with the shape of the reference's programs.

``train_job`` / ``train_all_job``: labelled train + test files → features → rebalance → fit
(with CV) → predict test → metrics, written to ``out``. ``score_job``: saved features +
per-label models → score a table or folder of messages → write the scores. The caller owns
the session; nothing is collected to the driver.

A model folder holds one feature chain per feature kind, fitted once and used by all its
labels: a later training run into the folder loads the chain and does not refit it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from toxiscope.plans.training import TrainResult, no_null_text, prepare_features, train_all
from toxiscope.schema import COMMENT_SCHEMA, LABELS, TEXT_COL
from toxiscope.session import cut_lineage
from toxiscope.sources import model_io
from toxiscope.sources.readers import label_quality, read_comments, read_messages
from toxiscope.sources.sinks import write_frame, write_metrics_text

FEATURE_KIND = {"mlp": "word2vec"}  # as in the reference; the others take hashed counts


def validate_label(df: DataFrame, label: str) -> None:
    """The label argument must name an existing column."""
    if label not in df.columns:
        raise ValueError(f"label {label!r} is not a column; columns are {df.columns}")


def _comments(spark: SparkSession, path: str, fmt: str, key: str, labels: list[str]) -> DataFrame:
    from pyspark.sql import types as T

    known = {f.name: f for f in COMMENT_SCHEMA.fields}
    fields = [known.get(c, T.StructField(c, T.StringType())) for c in (key, TEXT_COL)]
    return read_comments(spark, path, fmt, T.StructType(fields + [T.StructField(c, T.IntegerType()) for c in labels]))


def train_all_job(
    spark: SparkSession,
    train_path: str,
    test_path: str,
    labels: list[str] | None = None,
    out: str | None = None,
    kind: str = "nb",
    method: str | None = None,
    fmt: str = "csv",
    feature_kind: str | None = None,
    key: str = "id",
    model_dir: str | None = None,
    text_output: bool = False,
    feature_params: dict | None = None,
    **train_kwargs,
) -> dict[str, TrainResult]:
    """Train and evaluate every label on one feature fit.

    ``feature_kind`` defaults to hashed counts, and to Word2Vec for the network. Metrics go
    to ``out``, one folder per label (Parquet, or the reference's ``(key,v0 | v1)`` text
    lines with ``text_output``); the fitted features and models go to ``model_dir``. A label
    with a single class gets NULL metrics and no model.
    """
    labels = list(labels or LABELS)
    train = _comments(spark, train_path, fmt, key, labels)
    test = _comments(spark, test_path, fmt, key, labels)
    fk = feature_kind or FEATURE_KIND.get(kind, "hashing")
    fitted = model_io.load_features(spark, model_dir, fk) if model_dir else None
    fm, train_f, test_f = prepare_features(train, test, key, labels, fk, fitted, **(feature_params or {}))
    results = train_all(train_f, test_f, labels, key, kind, method, **train_kwargs)
    for label, res in results.items():
        if out and text_output:
            write_metrics_text(res.metrics.drop("model", "method"), f"{out.rstrip('/')}/{label}")
        elif out:
            write_frame(res.metrics, f"{out.rstrip('/')}/{label}")
    if model_dir:
        if fitted is None:
            model_io.save_model(fm, model_io.features_path(model_dir, fk), overwrite=False)
        model_io.save_label_models({label: r.model for label, r in results.items()}, model_dir, kind)
    return results


def train_job(
    spark: SparkSession, train_path: str, test_path: str, label: str, out: str | None = None, **kwargs
) -> TrainResult:
    """Train and evaluate one label; see :func:`train_all_job`. Metrics go to ``out`` itself."""
    text_output = kwargs.pop("text_output", False)
    kwargs.pop("labels", None)
    res = train_all_job(spark, train_path, test_path, [label], **kwargs)[label]
    if out and text_output:
        write_metrics_text(res.metrics.drop("model", "method"), out)
    elif out:
        write_frame(res.metrics, out)
    return res


def score_job(
    spark: SparkSession,
    messages_path: str,
    model_dir: str,
    out: str | None = None,
    kind: str = "mlp",
    labels: list[str] | None = None,
    messages_fmt: str = "text",
    feature_kind: str | None = None,
) -> DataFrame:
    """Score every message for every label with saved models (one wide plan).

    ``messages_fmt='text'``: a folder of files, one message per file; ``'parquet'``: a
    table with ``message_id, clean_comment``. A label without a saved model scores NULL.
    """
    from toxiscope.operators.score import score_labels

    labels = list(labels or LABELS)
    if messages_fmt == "text":
        msgs = read_messages(spark, messages_path)
    else:
        msgs = spark.read.parquet(messages_path).select("message_id", "clean_comment")
    fk = feature_kind or FEATURE_KIND.get(kind, "hashing")
    fm = model_io.load_pipeline(model_io.features_path(model_dir, fk))
    models = model_io.load_label_models(model_dir, kind, labels)
    scored = score_labels(fm.transform(no_null_text(msgs)), models, "message_id")
    if out:
        write_frame(scored, out)
    return scored


def profile_job(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    labels: list[str] | None = None,
    out: str | None = None,
) -> dict[str, DataFrame]:
    """A3–A5 on a labelled-comment file: ``distribution``, ``tagged``, ``correlation`` and
    ``quality`` (null and invalid counts) frames, written under ``out``. The file is read
    once; the frames read the label columns written from it."""
    from toxiscope.operators import profile

    labels = list(labels or LABELS)
    from pyspark.sql import functions as F

    df = _comments(spark, path, fmt, "id", labels)
    empty = F.when(F.trim(TEXT_COL) == "", F.lit("")).otherwise(F.lit("x")).alias(TEXT_COL)
    df = cut_lineage(df.select(empty, *labels))
    frames = {
        "distribution": profile.label_distribution(df, labels),
        "tagged": profile.tagged_share(df, labels),
        "correlation": profile.label_correlation(df, labels),
        "quality": label_quality(df, labels),
    }
    if out:
        for name, frame in frames.items():
            write_frame(frame, f"{out.rstrip('/')}/{name}")
    return frames

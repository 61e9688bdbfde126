"""Registered queries that run Spark ML estimators on the driver tables.

``nb_ml`` and ``score_multilabel`` have exact SQL oracles (multinomial NB over the training
vocabulary equals the relational twin). The iterative estimators (LR, SVM, MLP, Word2Vec)
cannot be recomputed in SQL: their queries return, per row, whether the model's outputs
agree with each other or with a recomputation (``consistent``, ``difference``), and for LR
and SVM a proof of the fit (``violation``, 0 to the tolerance at a minimum); the SQL states
the rows and the expected values.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxiscope.operators.balance import WEIGHT_COL, class_weights, weight_expr
from toxiscope.operators.classifiers import make_classifier
from toxiscope.operators.features import explode_terms, fit_stages, text_stages
from toxiscope.operators.optimality import hinge_objective, logistic_violation
from toxiscope.operators.profile import balancing_ratio
from toxiscope.operators.score import score_labels
from toxiscope.operators.split import train_test
from toxiscope.plans.training import prepare_features, train_all, train_label, train_networks
from toxiscope.schema import DRIVER_LABELS, TEXT_COL
from toxiscope.session import cut_lineage, drop_path, scratch_path
from toxiscope.sources import model_io
from toxiscope.sources.readers import load_table, message_frame, training_frame

KEY = "doc_id"
LABEL = "toxic"

def _split(spark: SparkSession, d: str):
    return train_test(training_frame(spark, d), KEY)


def _checked(preds: DataFrame, label: str, check) -> DataFrame:
    """``doc_id, label, consistent``: do the model's own outputs agree on this row?"""
    return preds.select(KEY, F.col(label).alias("label"), check.alias("consistent"))


def _logistic_check():
    raw, prob = vector_to_array("rawPrediction"), vector_to_array("probability")
    same = F.abs(prob[1] - 1 / (1 + F.exp(-raw[1]))) < 1e-9
    return same & ((prob[1] > 0.5) == (F.col("prediction") == 1))


def _softmax_check():
    prob = vector_to_array("probability")
    total = F.aggregate(prob, F.lit(0.0), lambda a, x: a + x)
    best = F.array_position(prob, F.array_max(prob)) - 1
    return (F.abs(total - 1) < 1e-9) & (best == F.col("prediction").cast("long"))


def q_nb_ml(spark: SparkSession, d: str) -> DataFrame:
    """M1 with Spark ML: exact counts + weighted multinomial NB; margin = raw[1] − raw[0]."""
    train, test = _split(spark, d)
    _, train_f, test_f = prepare_features(train, test, KEY, [LABEL], "terms")
    model = make_classifier("nb", LABEL, weight_col=WEIGHT_COL).fit(class_weights(train_f, LABEL))
    raw = vector_to_array(F.col("rawPrediction"))
    return model.transform(test_f).select(
        KEY,
        F.col(LABEL).alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        F.round(raw[1] - raw[0], 3).alias("margin"),
    )


def q_term_vectors(spark: SparkSession, d: str) -> DataFrame:
    """F4 as ML vectors: ``doc_id, term_index, tf`` of every entry, over the vocabulary of all
    documents, read out of the vector column."""
    from toxiscope.functions.vectors import vector_entries
    from toxiscope.plans.prepared import cleaned_documents

    _, docs = fit_stages(text_stages("terms"), cleaned_documents(spark, d), [KEY])
    return vector_entries(docs, "features", KEY).select(
        KEY, F.col("index").cast("long").alias("term_index"), F.col("value").cast("long").alias("tf")
    )


def _proven(preds: DataFrame, label: str, check, violation: float) -> DataFrame:
    """Like :func:`_checked`, with the fit's largest violation, to three digits."""
    return _checked(preds, label, check).withColumn("violation", F.lit(round(violation, 3) + 0.0))


def q_lr_cv(spark: SparkSession, d: str) -> DataFrame:
    """M2 + M5 + M6: weighted LR, 9-point grid, 5 folds, 2^18 features. ``consistent``: the
    probability is the logistic of the margin, and the prediction is its larger side.
    ``violation``: the largest subgradient entry of the weighted, penalized loss at the chosen
    model, recomputed by joins and sums from the training rows; below 0.0005."""
    train, test = _split(spark, d)
    _, train_f, test_f = prepare_features(train, test, KEY, [LABEL], "hashing")
    res = train_label(train_f, test_f, LABEL, KEY, "lr", "weight")
    weight = weight_expr(LABEL, balancing_ratio(train_f, LABEL)[2])
    violation = logistic_violation(train_f, KEY, LABEL, weight, res.model, res.tuned.reg, res.tuned.elastic)
    return _proven(res.predictions, LABEL, _logistic_check(), violation)


def q_svm_cv(spark: SparkSession, d: str) -> DataFrame:
    """M3 + M5 + M6: weighted linear SVM, 3-point grid, 3 folds, 2^18 features. ``consistent``:
    the prediction is the sign of the margin. ``violation``: how far the objective, recomputed
    by joins and sums from the training rows, is above the dual's lower bound (relative)."""
    train, test = _split(spark, d)
    _, train_f, test_f = prepare_features(train, test, KEY, [LABEL], "hashing")
    res = train_label(train_f, test_f, LABEL, KEY, "svm", "weight")
    margin = vector_to_array("rawPrediction")[1]
    weight = weight_expr(LABEL, balancing_ratio(train_f, LABEL)[2])
    value = hinge_objective(train_f, KEY, LABEL, weight, res.model, res.tuned.reg)
    lower = res.tuned.objective * (1 - res.tuned.violation)
    return _proven(res.predictions, LABEL, (margin > 0) == (F.col("prediction") == 1), (value - lower) / max(value, 1e-300))


def q_mlp_word2vec(spark: SparkSession, d: str) -> DataFrame:
    """M4 + F6/F7: Word2Vec(100) document vectors → network 100-20-10-2, over-sampled. The
    check: probabilities sum to 1 and the prediction is the largest."""
    train, test = _split(spark, d)
    _, train_f, test_f = prepare_features(train, test, KEY, [LABEL], "word2vec")
    res = train_label(train_f, test_f, LABEL, KEY, "mlp", "oversample", num_inputs=100)
    return _checked(res.predictions, LABEL, _softmax_check())


def q_mlp_weighted(spark: SparkSession, d: str) -> DataFrame:
    """M4 + B1: the network 100-20-10-2 with class weights, both labels side by side. The
    check: probabilities sum to 1 and the prediction is the largest, per document and label."""
    train, test = _split(spark, d)
    _, train_f, test_f = prepare_features(train, test, KEY, DRIVER_LABELS, "word2vec")
    found = train_networks(train_f, test_f, [(label, "weight") for label in DRIVER_LABELS], KEY)
    parts = [_checked(r.predictions, label, _softmax_check()).withColumn("name", F.lit(label)) for (label, _), r in found.items()]
    return reduce(DataFrame.unionByName, parts).select(KEY, "name", "label", "consistent")


def q_word2vec_docs(spark: SparkSession, d: str) -> DataFrame:
    """F6 + F7: Word2Vec fitted on every document; ``difference`` compares each document
    vector with the average of its tokens' vectors, recomputed by an explode and a join.

    Both are projected on three fixed directions first, so the sums are three numbers per
    row. The text is read once; tokens and features come from written tables.
    """
    from toxiscope.plans.prepared import cleaned_documents

    model, docs = fit_stages(text_stages("word2vec"), cleaned_documents(spark, d), [KEY], with_tokens=True)
    docs = cut_lineage(docs)
    width = model.stages[-1].getVectorSize()

    def along(vector: str, k: int):
        axis = F.array(*[F.lit(math.cos((k + 1) * (j + 1))) for j in range(width)])
        parts = F.zip_with(vector_to_array(vector), axis, lambda x, g: x * g)
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)

    words = model.stages[-1].getVectors().select(
        F.col("word").alias("term"), *[along("vector", k).alias(f"w{k}") for k in range(3)]
    )
    sums = (
        explode_terms(docs, [KEY], tokens_col="stopWordFilter").join(cut_lineage(words), "term")
        .groupBy(KEY).agg(*[F.sum(f"w{k}").alias(f"s{k}") for k in range(3)])
    )
    n = F.greatest(F.size("stopWordFilter"), F.lit(1))
    gaps = [F.abs(along("features", k) - F.coalesce(F.col(f"s{k}"), F.lit(0.0)) / n) for k in range(3)]
    return docs.join(sums, KEY, "left").select(
        KEY, F.size(vector_to_array("features")).cast("long").alias("dims"),
        (F.round(F.greatest(*gaps), 4) + 0.0).alias("difference"),
    )


def q_mlp_embeddings(spark: SparkSession, d: str) -> DataFrame:
    """M4 on dense inputs: embeddings, layers 64-20-10-(classes of the table)."""
    from pyspark.ml.functions import array_to_vector

    emb = load_table(spark, d, "embeddings").where("embedding is not null and label is not null").select(
        "vec_id", array_to_vector("embedding").alias("features"), F.col("label").cast("int").alias("label")
    )
    train, test = train_test(emb, "vec_id")
    n_classes = int(emb.agg(F.coalesce(F.max("label"), F.lit(1))).first()[0]) + 1
    train = cut_lineage(train)  # read once per L-BFGS iteration
    width = int(train.select(vector_size("features")).first()[0])
    model = make_classifier("mlp", "label", num_inputs=width, num_classes=n_classes).fit(train)
    return model.transform(test).select("vec_id", "label", _softmax_check().alias("consistent"))


def vector_size(col: str):
    return F.size(vector_to_array(col))


def q_score_multilabel(spark: SparkSession, d: str) -> DataFrame:
    """M8–M10 + S5–S7: one weighted NB per label on exact counts, saved and re-loaded, then
    every conversation turn scored for all labels in one wide plan."""
    train, test = _split(spark, d)
    fm, train_f, test_f = prepare_features(train, test, KEY, DRIVER_LABELS, "terms")
    results = train_all(train_f, test_f, DRIVER_LABELS, KEY, "nb", "weight")
    base = scratch_path(spark, "models")
    model_io.save_model(fm, model_io.features_path(base, "terms"))
    model_io.save_label_models({label: r.model for label, r in results.items()}, base, "nb")
    loaded = model_io.load_label_models(base, "nb", DRIVER_LABELS)
    feats = model_io.load_features(spark, base, "terms").transform(message_frame(spark, d))
    drop_path(spark, base)  # loaded models are in memory
    scored = score_labels(feats, loaded, "message_id")
    return scored.withColumn("probability", F.round("probability", 4))


def q_model_comparison(spark: SparkSession, d: str) -> DataFrame:
    """A14 over all kinds: NB, LR, SVM and the network with every rebalancing method, for both
    labels, ranked per label by class-1 F1. LR and SVM are tuned over their
    grids with 5 / 3 folds, as in ``lr_cv`` and ``svm_cv``."""
    from toxiscope.plans.comparison import compare_models

    train, test = _split(spark, d)
    return compare_models(train, test, KEY, DRIVER_LABELS, num_folds=None)


def q_metrics_text(spark: SparkSession, d: str) -> DataFrame:
    """The reference's ``(key,v0 | v1)`` rendering of the weighted NB metrics, to six digits."""
    from toxiscope.plans.catalog import q_class_metrics
    from toxiscope.sources.sinks import render_metrics

    return render_metrics(q_class_metrics(spark, d), digits=6)


def q_stream_score(spark: SparkSession, d: str) -> DataFrame:
    """Streaming scoring of the documents table (file source, availableNow): per label the
    rows the sink committed and those that equal the batch predictions."""
    from toxiscope.streaming.scoring import stream_score_documents

    return stream_score_documents(spark, d)


ML_QUERIES = {
    "nb_ml": q_nb_ml,
    "term_vectors": q_term_vectors,
    "lr_cv": q_lr_cv,
    "svm_cv": q_svm_cv,
    "mlp_word2vec": q_mlp_word2vec,
    "mlp_weighted": q_mlp_weighted,
    "word2vec_docs": q_word2vec_docs,
    "mlp_embeddings": q_mlp_embeddings,
    "score_multilabel": q_score_multilabel,
    "metrics_text": q_metrics_text,
    "stream_score": q_stream_score,
    "model_comparison": q_model_comparison,
}

"""Registered queries over the driver tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads whole tables and whole texts. Doubles that are sums in a
partition-dependent order are rounded so the result can be compared with an
independent SQL evaluation (``toxiscope.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxiscope.functions.stopwords import english_stop_words
from toxiscope.functions.text import tokens_digest
from toxiscope.operators import balance, evaluate, features, profile
from toxiscope.operators.naive_bayes import NBRun, nb_fit, nb_log_theta, nb_predict
from toxiscope.operators.ranked_metrics import ranking_areas
from toxiscope.operators.split import hash_split
from toxiscope.operators.tuning import LR_FOLDS, SVM_FOLDS, grid_points, with_folds
from toxiscope.plans import nb_comparison
from toxiscope.plans.prepared import (
    cleaned_documents,
    labelled_documents,
    split_parts,
)
from toxiscope.schema import DRIVER_LABELS, TEXT_COL
from toxiscope.session import spread
from toxiscope.sources.readers import label_frame, load_table, training_frame

Query = Callable[[SparkSession, str], DataFrame]
MAIN_LABEL = "toxic"


# --- S1 P7 P1 P8 ------------------------------------------------------------------------------
def q_training_frame(spark: SparkSession, d: str) -> DataFrame:
    return training_frame(spark, d)


def q_clean_text(spark: SparkSession, d: str) -> DataFrame:
    return cleaned_documents(spark, d)


# --- F1 F2: the ML stages on raw document text ----------------------------------------------------
def _raw_tokens(spark: SparkSession, d: str) -> DataFrame:
    docs = spread(load_table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return Tokenizer(inputCol="text", outputCol="words").transform(docs)


def q_tokenize(spark: SparkSession, d: str) -> DataFrame:
    t = _raw_tokens(spark, d)
    return t.select(
        "doc_id", F.size("words").cast("long").alias("n_tokens"), tokens_digest("words").alias("tokens_md5")
    )


def q_stopwords(spark: SparkSession, d: str) -> DataFrame:
    remover = StopWordsRemover(
        inputCol="words", outputCol="kept", stopWords=list(english_stop_words()), caseSensitive=False
    )
    t = remover.transform(_raw_tokens(spark, d))
    return t.select("doc_id", F.size("kept").cast("long").alias("n_kept"), tokens_digest("kept").alias("kept_md5"))


# --- F3 F4 F5 -------------------------------------------------------------------------------------
def q_term_counts(spark: SparkSession, d: str) -> DataFrame:
    return features.term_counts(cleaned_documents(spark, d), "doc_id", text_col=TEXT_COL)


def q_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return features.vocabulary(features.term_counts(cleaned_documents(spark, d), "doc_id", text_col=TEXT_COL))


def q_tfidf(spark: SparkSession, d: str) -> DataFrame:
    docs = cleaned_documents(spark, d)
    n_docs = load_table(spark, d, "documents").count()
    out = features.tfidf(features.term_counts(docs, "doc_id", text_col=TEXT_COL), n_docs, "doc_id")
    return out.select("doc_id", "term", "tf", F.round("idf", 6).alias("idf"), F.round("tfidf", 6).alias("tfidf"))


def q_hashing_tf(spark: SparkSession, d: str) -> DataFrame:
    from toxiscope.functions.vectors import vector_stats

    docs = cleaned_documents(spark, d)
    hashed = features.text_stages("hashing").fit(docs).transform(docs)
    stats = vector_stats(hashed, "features", ["doc_id"])
    return stats.select("doc_id", F.col("total").cast("long").alias("tf_sum"))


# --- A3 A4 A5 -------------------------------------------------------------------------------------
def _labels_frame(spark: SparkSession, d: str) -> DataFrame:
    return label_frame(spark, d)


def q_label_distribution(spark: SparkSession, d: str) -> DataFrame:
    return profile.label_distribution(_labels_frame(spark, d), DRIVER_LABELS)


def q_tagged_share(spark: SparkSession, d: str) -> DataFrame:
    return profile.tagged_share(_labels_frame(spark, d), DRIVER_LABELS)


def q_label_correlation(spark: SparkSession, d: str) -> DataFrame:
    return profile.label_correlation(_labels_frame(spark, d), DRIVER_LABELS)


# --- P6 B1 B2 B3 ----------------------------------------------------------------------------------
def q_hash_split(spark: SparkSession, d: str) -> DataFrame:
    return hash_split(_labels_frame(spark, d), "doc_id").select("doc_id", "split_u", "is_test")


def q_fold_assignment(spark: SparkSession, d: str) -> DataFrame:
    """M6: the five folds of the training rows, positives dealt in turn."""
    return with_folds(_train_labels(spark, d), "doc_id", LR_FOLDS, MAIN_LABEL).select("doc_id", MAIN_LABEL, "fold")


def q_grid_points(spark: SparkSession, d: str) -> DataFrame:
    """M5: the tuning grids, with the rows each point is fitted on (folds x training rows)."""
    points = spark.createDataFrame(grid_points(), "model string, reg_param double, elastic_net_param double")
    n = _train_labels(spark, d).agg(F.count(MAIN_LABEL).alias("train_rows"))
    folds = F.when(F.col("model") == "lr", LR_FOLDS).otherwise(SVM_FOLDS)
    return points.join(F.broadcast(n)).withColumn("folds", folds.cast("int"))  # n is one row


def _train_labels(spark: SparkSession, d: str) -> DataFrame:
    marked = hash_split(_labels_frame(spark, d), "doc_id")
    return marked.where(~F.col("is_test")).select("doc_id", MAIN_LABEL)


def q_class_weights(spark: SparkSession, d: str) -> DataFrame:
    w = balance.class_weights(_train_labels(spark, d), MAIN_LABEL)
    return w.select("doc_id", MAIN_LABEL, F.round(balance.WEIGHT_COL, 9).alias(balance.WEIGHT_COL))


def q_oversample(spark: SparkSession, d: str) -> DataFrame:
    o = balance.oversample(_train_labels(spark, d), MAIN_LABEL, "doc_id")
    return o.select("doc_id", MAIN_LABEL, F.col("copy").cast("long").alias("copy"))


def q_undersample(spark: SparkSession, d: str) -> DataFrame:
    return balance.undersample(_train_labels(spark, d), MAIN_LABEL, "doc_id").select("doc_id", MAIN_LABEL)


# --- M1 twin + A6–A13 -----------------------------------------------------------------------------
def _weighted_nb(spark: SparkSession, d: str):
    train, test = split_parts(labelled_documents(spark, d))
    n, pos, ratio = profile.balancing_ratio(train, MAIN_LABEL)
    run = NBRun("m", MAIN_LABEL, balance.weight_expr(MAIN_LABEL, ratio))
    model = nb_fit(train, [run], text_col=TEXT_COL)
    return model, test


def nb_test_predictions(spark: SparkSession, d: str) -> DataFrame:
    model, test = _weighted_nb(spark, d)
    p = nb_predict(model, test, "doc_id", keep_cols=[MAIN_LABEL], text_col=TEXT_COL)
    return p.select("doc_id", F.col(MAIN_LABEL).alias("label"), "prediction", "margin", "probability")


def q_nb_model(spark: SparkSession, d: str) -> DataFrame:
    model, _ = _weighted_nb(spark, d)
    t = nb_log_theta(model, "m")
    return t.select("term", F.round("log_theta0", 6).alias("log_theta0"), F.round("log_theta1", 6).alias("log_theta1"))


def q_nb_predict(spark: SparkSession, d: str) -> DataFrame:
    p = nb_test_predictions(spark, d)
    return p.select("doc_id", "label", "prediction", F.round("margin", 3).alias("margin"))


def q_confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion_matrix(nb_test_predictions(spark, d)).select(
        "label", "prediction", F.col("n").cast("long").alias("n")
    )


def q_class_metrics(spark: SparkSession, d: str) -> DataFrame:
    m = evaluate.class_metrics(nb_test_predictions(spark, d), digits=6)
    return m.select(F.lit(MAIN_LABEL).alias("label"), "class", "metric", "value")


def q_weighted_f1(spark: SparkSession, d: str) -> DataFrame:
    w = evaluate.weighted_f1(nb_test_predictions(spark, d))
    return w.select(
        F.lit(MAIN_LABEL).alias("label"),
        F.round("weighted_f1", 6).alias("weighted_f1"),
        F.round("f1_class1", 6).alias("f1_class1"),
    )


def q_ranking_areas(spark: SparkSession, d: str) -> DataFrame:
    """Areas under the ROC and PR curves of the weighted NB's margin."""
    scored = nb_test_predictions(spark, d).select("label", F.round("margin", 6).alias("score"))
    areas = ranking_areas(scored)
    return areas.select(
        F.lit(MAIN_LABEL).alias("label"), "positives", "negatives", F.round("auc_roc", 6).alias("auc_roc"),
        F.round("auc_pr", 6).alias("auc_pr"),
    )


def q_calibrated_probability(spark: SparkSession, d: str) -> DataFrame:
    """Isotonic probability of the weighted NB's margin, fitted on the test documents."""
    from toxiscope.operators.calibration import calibrate, fit_calibration
    from toxiscope.session import cut_lineage

    scored = cut_lineage(nb_test_predictions(spark, d).select("doc_id", "label", F.round("margin", 6).alias("score")))
    found = calibrate(scored, fit_calibration(scored))
    return found.select("doc_id", "label", F.round("probability", 6).alias("probability"))


def q_best_model(spark: SparkSession, d: str) -> DataFrame:
    train, test = split_parts(labelled_documents(spark, d))
    return nb_comparison.best_model(train, test, DRIVER_LABELS)


def q_method_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Metrics of every label × method run (long form), the table behind the ranking."""
    train, test = split_parts(labelled_documents(spark, d))
    model = nb_comparison.fit_runs(train, DRIVER_LABELS, list(balance.METHODS))
    preds = nb_comparison.predict_runs(model, test, DRIVER_LABELS)
    return nb_comparison.long_metrics(preds).select(
        F.col("label_name").alias("label"), "method", "class", "metric", "value"
    )


SQL_CHECKED: dict[str, Query] = {
    "training_frame": q_training_frame,
    "clean_text": q_clean_text,
    "tokenize": q_tokenize,
    "stopwords": q_stopwords,
    "term_counts": q_term_counts,
    "vocabulary": q_vocabulary,
    "tfidf": q_tfidf,
    "hashing_tf": q_hashing_tf,
    "label_distribution": q_label_distribution,
    "tagged_share": q_tagged_share,
    "label_correlation": q_label_correlation,
    "hash_split": q_hash_split,
    "grid_points": q_grid_points,
    "fold_assignment": q_fold_assignment,
    "class_weights": q_class_weights,
    "oversample": q_oversample,
    "undersample": q_undersample,
    "nb_model": q_nb_model,
    "nb_predict": q_nb_predict,
    "confusion_matrix": q_confusion_matrix,
    "class_metrics": q_class_metrics,
    "weighted_f1": q_weighted_f1,
    "ranking_areas": q_ranking_areas,
    "calibrated_probability": q_calibrated_probability,
    "method_metrics": q_method_metrics,
    "best_model": q_best_model,
}


def all_queries() -> dict[str, Query]:
    from toxiscope.plans.ml_queries import ML_QUERIES

    return {**SQL_CHECKED, **ML_QUERIES}

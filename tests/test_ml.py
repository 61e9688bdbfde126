import random

import pytest
from pyspark.sql import functions as F

from toxiscope.operators.score import score_labels
from toxiscope.operators.split import train_test
from toxiscope.plans.training import prepare_features, train_all, train_label
from toxiscope.session import scratch_path
from toxiscope.sources import model_io

BAD = ["rude", "idiot", "stupid", "hate", "awful"]
GOOD = ["thanks", "edit", "page", "source", "article"]
NEUTRAL = ["the", "talk", "see", "please", "section", "review"]


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        toxic = int(rng.random() < 0.25)
        insult = int(toxic and rng.random() < 0.6)
        words = rng.sample(NEUTRAL, 3) + rng.sample(BAD if toxic else GOOD, 3)
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic, insult))
    return spark.createDataFrame(rows, "doc_id long, clean_comment string, toxic int, insult int")


@pytest.fixture(scope="module")
def feats(separable):
    train, test = train_test(separable, "doc_id")
    return prepare_features(train, test, "doc_id", ["toxic", "insult"], "hashing", num_features=1 << 10)


def _f1(metrics):
    return {(r.metric, r["class"]): r.value for r in metrics.collect()}[("f1", 1)]


@pytest.mark.parametrize("kind,method", [("nb", "weight"), ("nb", "oversample"), ("lr", "weight"),
                                         ("svm", "undersample")])
def test_f1_floor(feats, kind, method):
    _, tr, te = feats
    res = train_label(tr, te, "toxic", "doc_id", kind, method, num_folds=2, reg_params=[0.01],
                      elastic_net_params=[0.0])
    assert _f1(res.metrics) >= 0.9


def test_mlp_oversample(feats):
    _, tr, te = feats
    res = train_label(tr, te, "toxic", "doc_id", "mlp", "oversample")
    assert _f1(res.metrics) >= 0.9


def test_mlp_weight(feats):
    _, tr, te = feats
    res = train_label(tr, te, "toxic", "doc_id", "mlp", "weight")
    assert res.method == "weight" and _f1(res.metrics) >= 0.9


def test_train_all_and_multilabel_scoring_roundtrip(spark, feats, separable):
    fm, tr, te = feats
    results = train_all(tr, te, ["toxic", "insult"], "doc_id", "nb", "weight")
    models = {k: v.model for k, v in results.items()}
    base = scratch_path(spark, "test-models")
    model_io.save_model(fm, f"{base}/features")
    model_io.save_label_models(models, base, "nb")
    loaded = model_io.load_label_models(base, "nb", ["toxic", "insult"])
    fm2 = model_io.load_pipeline(f"{base}/features")
    msgs = separable.select(F.col("doc_id").alias("message_id"), "clean_comment")
    a = score_labels(fm.transform(msgs), models, "message_id")
    b = score_labels(fm2.transform(msgs), loaded, "message_id")
    assert a.columns == ["message_id", "label", "prediction", "probability"]
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.collect()))
    assert ra == rb and len(ra) == 2 * 400
    truth = {r.doc_id: r.toxic for r in separable.collect()}
    acc = sum(1 for m, l, p, _ in ra if l == "toxic" and p == truth[m]) / 400
    assert acc > 0.9


def test_svm_scores_have_null_probability(feats, separable):
    fm, tr, te = feats
    res = train_label(tr, te, "toxic", "doc_id", "svm", "weight", num_folds=0)
    out = score_labels(fm.transform(separable), {"toxic": res.model}, "doc_id")
    assert out.where(F.col("probability").isNotNull()).count() == 0


def test_streaming_scoring_of_message_files(spark, feats, tmp_path):
    from toxiscope.streaming.scoring import read_message_stream, score_stream, start_scoring

    fm, tr, te = feats
    res = train_label(tr, te, "toxic", "doc_id", "nb", "weight")
    d = tmp_path / "in"
    d.mkdir()
    (d / "a.txt").write_text("rude idiot hate")
    (d / "b.txt").write_text("thanks edit page")
    scored = score_stream(read_message_stream(spark, str(d)), fm, {"toxic": res.model}, "message_id")
    sink = scratch_path(spark, "t-sink")
    q = start_scoring(scored, sink, scratch_path(spark, "t-ck"))
    q.awaitTermination()
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.prediction for r in rows) == [0, 1] and {r.label for r in rows} == {"toxic"}


def test_oversample_weight_equals_duplicates_for_ml_nb(feats):
    from pyspark.ml.classification import NaiveBayes

    from toxiscope.operators.balance import oversample, rebalance_for_fit

    _, tr, _ = feats
    rows, wcol = rebalance_for_fit(tr, "toxic", "doc_id", "oversample", supports_weight=True)
    assert wcol == "sampleWeight" and rows.count() == tr.count()
    a = NaiveBayes(labelCol="toxic", weightCol=wcol).fit(rows)
    b = NaiveBayes(labelCol="toxic").fit(oversample(tr, "toxic", "doc_id"))
    assert abs(a.theta.toArray() - b.theta.toArray()).max() < 1e-9
    assert abs(a.pi.toArray() - b.pi.toArray()).max() < 1e-9
    mlp_rows, none = rebalance_for_fit(tr, "toxic", "doc_id", "oversample", supports_weight=False)
    assert none is None and mlp_rows.count() == oversample(tr, "toxic", "doc_id").count()


def test_stream_scores_equal_batch_scores(spark, feats, separable, tmp_path):
    from toxiscope.operators.score import score_labels
    from toxiscope.streaming.scoring import score_stream, start_scoring

    fm, tr, te = feats
    res = train_label(tr, te, "toxic", "doc_id", "nb", "weight")
    src = str(tmp_path / "src")
    separable.select("doc_id", "clean_comment").repartition(3).write.parquet(src)
    stream = spark.readStream.schema("doc_id long, clean_comment string").parquet(src)
    sink = scratch_path(spark, "eq-sink")
    q = start_scoring(score_stream(stream, fm, {"toxic": res.model}, "doc_id"), sink, scratch_path(spark, "eq-ck"))
    q.awaitTermination()
    streamed = sorted(map(tuple, spark.read.parquet(sink).collect()))
    batch = sorted(map(tuple, score_labels(fm.transform(separable), {"toxic": res.model}, "doc_id").collect()))
    assert streamed == batch and len(batch) == 400


def test_single_class_label_gives_null_metrics(feats):
    _, tr, te = feats
    constant = tr.withColumn("toxic", F.lit(0))
    res = train_label(constant, te, "toxic", "doc_id", "svm", "weight")
    assert res.model is None and res.predictions.count() == 0
    assert all(r.value is None for r in res.metrics.collect())


def test_stream_restart_resumes_without_duplicates(spark, feats, tmp_path):
    from toxiscope.streaming.scoring import read_message_stream, score_stream, start_scoring

    fm, tr, te = feats
    res = train_label(tr, te, "toxic", "doc_id", "nb", "weight")
    d = tmp_path / "inbox"
    d.mkdir()
    (d / "1.txt").write_text("rude idiot")
    (d / "2.txt").write_text("thanks for the edit")
    sink, ckpt = scratch_path(spark, "rs-sink"), scratch_path(spark, "rs-ck")

    def run():
        scored = score_stream(read_message_stream(spark, str(d)), fm, {"toxic": res.model}, "message_id")
        start_scoring(scored, sink, ckpt).awaitTermination()
        return spark.read.parquet(sink).count()

    assert run() == 2
    (d / "3.txt").write_text("awful stupid hate")
    assert run() == 3  # only the new file is scored; committed batches are not redone


def test_one_positive_does_not_break_cross_validation(feats):
    _, tr, te = feats
    one = tr.withColumn("toxic", F.when(F.col("doc_id") == tr.agg(F.min("doc_id")).first()[0], 1).otherwise(0))
    res = train_label(one, te, "toxic", "doc_id", "svm", "weight", num_folds=3)
    assert res.model is not None


def test_folds_hold_positives_in_turn(spark):
    from toxiscope.operators.tuning import with_folds

    df = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(200)], "doc_id long, toxic int")
    rows = with_folds(df, "doc_id", 5, "toxic").where("toxic = 1").groupBy("fold").count().collect()
    assert {r.fold: r["count"] for r in rows} == dict.fromkeys(range(5), 2)


def test_folds_are_honoured_for_every_kind(feats):
    from pyspark.ml.tuning import CrossValidatorModel

    import toxiscope.plans.training as training

    _, tr, te = feats
    seen = []
    keep = training.cross_validate
    training.cross_validate = lambda *a, **k: seen.append(a[4]) or keep(*a, **k)
    try:
        assert train_label(tr, te, "toxic", "doc_id", "nb", num_folds=3).model is not None
    finally:
        training.cross_validate = keep
    assert seen == [3] and CrossValidatorModel


def test_null_labels_and_null_text_are_survived(spark):
    rows = [(i, None if i % 7 == 0 else ("rude idiot" if i % 2 else "thanks page"), None if i % 5 == 0 else i % 2, i % 2)
            for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, clean_comment string, toxic int, insult int")
    train, test = train_test(df, "doc_id")
    for kind in ("hashing", "tfidf"):
        _, tr, te = prepare_features(train, test, "doc_id", ["toxic", "insult"], kind, num_features=64)
        res = train_label(tr, te, "toxic", "doc_id", "nb")
        assert res.predictions.count() == test.where("toxic is not null").count()


def test_model_comparison_ranks_every_run(separable):
    from toxiscope.plans.comparison import compare_models

    train, test = train_test(separable, "doc_id")
    rows = compare_models(train, test, "doc_id", ["toxic"], kinds=("nb", "lr", "svm"), methods=("weight", "undersample"),
                          num_features=1 << 10).collect()
    assert len(rows) == 6 and sorted(r["rank"] for r in rows) == list(range(1, 7))
    best = sorted(rows, key=lambda r: r["rank"])
    assert best[0].f1 >= 0.9 and [r.f1 for r in best] == sorted((r.f1 for r in best), reverse=True)


def test_model_comparison_query_tunes_over_grid_and_folds(spark, monkeypatch):
    from toxiscope.plans import comparison, ml_queries

    folds, keep = [], spark.read.__class__.parquet
    monkeypatch.setattr(comparison, "prepare_features", lambda *a, **k: (None, None, None))
    monkeypatch.setattr(comparison, "train_all", lambda *a, num_folds=None, **k: folds.append(num_folds) or {})
    monkeypatch.setattr(comparison, "train_linear", lambda *a: folds.append(a[-1]) or {})
    monkeypatch.setattr(comparison, "train_networks", lambda *a: {})
    monkeypatch.setattr(spark.read.__class__, "parquet", lambda self, *a, **k: keep(self, *a, **k) if "/runs-" not in a[0] else None)
    monkeypatch.setattr(comparison, "ranked", lambda results: results)
    ml_queries.q_model_comparison(spark, "/root/testdata/sf0.001")
    assert folds and set(folds) == {None}  # None: each kind's own folds


@pytest.mark.parametrize("parts", [None, 3])
def test_stream_score_takes_a_file_or_a_folder(spark, tmp_path, parts):
    import shutil

    from toxiscope.streaming.scoring import stream_score_documents

    source = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        if parts and name == "documents":
            spark.read.parquet(f"{source}/{name}.parquet").repartition(parts).write.parquet(f"{tmp_path}/{name}.parquet")
        else:
            shutil.copy(f"{source}/{name}.parquet", f"{tmp_path}/{name}.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").count()
    found = stream_score_documents(spark, str(tmp_path)).collect()
    assert len(found) == 2 and all(r["rows"] == r["equal_to_batch"] == rows for r in found)


def test_model_comparison_restart_makes_only_what_is_missing(spark, separable, monkeypatch):
    from toxiscope.plans import comparison

    train, test = train_test(separable, "doc_id")
    runs = scratch_path(spark, "test-runs")
    go = lambda kinds: comparison.compare_models(
        train, test, "doc_id", ["toxic"], kinds, ("weight", "undersample"), num_folds=2, runs_dir=runs, num_features=1 << 10
    ).collect()
    first = go(("nb", "lr"))
    made, keep = [], comparison.train_linear
    monkeypatch.setattr(comparison, "train_linear", lambda *a: made.append(a[4]) or keep(*a))
    monkeypatch.setattr(comparison, "train_all", lambda *a, **k: pytest.fail("a finished run was made again"))
    again = go(("nb", "lr", "svm"))
    assert made == ["svm"] and len(again) == 6
    without_rank = lambda rows, kinds: sorted(tuple(r)[:-1] for r in rows if r.model in kinds)
    assert without_rank(again, ("nb", "lr")) == without_rank(first, ("nb", "lr"))


def test_stream_of_one_row_group_is_scored_by_many_tasks(spark, tmp_path, monkeypatch):
    import shutil

    from toxiscope.streaming import scoring

    for name in ("documents", "labels"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", f"{tmp_path}/{name}.parquet")
    plans, start = [], scoring.start_scoring
    monkeypatch.setattr(scoring, "start_scoring", lambda s, *a, **k: plans.append(s._jdf.queryExecution().logical().toString()) or start(s, *a, **k))
    found = scoring.stream_score_documents(spark, str(tmp_path)).collect()
    assert "RepartitionByExpression [doc_id" in plans[0]
    assert len(found) == 2 and all(r["rows"] == r["equal_to_batch"] > 0 for r in found)

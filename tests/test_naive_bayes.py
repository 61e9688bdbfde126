import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer

from toxiscope.operators import balance, profile
from toxiscope.operators.naive_bayes import NBRun, nb_fit, nb_log_theta, nb_predict
from toxiscope.operators.features import with_tokens
from toxiscope.plans.prepared import labelled_documents, split_parts

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def parts(spark):
    train, test = split_parts(with_tokens(labelled_documents(spark, SF_SMALL)))
    return train.cache(), test.cache()


def test_twin_equals_ml_naive_bayes(spark, parts):
    train, test = parts
    _, _, ratio = profile.balancing_ratio(train, "toxic")
    twin = nb_fit(train, [NBRun("m", "toxic", balance.weight_expr("toxic", ratio))])
    cv = CountVectorizer(inputCol="tokens", outputCol="features", vocabSize=1 << 24).fit(train)
    tr = balance.class_weights(cv.transform(train), "toxic", ratio=ratio)
    ml = NaiveBayes(labelCol="toxic", weightCol="classWeightCol", smoothing=1.0).fit(tr)
    assert twin.vocab_size == len(cv.vocabulary)
    theta = ml.theta.toArray()
    lt = {r.term: (r.log_theta0, r.log_theta1) for r in nb_log_theta(twin, "m").collect()}
    mine = np.array([lt[t] for t in cv.vocabulary]).T
    assert np.max(np.abs(mine - theta)) < 1e-9
    assert np.allclose([twin.log_prior["m"][0], twin.log_prior["m"][1]], ml.pi.toArray(), atol=1e-12)
    ours = {r.doc_id: (r.prediction, r.margin) for r in nb_predict(twin, test, "doc_id").collect()}
    theirs = ml.transform(cv.transform(test)).select(
        "doc_id", "prediction", "rawPrediction").collect()
    for r in theirs:
        raw = r.rawPrediction.toArray()
        assert ours[r.doc_id][0] == int(r.prediction)
        assert ours[r.doc_id][1] == pytest.approx(raw[1] - raw[0], abs=1e-7)


def test_many_runs_equal_single_runs(spark, parts):
    train, test = parts
    n, pos, _ = profile.balancing_ratio(train, "toxic")
    runs = [NBRun(m, "toxic", balance.method_weight_expr(m, "toxic", "doc_id", pos, n)) for m in balance.METHODS]
    many = nb_fit(train, runs)
    for run in runs:
        one = nb_fit(train, [NBRun("x", run.label_col, run.weight)])
        a = {r.term: (r.log_theta0, r.log_theta1) for r in nb_log_theta(many, run.name).collect()}
        b = {r.term: (r.log_theta0, r.log_theta1) for r in nb_log_theta(one, "x").collect()}
        assert a.keys() == b.keys()
        assert max(abs(a[k][0] - b[k][0]) + abs(a[k][1] - b[k][1]) for k in a) < 1e-12


def test_oversample_weight_equals_duplicated_rows(spark, parts):
    train, _ = parts
    n, pos, _ = profile.balancing_ratio(train, "toxic")
    w = nb_fit(train, [NBRun("w", "toxic", balance.method_weight_expr("oversample", "toxic", "doc_id", pos, n))])
    dup = balance.oversample(train, "toxic", "doc_id")
    d = nb_fit(dup, [NBRun("d", "toxic")])
    assert w.log_prior["w"] == pytest.approx(d.log_prior["d"])
    a = {r.term: r.log_theta1 for r in nb_log_theta(w, "w").collect()}
    b = {r.term: r.log_theta1 for r in nb_log_theta(d, "d").collect()}
    assert max(abs(a[k] - b[k]) for k in a) < 1e-12


def test_empty_document_gets_prior(spark, parts):
    train, _ = parts
    model = nb_fit(train, [NBRun("m", "toxic")])
    empty = spark.createDataFrame([(999999, [])], "doc_id long, tokens array<string>")
    r = nb_predict(model, empty, "doc_id").first()
    assert r.score0 == pytest.approx(model.log_prior["m"][0])
    assert r.score1 == pytest.approx(model.log_prior["m"][1])


def test_empty_vocabulary_is_refused(spark):
    rows = spark.createDataFrame([(1, [], 0), (2, [], 1)], "doc_id long, tokens array<string>, toxic int")
    with pytest.raises(ValueError):
        nb_fit(rows, [NBRun("m", "toxic")])


def test_null_label_of_one_run_leaves_the_other_run_unchanged(spark):
    rows = [(1, ["a", "b"], 0, 1), (2, ["b", "c"], 1, 0), (3, ["d", "a"], 1, None), (4, ["e"], None, None)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>, toxic int, other int")
    both = nb_fit(df, [NBRun("t", "toxic"), NBRun("o", "other")])
    for name, label in (("t", "toxic"), ("o", "other")):
        alone = nb_fit(df.where(f"{label} is not null"), [NBRun("x", label)])
        assert both.vocab_sizes[name] == alone.vocab_sizes["x"]
        assert both.log_prior[name] == pytest.approx(alone.log_prior["x"])
        a = sorted(map(tuple, nb_log_theta(both, name).collect()))
        assert a == sorted(map(tuple, nb_log_theta(alone, "x").collect()))
    assert both.vocab_sizes == {"t": 4, "o": 3}


def test_scoring_beyond_the_broadcast_budget(spark, parts):
    train, test = parts
    model = nb_fit(train, [NBRun("m", "toxic")])
    wide = nb_predict(model, test, "doc_id")
    beyond = nb_predict(model, test, "doc_id", broadcast_max_bytes=0)
    near = {r.doc_id: r.margin for r in wide.collect()}
    for r in beyond.collect():
        assert r.margin == pytest.approx(near[r.doc_id], abs=1e-9)

import math

import numpy as np
import pytest
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, Word2Vec
from pyspark.sql import functions as F

from toxiscope.functions.vectors import vector_stats
from toxiscope.operators.features import term_counts, text_stages, tfidf, vocabulary
from toxiscope.operators.ranking import global_index

DOCS = [(1, ["a", "b", "a"]), (2, ["b", "c"]), (3, []), (4, ["a", "d", "d", "d"])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, tokens array<string>")


def test_term_counts_and_vocabulary(docs):
    tc = term_counts(docs, "doc_id")
    assert sorted(map(tuple, tc.collect())) == [(1, "a", 2), (1, "b", 1), (2, "b", 1), (2, "c", 1),
                                                 (4, "a", 1), (4, "d", 3)]
    v = {r.term: (r.doc_freq, r.term_count, r.term_index) for r in vocabulary(tc).collect()}
    # a: 3 occurrences, d: 3 (tie → term asc), b: 2, c: 1
    assert v == {"a": (2, 3, 0), "d": (1, 3, 1), "b": (2, 2, 2), "c": (1, 1, 3)}
    assert sorted(r.term for r in vocabulary(tc, vocab_size=2).collect()) == ["a", "d"]


def test_global_index_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    out = global_index(df, [F.col("k").desc()], "idx")
    rows = out.collect()
    assert sorted(r.idx for r in rows) == list(range(5000))
    assert all(r.idx == 4999 - r.k for r in rows)


def test_tfidf_matches_ml_idf(spark, docs):
    cv = CountVectorizer(inputCol="tokens", outputCol="tf").fit(docs)
    idf = IDF(inputCol="tf", outputCol="x").fit(cv.transform(docs)).idf.toArray()
    spark_idf = dict(zip(cv.vocabulary, idf))
    ours = tfidf(term_counts(docs, "doc_id"), docs.count(), "doc_id").collect()
    for r in ours:
        assert r.idf == pytest.approx(spark_idf[r.term])
        assert r.tfidf == pytest.approx(r.tf * spark_idf[r.term])
    by_term = {r.term: r.idf for r in ours}
    assert by_term["a"] == pytest.approx(math.log(5 / 3)) and by_term["c"] == pytest.approx(math.log(5 / 2))


def test_vector_stats_sparse_and_dense(spark, docs):
    h = HashingTF(inputCol="tokens", outputCol="f", numFeatures=1 << 18).transform(docs)
    rows = {r.doc_id: r for r in vector_stats(h, "f", ["doc_id"]).collect()}
    assert [rows[i].total for i in (1, 2, 3, 4)] == [3.0, 2.0, 0.0, 4.0]
    assert [rows[i].nnz for i in (1, 2, 3, 4)] == [2, 2, 0, 2]
    assert rows[1].vec_size == 1 << 18
    from pyspark.ml.functions import array_to_vector
    dense = spark.createDataFrame([(1, [1.0, 0.0, 2.5])], "doc_id long, a array<double>").select(
        "doc_id", array_to_vector("a").alias("v"))
    r = vector_stats(dense, "v", ["doc_id"]).first()
    assert (r.vec_size, r.nnz, r.total) == (3, 2, 3.5)


def test_word2vec_average_rule(spark):
    sents = spark.createDataFrame([(["a", "b", "a", "b"],)] * 10, "tokens array<string>")
    model = Word2Vec(inputCol="tokens", outputCol="v", vectorSize=4, minCount=1, seed=1).fit(sents)
    vec = {r.word: np.array(r.vector.toArray()) for r in model.getVectors().collect()}
    q = spark.createDataFrame([(["a", "zzz"],), ([],)], "tokens array<string>")
    out = [np.array(r.v.toArray()) for r in model.transform(q).collect()]
    assert np.allclose(out[0], vec["a"] / 2, atol=1e-6)
    assert np.allclose(out[1], np.zeros(4))


def test_text_stages_kinds(spark):
    df = spark.createDataFrame([("good edit thanks",), ("bad bad rude words",)], "clean_comment string")
    for kind in ("hashing", "counts", "tfidf"):
        out = text_stages(kind, num_features=64).fit(df).transform(df)
        assert "features" in out.columns and out.count() == 2
    with pytest.raises(ValueError):
        text_stages("nope")


def test_word2vec_trains_on_more_partitions_when_tokens_grow(spark, monkeypatch):
    from toxiscope.operators import features

    assert features.w2v_partitions_for(0) == features.w2v_partitions_for(32_000_000) == 8
    assert features.w2v_partitions_for(32_000_001) == features.w2v_partitions_for(150_000_000) == 24
    assert features.w2v_partitions_for(900_000_000) == 72
    assert features.w2v_partitions_for(32_000_001, 40) == 40
    monkeypatch.setattr(features, "W2V_SMALL_TOKENS", 10)
    seen = []
    fit = features.Word2Vec._fit
    monkeypatch.setattr(features.Word2Vec, "_fit", lambda self, df: seen.append(self.getNumPartitions()) or fit(self, df))
    df = spark.createDataFrame([(i, f"red green blue w{i % 7}") for i in range(60)], ["id", "clean_comment"])
    stages = features.text_stages("word2vec", w2v_vector_size=4, w2v_min_count=1)
    model, out = features.fit_stages(stages, df, ["id"])
    assert seen == [24] and out.count() == 60 and stages.getStages()[-1].getNumPartitions() == 8

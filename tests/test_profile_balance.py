import math

from pyspark.sql import functions as F

from toxiscope.operators import balance, profile
from toxiscope.schema import LABELS
from toxiscope.sources.readers import training_frame

from conftest import SF_CHECK


def test_label_distribution_six_labels(six_labels):
    rows = {r.label: r for r in profile.label_distribution(six_labels, LABELS).collect()}
    assert [rows[l].positives for l in LABELS] == [2, 1, 1, 1, 2, 0]
    assert all(rows[l].total == 4 for l in LABELS)
    assert rows["toxic"].pct_truncated == 50.0


def test_pct_is_truncated_not_rounded(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 998, "toxic int")  # 0.2% exactly
    df2 = spark.createDataFrame([(1,)] * 19 + [(0,)] * 981, "toxic int")  # 1.9%
    assert profile.label_distribution(df, ["toxic"]).first().pct_truncated == 0.2
    df3 = spark.createDataFrame([(1,)] * 96 + [(0,)] * 904 + [(0,)] * 1, "toxic int")  # 9.59..%
    assert profile.label_distribution(df3, ["toxic"]).first().pct_truncated == 9.5
    assert profile.label_distribution(df2, ["toxic"]).first().pct_truncated == 1.9


def test_tagged_share_and_correlation(six_labels):
    t = profile.tagged_share(six_labels, LABELS).first()
    assert (t.tagged, t.total, t.share) == (2, 4, 0.5)
    corr = {(r.label_a, r.label_b): r.corr for r in profile.label_correlation(six_labels, LABELS).collect()}
    assert corr[("toxic", "insult")] == 1.0
    assert all(v is None for (a, b), v in corr.items() if "identity_hate" in (a, b))
    assert len(corr) == 15


def test_class_weights_one_to_nine(spark):
    df = spark.createDataFrame([(1,)] + [(0,)] * 9, "toxic int")
    w = sorted({r[0] for r in balance.class_weights(df, "toxic").select("classWeightCol").collect()})
    assert [round(x, 12) for x in w] == [0.1, 0.9]


def test_balancing_ratio_driver_data(spark):
    n, pos, r = profile.balancing_ratio(training_frame(spark, SF_CHECK), "toxic")
    assert (n, pos) == (399, 51)
    assert r == 0.8721804511278195


def test_weight_sum_identity(spark):
    tf = training_frame(spark, SF_CHECK)
    n, pos, _ = profile.balancing_ratio(tf, "toxic")
    total = balance.class_weights(tf, "toxic").agg(F.sum("classWeightCol")).first()[0]
    assert math.isclose(total, 2 * pos * (n - pos) / n, rel_tol=1e-12)


def test_oversample_near_one_to_one_and_partition_invariant(spark):
    tf = training_frame(spark, SF_CHECK).select("doc_id", "toxic")
    a = balance.oversample(tf, "toxic", "doc_id")
    b = balance.oversample(tf.repartition(5), "toxic", "doc_id")
    rows_a = sorted(map(tuple, a.collect()))
    assert rows_a == sorted(map(tuple, b.collect()))
    pos = sum(1 for r in rows_a if r[1] == 1)
    neg = sum(1 for r in rows_a if r[1] == 0)
    assert abs(pos - neg) <= 0.1 * neg


def test_undersample_keeps_every_positive(spark):
    tf = training_frame(spark, SF_CHECK).select("doc_id", "toxic")
    u = balance.undersample(tf, "toxic", "doc_id")
    assert u.where("toxic = 1").count() == 51
    neg = u.where("toxic = 0").count()
    assert 20 <= neg <= 90
    assert sorted(map(tuple, u.collect())) == sorted(map(tuple, balance.undersample(tf.repartition(3), "toxic", "doc_id").collect()))


def test_empty_frame_profiles_do_not_fail(spark):
    empty = spark.createDataFrame([], "toxic int, insult int")
    rows = profile.label_distribution(empty, ["toxic", "insult"]).collect()
    assert [(r.positives, r.total, r.share) for r in rows] == [(0, 0, None), (0, 0, None)]
    t = profile.tagged_share(empty, ["toxic", "insult"]).first()
    assert (t.tagged, t.total, t.share) == (0, 0, None)
    import pytest

    with pytest.raises(ValueError):
        profile.balancing_ratio(empty, "toxic")

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from toxiscope.operators.ranked_metrics import ranking_areas


@pytest.mark.parametrize("digits", [1, 2, 9])
def test_areas_equal_the_evaluator_and_pair_counts(spark, digits):
    rng = random.Random(digits)
    rows = [(float(rng.random() < 0.3), round(rng.random(), digits)) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, score double").repartition(5)
    r = ranking_areas(df).first()
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    pairs = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert r.auc_roc == pytest.approx(pairs, abs=1e-12)
    for metric, value in (("areaUnderROC", r.auc_roc), ("areaUnderPR", r.auc_pr)):
        ev = BinaryClassificationEvaluator(rawPredictionCol="score", metricName=metric, numBins=0)
        assert value == pytest.approx(ev.evaluate(df), abs=1e-9)


def test_areas_of_one_class_and_nulls(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.4), (None, 0.1), (0, None)], "label int, score double")
    assert tuple(ranking_areas(df).first()) == (2, 0, None, 1.0)
    assert tuple(ranking_areas(df.where(F.lit(False))).first()) == (0, 0, None, None)

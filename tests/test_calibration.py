import math
import random

import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from toxiscope.operators.calibration import calibrate, fit_calibration
from toxiscope.operators.score import score_labels


def brute(rows):
    """{score: probability} by the min-max form of isotonic regression."""
    known = sorted((s, y) for y, s in rows if y is not None and s is not None and not math.isnan(s))
    scores = sorted({s for s, _ in known})
    p = [sum(y == 1 for t, y in known if t == s) for s in scores]
    n = [sum(t == s for t, _ in known) for s in scores]
    m = len(scores)
    share = [[sum(p[j : k + 1]) / sum(n[j : k + 1]) if k >= j else 0 for k in range(m)] for j in range(m)]
    return {scores[i]: max(min(share[j][i:]) for j in range(i + 1)) for i in range(m)}


CASES = {
    "noise": lambda r: [(r.randrange(2), round(r.gauss(0, 2), 1)) for _ in range(300)],
    "trend": lambda r: [(int(r.random() < 1 / (1 + math.exp(-x))), x) for x in (round(r.uniform(-4, 4), 2) for _ in range(300))],
    "falling": lambda r: [(int(i < 40), float(i)) for i in range(80)],  # one block over all partitions
    "hot": lambda r: [(r.randrange(2), 0.5) for _ in range(200)] + [(1, 2.0), (0, -0.0), (1, 0.0)],
    "holes": lambda r: [(None, 1.0), (1, None), (0, float("nan")), (1, 3.0), (0, 2.0), (0, float("-inf")), (1, float("inf"))],
    "one class": lambda r: [(1, 1.0), (1, 2.0)],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_the_definition(spark, name):
    rows = CASES[name](random.Random(3))
    df = spark.createDataFrame(rows, "label int, score double").repartition(6)
    blocks = fit_calibration(df)
    fitted = sorted(map(tuple, blocks.select("low", "high", "probability").collect()))
    assert all(a[1] < b[0] and a[2] < b[2] for a, b in zip(fitted, fitted[1:]))
    want = brute(rows)
    got = calibrate(df, blocks).collect()
    assert len(got) == len(rows)
    for r in got:
        known = r.score is not None and not math.isnan(r.score)
        if known and r.label is not None:
            assert r.probability == pytest.approx(want[r.score])
        assert (r.probability is None) == (not known)


def test_between_and_beyond_the_blocks(spark):
    fit = spark.createDataFrame([(0, 1.0), (1, 2.0), (0, 2.0), (1, 5.0)], "label int, score double")
    ask = spark.createDataFrame([(0.0, "a"), (1.5, "b"), (2.0, "c"), (4.9, "d"), (9.0, "e"), (9.0, "e")], "score double, _score string")
    out = calibrate(ask, fit_calibration(fit))
    assert out.columns == ["score", "_score", "probability"]
    assert sorted((r["_score"], r.probability) for r in out.collect()) == [("a", 0.0), ("b", 0.0), ("c", 0.5), ("d", 0.5), ("e", 1.0), ("e", 1.0)]
    none = calibrate(ask, fit_calibration(fit.limit(0)))
    assert [r.probability for r in none.collect()] == [None] * 6
    assert calibrate(ask.limit(0), fit_calibration(fit)).count() == 0


def test_probabilities_of_a_linear_svm(spark):
    r = random.Random(8)
    rows = [(i, int(x + r.gauss(0, 0.7) > 0), Vectors.dense([x, r.random()])) for i, x in enumerate(r.uniform(-2, 2) for _ in range(120))]
    df = spark.createDataFrame(rows, ["doc_id", "toxic", "features"])
    model = LinearSVC(labelCol="toxic", maxIter=20).fit(df)
    margins = model.transform(df).select("toxic", vector_to_array("rawPrediction")[1].alias("score"))
    plain = score_labels(df, {"toxic": model}, "doc_id")
    assert plain.where("probability is not null").count() == 0
    out = score_labels(df, {"toxic": model, "other": None}, "doc_id", calibrations={"toxic": fit_calibration(margins, "toxic")})
    assert out.columns == plain.columns == ["doc_id", "label", "prediction", "probability"]
    got = out.where("label = 'toxic'").join(df.select("doc_id", "toxic"), "doc_id").collect()
    assert len(got) == 120 and all(0 <= x.probability <= 1 for x in got)
    assert sum(x.probability for x in got) == pytest.approx(sum(x.toxic for x in got))  # calibrated in all
    assert out.where("label = 'other' and probability is null").count() == 120

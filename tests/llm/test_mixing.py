import re
from collections import defaultdict

import pytest

from toxiscope.llm import mixing
from toxiscope.llm.common import count_words

from pyspark.sql import functions as F


def brute_targets(sizes):
    """Water-filling by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = dict(zip(order, [5, 2, 1] * len(order)))
    target = dict.fromkeys(order, 0.0)
    left, open_ = 1.5 * sum(sizes.values()), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share, left = left, 0.0
        for s in list(open_):
            target[s] += share * weight[s] / total
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def mixed(docs):
    slim = docs.withColumn("_n", count_words(F.col("text")))
    targets = mixing.source_targets(slim, size="_n")
    return targets, mixing.mix(docs, targets)


def test_targets_and_copies(documents):
    targets, out = mixed(documents)
    sizes = defaultdict(int)
    for r in documents.collect():
        sizes[r.source] += words(r.text)
    want = brute_targets(sizes)
    got = {r.source: r for r in targets.collect()}
    assert set(got) == set(want)
    for s, r in got.items():
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s])
    once = sorted((r.doc_id, r.text) for r in out.collect())
    assert once == sorted((r.doc_id, r.text) for r in mixed(documents)[1].collect())
    assert out.columns == documents.columns
    n = defaultdict(int)
    for doc_id, _ in once:
        n[doc_id] += 1
    for r in documents.collect():
        rate = want[r.source] / sizes[r.source]
        assert n[r.doc_id] in (int(rate + 1e-9), int(rate + 1e-9) + 1) and n[r.doc_id] <= 2


def test_messy_rows(messy):
    targets, out = mixed(messy)
    got = {r.source: r.target for r in targets.collect()}
    sizes = defaultdict(int)
    for r in messy.collect():
        sizes[r.source] += words(r.text)
    assert got == pytest.approx(brute_targets(sizes))
    assert None in got and out.columns == messy.columns
    assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in messy.collect()}


def test_empty(no_docs):
    targets, out = mixed(no_docs)
    assert targets.count() == 0 and out.count() == 0 and out.columns == no_docs.columns


def test_salted_join_gives_the_same_rows(messy, monkeypatch):
    wide = sorted(map(str, mixed(messy)[1].collect()))
    monkeypatch.setattr(mixing, "broadcast_bounded", lambda df, *a: df)
    assert sorted(map(str, mixed(messy)[1].collect())) == wide


def test_main_path_has_no_python(documents):
    plan = mixed(documents)[1]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_helper_names_may_be_taken(spark):
    rows = [(i, "a b c", "s", 1, 2) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _mix_source int, _mix_slot int")
    sizes = df.groupBy("source").agg(F.lit(18).cast("long").alias("size"))
    out = mixing.mix(df, mixing.source_targets(sizes))
    assert out.columns == df.columns and out.count() >= 6

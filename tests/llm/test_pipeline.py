import re
from collections import Counter

import corpus_pipeline as P

from pyspark.sql import functions as F

from toxiscope.llm import langid, mixing, simhash
from toxiscope.llm.common import stored

from . import test_linededup, test_mixing, test_simhash


def test_stages_against_brute_force(spark, documents):
    d = "/root/testdata/sf0.001"
    docs = documents
    first = stored(P.STAGES[0][1](spark, docs, d), "t")
    kept = {r.doc_id for r in first.collect()}
    assert first.columns == docs.columns
    assert all(not re.search(r"[^\W\d_]", r.text or "") for r in docs.collect() if r.doc_id not in kept) or len(kept) > 0.95 * docs.count()

    second = stored(P.STAGES[1][1](spark, first, d), "t")
    rows = sorted((r.doc_id, r.text) for r in first.collect())
    want = [(i, t) for (i, _), t in zip(rows, test_linededup.brute(rows)) if test_mixing.words(t)]
    assert sorted((r.doc_id, r.text) for r in second.collect()) == want

    third = stored(P.STAGES[2][1](spark, second, d), "t")
    fps = [(i, test_simhash.brute_fp(t)) for i, t in want]
    comp = test_simhash.brute_components(fps)
    assert sorted(r.doc_id for r in third.collect()) == sorted(set(comp))

    fourth = stored(P.STAGES[3][1](spark, third, d), "t")
    sizes = Counter()
    for r in third.collect():
        sizes[r.source] += test_mixing.words(r.text)
    target = test_mixing.brute_targets(dict(sizes))
    n = Counter(r.doc_id for r in fourth.collect())
    for r in third.collect():
        rate = target[r.source] / sizes[r.source]
        assert int(rate + 1e-9) <= n[r.doc_id] <= int(rate + 1e-9) + 1

    last = P.STAGES[4][1](spark, fourth, d).collect()
    starts = Counter(r.doc_id for r in last if r.start == 0)
    assert starts == n


def test_run_returns_packed_pieces(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def test_messy_and_empty(spark, messy, no_docs):
    for docs in (messy, no_docs):
        now = docs
        for name, stage in P.STAGES:
            now = stored(stage(spark, now, ""), "t")
            assert name == "packing" or now.columns == docs.columns
        if docs is no_docs:
            assert now.count() == 0

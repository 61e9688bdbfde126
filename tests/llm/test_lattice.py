import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from toxiscope.llm import lattice_lm as lm
from toxiscope.llm.common import id_remainder
from toxiscope.llm.queries import op6_lattice


def segmentations(word, pieces, extra):
    s = lm.MARK + word
    for cuts in itertools.product([0, 1], repeat=len(s) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(s)]
        parts = [s[a:b] for a, b in zip(at, at[1:])]
        if all(pieces.ids.get(p, -1) >= 0 or p in extra for p in parts):
            yield parts


def test_forward_sums_all_segmentations_and_counts_match():
    pieces = lm.Pieces([lm.MARK, "▁a", "a", "b", "ab", "ba", "▁ab", "abb"])
    logp = pieces.first_scores()
    for word in ["a", "abba", "xab", "bab"]:
        extra: dict = {}
        ids = lm._lattice([word], pieces, extra)
        score = lm._scores(ids, logp, extra)
        value = lambda p: logp[pieces.ids[p]] if pieces.ids.get(p, -1) >= 0 else logp[list(p.encode())].sum()
        each = {tuple(s): math.exp(sum(map(value, s))) for s in segmentations(word, pieces, extra)}
        total = sum(each.values())
        assert lm.forward(score)[0, -1] == pytest.approx(math.log(total))
        uses = lm.expected_counts(ids, score, pieces.n + len(extra))
        want = Counter()
        for s, p in each.items():
            for x in s:
                want[pieces.ids[x] if pieces.ids.get(x, -1) >= 0 else extra[x]] += p / total
        assert uses == pytest.approx([want.get(i, 0) for i in range(len(uses))])


def words(t):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def brute_base(rows, train):
    c = Counter()
    for r in rows:
        if train(r):
            c.update([*words(r.text), None])
    n, v = sum(c.values()), len(c)
    out = []
    for r in rows:
        toks = [*words(r.text), None]
        out.append((len(toks), sum(c[t] > 0 for t in toks), n, sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in toks)))
    return out


def crc(i, m):
    import zlib

    return zlib.crc32(b"" if i is None else str(i).encode()) % m


@pytest.mark.parametrize("hot", [0, 50, 200_000])
def test_base_score_and_counts(spark, messy, documents, monkeypatch, hot):
    monkeypatch.setattr(lm.frequent_words, "__defaults__", (hot, lm.HOT_BYTES))
    docs = documents.limit(40).select("doc_id", "text", "lang").unionByName(messy.select("doc_id", "text", "lang"))
    rows = docs.collect()
    docs = spark.createDataFrame(rows, docs.schema)
    held = id_remainder(F.col("doc_id"), 5) == 1
    got = lm.score_documents(docs, ~held, {"doc_id": F.col("doc_id"), "held_out": held}, group="lang", rounds=1).collect()
    want = brute_base(rows, lambda r: crc(r.doc_id, 5) != 1)
    key = lambda r: (str(r[0]), r[1], round(r[4], 6))
    a = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    b = sorted(((r.doc_id, *w) for r, w in zip(rows, want)), key=key)
    assert [x[:4] for x in a] == [x[:4] for x in b]
    assert [x[4] for x in a] == pytest.approx([x[4] for x in b])
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_better_than_base_on_held_out_text(spark):
    got = op6_lattice(spark, "/root/testdata/sf0.01").agg(
        F.sum(F.when(~F.col("held_out"), F.col("score"))).alias("s"), F.sum(F.when(~F.col("held_out"), F.col("base_score"))).alias("b"),
        F.sum(F.when(F.col("held_out"), F.col("score"))).alias("hs"), F.sum(F.when(F.col("held_out"), F.col("base_score"))).alias("hb"),
    ).first()
    assert got.s > got.b and got.hs > 1.03 * got.hb


def test_word_probabilities_sum_to_one_at_most(spark):
    pieces = lm.Pieces([lm.MARK, "▁a", "a", "b", "▁ab"])
    p = np.full(pieces.n, 1e-12)
    for name, v in {lm.MARK: 0.1, "▁a": 0.2, "a": 0.3, "b": 0.2, "▁ab": 0.2}.items():
        p[pieces.ids[name]] = v
    logp, total = np.log(p / p.sum()), 0.0
    for n in range(0, 12):
        for w in itertools.product("ab", repeat=n):
            extra: dict = {}
            total += math.exp(lm.forward(lm._scores(lm._lattice(["".join(w)], pieces, extra), logp, extra))[0, -1])
    assert 0.95 < total <= 1.0 + 1e-9


def test_no_training_and_empty(messy, no_docs):
    got = lm.score_documents(messy, F.lit(False), {"doc_id": F.col("doc_id")}).collect()
    assert len(got) == messy.count() and all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in got)
    assert lm.score_documents(no_docs, F.lit(True), {"doc_id": F.col("doc_id")}).count() == 0

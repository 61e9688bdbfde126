import re
from collections import defaultdict

import pytest

from toxiscope.llm import linededup


def brute(rows, min_words=5):
    """rows: (order, text) → text after deletion; every window with enough words that came before goes."""
    seqs = []
    for _, text in rows:
        lines = text.split("\n")
        seqs.append([(i, x, len(re.findall(r"[^\x20\x09-\x0D]+", x))) for i, x in enumerate(lines)])
    seqs = [[t for t in s if t[2]] for s in seqs]
    seen, out = set(), []
    for (_, text), s in zip(rows, seqs):
        gone = set()
        for a in range(len(s)):
            for b in range(a + 1, min(len(s), a + 40) + 1):
                if sum(t[2] for t in s[a:b]) < min_words:
                    continue
                name = tuple(t[1] for t in s[a:b])
                if name in seen:
                    gone |= {t[0] for t in s[a:b]}
                seen.add(name)
        out.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
    return out


def check(docs, min_words=5):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    known = sorted([r for r in rows if r[1] is not None], key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = sorted(map(str, zip([r[0] for r in known], brute(known, min_words))))
    got = linededup.dedup_lines(docs, min_words=min_words)
    assert got.columns == docs.columns
    rows = got.collect()
    assert sorted(str((r.doc_id, r.text)) for r in rows if r.text is not None) == want
    assert sum(r.text is None for r in rows) == docs.where("text is null").count()


@pytest.mark.parametrize("min_words", [1, 5, 9])
def test_small_vocabulary(spark, min_words):
    import random

    rng = random.Random(min_words)
    line = ["a", "b c", "d e f", "", "g h i j k l", "  ", "a"]
    rows = [(i, "\n".join(rng.choice(line) for _ in range(rng.randrange(0, 14)))) for i in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), min_words)


def test_messy_and_empty(messy, no_docs):
    check(messy.where("doc_id is null or doc_id <> 5"))
    assert linededup.dedup_lines(no_docs).count() == 0
    kept = linededup.dedup_lines(messy, drop_emptied=True, removed="gone")
    assert kept.columns == [*messy.columns, "gone"]
    assert kept.where("doc_id = 4").count() == 1  # was empty before


def test_ranks_are_suffix_array_intervals(spark):
    seqs = {0: "abcabcab", 1: "bcabx", 2: "abcabcab"}
    rows = [(r, i, c) for r, s in seqs.items() for i, c in enumerate(s)]
    lines = spark.createDataFrame(rows, "row long, pos int, line string")
    ranks = linededup.first_ranks(lines)
    for h in (1, 2, 4):
        got = defaultdict(set)
        order = {}
        for r in ranks.collect():
            prefix = seqs[r.row][r.pos : r.pos + h]
            got[prefix].add((r.row, r.pos))
            order[prefix] = r["rank"]
        want = defaultdict(set)
        for r, s in seqs.items():
            for i in range(len(s) - h + 1):
                want[s[i : i + h]].add((r, i))
        assert got == {k: v for k, v in want.items() if len(v) > 1}
        assert sorted(order, key=order.get) == sorted(order)
        ranks = linededup.double_ranks(ranks, h)

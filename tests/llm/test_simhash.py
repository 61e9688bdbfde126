import random

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from toxiscope.llm import simhash


def brute_fp(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(pairs, radius=3):
    """pairs: (id, fp) → least id per position."""
    label = list(range(len(pairs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [least.get(root(i)) for i in range(len(pairs))]


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    fps = [brute_fp(r.text) for r in rows]
    comp = brute_components([(r.doc_id, f) for r, f in zip(rows, fps)])
    want = sorted(map(str, zip([r.doc_id for r in rows], fps, comp)))
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(map(str, got)) == want


def test_matches_brute_force(documents):
    check(documents)


def test_messy_and_empty(messy, no_docs):
    check(messy)
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.one_of_each(messy)
    assert kept.columns == messy.columns
    groups = {r.component_id for r in simhash.near_duplicates(messy.where("doc_id is not null")).collect()}
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} >= groups
    assert simhash.one_of_each(no_docs).count() == 0


def test_masks_cover_every_pair_in_the_radius():
    rng = random.Random(1)
    for level in simhash.mask_tree(levels=2):
        for parent, masks in list(level.items())[:4]:
            free = [b for b in range(64) if not parent >> b & 1]
            for _ in range(300):
                diff = sum(1 << b for b in rng.sample(free, min(3, len(free))))
                assert any(diff & m == 0 for m in masks)


def test_large_buckets_are_split_and_lose_nothing(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < 700:
        fps.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(20)))
    fps |= {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    signed = [simhash._signed(f) for f in fps]
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "id long, fp long")
    links = simhash.close_links(rows.select("fp"), split=50)
    assert links.count() < 60 * len(fps)
    from toxiscope.llm.components import connected_components

    node = {r.node: r.component for r in connected_components(links).collect()}
    got = {}
    for i, f in enumerate(signed):
        got.setdefault(node.get(f, f), []).append(i)
    want = {}
    for i, c in enumerate(brute_components(list(enumerate(fps)))):
        want.setdefault(c, []).append(i)
    assert sorted(got.values()) == sorted(want.values())


def test_components_of_a_chain(spark):
    from toxiscope.llm.components import connected_components

    n = 40
    rows = [(i + 1, i) for i in range(n)] + [(100, 101), (100, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(rows, "src long, dst long")).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 100: 100, 101: 100}

import zlib
from collections import defaultdict

import numpy as np
import pytest

from toxiscope.llm import packing


@pytest.fixture(scope="module")
def exact():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(docs, exact, padding):
    out = packing.pack(docs).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        ids = [*exact.encode(r.text or "", add_special_tokens=False).ids, 1]
        texts[r.doc_id].append(ids)
    pieces = defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(texts)
    for doc_id, many in texts.items():
        want = sorted(
            (i, min(2048, len(ids) - i), zlib.crc32(np.array(ids[i : i + 2048], "<u4").tobytes()), len(ids))
            for ids in many for i in range(0, len(ids), 2048)
        )
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[doc_id]) == want
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r.length for r in out)
    assert len(sequences) * 2048 <= used * (1 + padding) + 2048
    assert used == sum(len(i) for m in texts.values() for i in m)


def test_round_trip(documents, exact):
    check(documents, exact, 0.02)


def test_messy_and_empty(messy, no_docs, exact):
    check(messy, exact, 0.1)
    assert packing.pack(no_docs).count() == 0


def test_both_vocabulary_forms_agree(documents, exact):
    encode = packing._encoder(*packing.tokenizer_paths())
    texts = [r.text for r in documents.collect()] + ["a<|endoftext|>b", "漢字 éè", "it's  \n\n x y 12³½", "", "ǅ ʰ"]
    for t in texts:
        assert encode(t) == np.array(exact.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_column_generation_is_near_the_bound():
    rng = np.random.default_rng(0)
    sizes, demand = np.unique(rng.integers(1, 64, 5000), return_counts=True)
    ranges, n = packing.plan_sequences(sizes.tolist(), demand.tolist(), 64)
    assert n <= np.ceil((sizes * demand).sum() / 64) * 1.01 + 2
    fill = defaultdict(int)
    by_class = defaultdict(list)
    for c, first, per, seq in ranges:
        by_class[c].append((first, per, seq))
    for c, total in zip(sizes.tolist(), demand.tolist()):
        own = sorted(by_class[c])
        assert own[0][0] == 0
        for (first, per, seq), end in zip(own, [f for f, _, _ in own[1:]] + [total]):
            for rank in range(first, end):
                fill[seq + (rank - first) // per] += c
    assert len(fill) == n and max(fill.values()) <= 64


def test_pattern_price_is_the_best_knapsack():
    values, sizes = np.array([0.3, 0.45, 0.9]), np.array([3, 4, 8])
    best, counts = packing.price_pattern(values, sizes, 16)
    assert best == pytest.approx(1.8) and counts @ sizes <= 16 and counts @ values == pytest.approx(best)

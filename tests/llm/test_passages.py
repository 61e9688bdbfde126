import random

import pytest

from pyspark.sql import functions as F

from toxiscope.llm import passages
from toxiscope.llm.components import connected_components


def text_of(rng, n):
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n)]
    return " ".join(words)


def paragraphs_of(rng):
    """Families of near copies, some near each other in chains."""
    out = []
    for _ in range(30):
        base = text_of(rng, rng.randrange(10, 60)).split()
        out.append(" ".join(base))
        for _ in range(rng.randrange(0, 9)):
            base = list(base)
            base[rng.randrange(len(base))] = text_of(rng, 1)
            out.append(" ".join(base))
    return sorted(set(out))


def brute_components(bodies, threshold=0.8):
    sets = [passages.shingle_set(b) for b in bodies]
    label = list(range(len(bodies)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(bodies)):
        for j in range(i):
            if passages.jaccard(sets[i], sets[j]) >= threshold:
                label[root(i)] = root(j)
    groups = {}
    for i in range(len(bodies)):
        groups.setdefault(root(i), set()).add(i)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("block", [256, 3])
def test_components_equal_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK", block)
    bodies = paragraphs_of(random.Random(4))
    table = spark.createDataFrame([(i, 1 + i % 3, b) for i, b in enumerate(bodies)], "uid long, n long, body string")
    links = passages.similar_links(table, 0.8, 0.9999, 2)
    node = {r.node: r.component for r in connected_components(links).collect()}
    groups = {}
    for i in range(len(bodies)):
        groups.setdefault(node.get(i, i), set()).add(i)
    assert sorted(map(sorted, groups.values())) == brute_components(bodies)


def test_bands_reach_the_recall():
    for rows in (2, 3, 4):
        bands = passages.tune_bands(0.8, 0.995, rows)
        assert 1 - (1 - 0.8**rows) ** bands >= 0.995 > 1 - (1 - 0.8**rows) ** (bands - 1)


def sentence(rng, n=14):
    return text_of(rng, n).capitalize() + "."


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(5)
    passage = " ".join(sentence(rng) for _ in range(6))
    near = passage.replace(passage.split()[40], "changed")
    doc = lambda *mid: " ".join([sentence(rng), sentence(rng, 5), *mid, sentence(rng, 6), sentence(rng)])
    rows = [(i, doc()) for i in range(40)]
    rows += [(100, doc(passage)), (101, doc(passage)), (102, doc(near)), (103, passage + "\n" + passage)]
    copy = doc()
    rows += [(200 + i, copy) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_planted_passages_are_found_and_clean_documents_left_alone(planted):
    found = passages.repeated_passages(planted).collect()
    assert {r.doc_id for r in found} == {100, 101, 102, 103, *range(200, 230)}
    text = dict(planted.select("doc_id", "text").collect())
    for r in found:
        span = text[r.doc_id][r.start : r.start + r.length]
        assert len(span.split()) == r.words >= passages.MIN_PASSAGE
    assert {r.doc_id for r in found if not r.removed} == {100, 200}
    left = dict(passages.remove_passages(planted).select("doc_id", "text").collect())
    assert all(left[i] == text[i] for i in (*range(40), 100, 200))
    for r in found:
        if r.removed:
            assert text[r.doc_id][r.start : r.start + r.length] not in left[r.doc_id] and len(left[r.doc_id]) <= len(text[r.doc_id]) - r.length


def test_messy_and_empty(messy, no_docs):
    found = passages.repeated_passages(messy).collect()
    prose = {(r.doc_id, r.removed) for r in found}
    assert (1, False) in prose and (1, True) in prose and (None, True) in prose and (2, True) in prose
    left = passages.remove_passages(messy)
    assert left.columns == messy.columns and left.count() == messy.count()
    assert left.where("text is null").count() == messy.where("text is null").count()
    assert passages.repeated_passages(no_docs).count() == 0
    assert passages.remove_passages(no_docs).count() == 0


def test_stars_cover_runs_across_batches():
    import pyarrow as pa

    rows = [(k, 10 * k + i) for k in range(4) for i in range(3)]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64())], ["key", "uid"])
    for size in (1, 2, 5, 12):
        out = list(passages._stars(batch(rows[i : i + size]) for i in range(0, 12, size)))
        got = [tuple(r.values()) for b in out for r in b.to_pylist()]
        assert got == [(k, 10 * k, 10 * k + i) for k in range(4) for i in (1, 2)]


def test_passages_of_short_sentences_are_found(spark):
    rng = random.Random(8)
    talk = " ".join(sentence(rng, n) for n in (3, 4, 2, 5, 7, 7, 1, 6, 4, 3, 2))
    mixed = " ".join(sentence(rng, n) for n in (7, 7, 7, 17, 2, 14))
    doc = lambda mid: " ".join([sentence(rng), sentence(rng, rng.randrange(1, 8)), mid, sentence(rng, 6), sentence(rng)])
    rows = [(i, doc(sentence(rng, 30))) for i in range(20)]
    rows += [(100, doc(talk)), (101, doc(talk)), (200, doc(mixed)), (201, doc(mixed))]
    rows += [(300, " ".join(["Ha ha."] * 30))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = dict(passages.remove_passages(docs).select("doc_id", "text").collect())
    for i, t in rows:
        if i in (101, 201):
            passage = talk if i == 101 else mixed
            assert left[i].split() == t.replace(passage, "").split()
        elif i != 300:
            assert left[i] == t
    assert left[300].count("Ha ha.") >= 4  # the first paragraph stays whole


def test_words_are_hashed_together_and_as_the_library_does(monkeypatch):
    import xxhash

    rng, one, calls = random.Random(7), xxhash.xxh64_intdigest, []
    words = [bytes(rng.randrange(33, 256) for _ in range(n)) for n in range(1, 70)] * 3
    rng.shuffle(words)
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda *a: calls.append(a) or one(*a))
    for some in (1, 7, 1000):
        assert passages.word_hashes(b" ".join(words), some).tolist() == [one(w) for w in words]
    calls.clear()
    passages.gram_hashes([b"short words only in here", b"two more"])
    assert not calls


def test_shingles_are_hashed_by_their_words():
    import xxhash

    bodies = [b"a b c d e f g", b"x", b"c d e f g", b"y z"]
    found, first = passages.gram_hashes(bodies)
    expected, begins = [], []
    for body in bodies:
        words = body.split(b" ")
        begins.append(len(expected))
        for i in range(max(1, len(words) - 4)):
            h = 1
            for w in words[i : i + 5]:
                h = (h * 0x9E3779B97F4A7C15 + xxhash.xxh64_intdigest(w)) % (1 << 64)
            expected.append(h ^ (h >> 32))
    assert found.tolist() == expected and first.tolist() == begins


def test_paragraphs_are_the_least_runs_of_units():
    rng = random.Random(8)
    sizes = [[rng.randrange(1, 12) for _ in range(rng.randrange(0, 15))] for _ in range(60)]
    texts = ["\n".join(" ".join(f"w{rng.randrange(9)}" for _ in range(n)) for n in text) for text in sizes]
    which, cols, uid, body = passages._cut_batch(texts, 8)
    found = list(zip(which.tolist(), cols["place"].tolist(), cols["last"].tolist()))
    expected = []
    for t, text in enumerate(sizes):
        for i in range(len(text)):
            for j in range(i, len(text)):
                total = sum(text[i : j + 1])
                if total >= 8 and (total - text[j] < 8 or total - text[i] < 8):
                    expected.append((t, i, j))
    assert found == expected
    for k, (t, i, j) in enumerate(expected):
        assert cols["before"][k] == sum(sizes[t][:i]) and cols["words"][k] == sum(sizes[t][i : j + 1])
        long = next((x for x in range(j + 1, len(sizes[t])) if sizes[t][x] >= 8), len(sizes[t]))
        assert cols["reach"][k] == long
        whole = " ".join(texts[t].split("\n")[i : j + 1]).encode()
        exact = i < j and max(sizes[t][i : j + 1]) >= 8
        assert texts[t][cols["start"][k] : cols["end"][k]].split() == whole.decode().split()
        assert body[k] is None if exact else body[k] in (None, whole)
    firsts = [b for b in body if b is not None]
    assert len(firsts) == len(set(firsts)) == len({u for u, (t, i, j) in zip(uid.tolist(), expected) if i == j or max(sizes[t][i : j + 1]) < 8})

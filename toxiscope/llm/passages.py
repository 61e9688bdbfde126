"""Substring deduplication: MinHash banding over short paragraphs, verified and clustered.

Texts are cut at line breaks and sentence ends, which is where a passage that was pasted
into another text keeps its own cuts. A paragraph is a least run of units with ``MIN_UNIT``
words: from each unit the fewest units forward, and to each unit the fewest back. So a unit
of that many words is one, and shorter ones are compared together with their neighbours,
whatever stands before the passage. Equal paragraphs (A-Z lower-cased, blanks collapsed) are grouped first; every
different one gets a MinHash signature of its five-word shingles; only where short units are
joined to a long one, which would pass for them, must paragraphs be equal. The bands are tuned so
that a pair at the threshold collides in some band with probability ``RECALL`` or more.

A bucket's paragraphs are compared with its most frequent one (a star, linear in the
bucket) by exact Jaccard similarity of the shingle sets. Pairs that the stars leave open
(in one bucket, but not yet in one component) are compared in blocks of bounded size, and
only the links of a spanning forest leave a block; so no colliding pair at the threshold
is lost. A bucket of m open rows goes to m / ``BLOCK`` blocks a row. Clusters are connected
components.

A passage is a run of clustered paragraphs that meet (shorter units between them belong to it) of at
least ``MIN_PASSAGE`` words. The first occurrence of each cluster in the order of documents
(id, null last; rows with one id in stored order; position) stays, the later ones
that do not overlap it are marked for removal.

Defined results: a null or empty text has no paragraph; texts of any length are cut whole;
repeated rows are later copies; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toxiscope.llm.common import drop_stored, free_name, spread_rows, stored, stored_tight
from toxiscope.llm.components import connected_components

#: Production parameters.
SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.995
BAND_ROWS = 3
MIN_UNIT = 8
MIN_PASSAGE = 20
BLOCK = 256
WAVE = 4
SEED = 8

#: White space after a sentence's end (matched with it), or line breaks; the alternatives begin
#: with letters, not classes, so that the search skips all other characters quickly.
BREAK = re.compile(r"\n\n*|\.\s+|!\s+|\?\s+")


def tune_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """Fewest bands of ``rows`` hashes that catch a pair at the threshold with ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


def units(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end (code points) of the units between breaks."""
    begin = 0
    for m in BREAK.finditer(text):
        first, last = m.span()
        yield begin, first + (text[first] != "\n")
        begin = last
    yield begin, len(text)


def shingle_set(body: str, n: int = SHINGLE) -> set[str]:
    words = body.split(" ")
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jaccard(a: set, b: set) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def paragraphs_of(upto: np.ndarray, base: np.ndarray, stop: np.ndarray, min_unit: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last unit of every paragraph of some texts, in order; ``upto`` counts the words before
    each unit (and in all), ``base`` and ``stop`` are the first unit and the end of each unit's text."""
    n = len(base)
    ahead = np.searchsorted(upto, upto[:-1] + min_unit) - 1  # the fewest units forward
    back = np.searchsorted(upto, upto[1:] - min_unit, side="right") - 1  # the fewest units back
    a, b = np.flatnonzero(ahead < stop), np.flatnonzero(back >= base)
    found = np.unique(np.concatenate([a * n + ahead[a], back[b] * n + b]))
    return found // max(n, 1), found % max(n, 1)


def _cut_batch(texts: list, min_unit: int) -> tuple[np.ndarray, dict[str, np.ndarray], np.ndarray, list]:
    """The paragraphs of some texts: text number, columns, uids, and the first body of each uid."""
    import xxhash

    begin, end, pieces, counts = [], [], [], []  # of every unit, and the units of every text
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass").lower()  # A-Z only
        low = raw.decode("utf-8", "surrogatepass")
        plain, before = len(raw) == len(low), len(pieces)
        for x, y in units(low):
            got = (raw[x:y] if plain else low[x:y].encode("utf-8", "surrogatepass")).split()
            if got:
                begin.append(x)
                end.append(y)
                pieces.append(b" ".join(got))
        counts.append(len(pieces) - before)
    n, whole, counts = len(pieces), b" ".join(pieces), np.array(counts, np.int64)
    at = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, n) + 1)])  # where each begins in it
    size = np.fromiter((u.count(b" ") + 1 for u in pieces), np.int64, n)
    upto = np.concatenate([[0], np.cumsum(size)])
    stop = np.repeat(np.cumsum(counts), counts)  # the end of each unit's text
    base = stop - np.repeat(counts, counts)
    p, q = paragraphs_of(upto, base, stop, min_unit)
    reach = np.append(np.where(size >= min_unit, np.arange(n), n), n)  # the next unit of that size
    reach = np.minimum.accumulate(reach[::-1])[::-1]
    exact = (p < q) & (reach[p] <= q)
    spans = np.stack([at[p], at[q + 1] - 1], axis=1).tolist()
    uid = np.fromiter((xxhash.xxh64_intdigest(whole[x:y], SEED) for x, y in spans), np.uint64, len(spans))
    loose = np.flatnonzero(~exact)
    held = np.zeros(len(spans), bool)
    held[loose[np.unique(uid[loose], return_index=True)[1]]] = True
    body = [whole[x:y] if k else None for (x, y), k in zip(spans, held.tolist())]
    begin, end = np.array(begin, np.int64), np.array(end, np.int64)
    cols = {
        "place": p - base[p], "last": q - base[q], "reach": np.minimum(reach[q + 1], stop[q]) - base[q],
        "start": begin[p], "end": end[q], "before": upto[p] - upto[base[p]], "words": upto[q + 1] - upto[p],
    }
    return np.repeat(np.arange(len(texts), dtype=np.int32), counts)[p], cols, uid, body


def cut_units(docs: DataFrame, key: str, text: str, row: str | None, min_unit: int) -> DataFrame:
    """``(row, id, place, last, reach, start, end, before, words, uid, body)`` of the paragraphs.

    ``place`` and ``last`` are the first and the last unit, ``reach`` the next unit of ``min_unit``
    words (only shorter ones lie between), ``before`` the words of the document up to here;
    ``body`` is null where short units are joined to a long one, and where a paragraph of the same
    batch holds it.
    """
    ident = F.col(row) if row else F.monotonically_increasing_id()
    slim = spread_rows(docs.select(F.col(key).alias("id"), F.col(text).alias("text"), *([F.col(row)] if row else [])))
    slim = slim.select(ident.alias("row"), "id", "text")
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for first in range(0, big.num_rows, 512):
                b = big.slice(first, 512)
                which, cols, uid, body = _cut_batch([t.as_py() or "" for t in b.column(2)], min_unit)
                kept = [c.take(pa.array(which)) for c in b.columns[:2]]
                data = [pa.array(c if n == "before" else c.astype(np.int32)) for n, c in cols.items()]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *data, pa.array(uid.view(np.int64)),
                     pa.array(body, pa.binary()).cast(pa.string())],
                    ["row", "id", *cols, "uid", "body"],
                )

    schema = (
        f"row long, id {id_type}, place int, last int, reach int, start int, end int, before long, words int, "
        "uid long, body string"
    )
    return slim.mapInArrow(run, schema)


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def word_hashes(text: bytes, some: int = 1 << 16) -> np.ndarray:
    """XXH64 of each word between single blanks, of ``some`` words at a time (a call for each word
    took most of the time of the signatures); long words by the library."""
    import xxhash

    raw = np.frombuffer(text + b" " * 8, np.uint8)
    begins = np.concatenate([[0], np.flatnonzero(raw[: len(text) + 1] == 32) + 1])
    lanes, halves = (np.ndarray(len(raw) - 7, t, raw, 0, (1,)) for t in ("<u8", "<u4"))  # from every byte on
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5,
    ))
    out = np.empty(len(begins) - 1, np.uint64)
    with np.errstate(over="ignore"):
        for first in range(0, len(out), some):
            here = begins[first : first + some + 1]
            at, length = here[:-1].copy(), np.diff(here) - 1
            h = length.astype(np.uint64) + p5
            for k in range(3):
                i = np.flatnonzero((length < 32) & (length >= 8 * (k + 1)))
                h[i] = _turned(h[i] ^ (_turned(lanes[at[i]] * p2, 31) * p1), 27) * p1 + p4
                at[i] += 8
            i = np.flatnonzero(length % 8 >= 4)
            h[i] = _turned(h[i] ^ (halves[at[i]].astype(np.uint64) * p1), 23) * p2 + p3
            at[i] += 4
            for k in range(3):
                i = np.flatnonzero(length % 4 > k)
                h[i] = _turned(h[i] ^ (raw[at[i]].astype(np.uint64) * p5), 11) * p1
                at[i] += 1
            h = (h ^ (h >> np.uint64(33))) * p2
            h = (h ^ (h >> np.uint64(29))) * p3
            h ^= h >> np.uint64(32)
            for i in np.flatnonzero(length >= 32):
                h[i] = xxhash.xxh64_intdigest(text[here[i] : here[i + 1] - 1])
            out[first : first + some] = h
    return out


def gram_hashes(bodies: list[bytes], shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all bodies in a row (word hashes combined), and where each body's begin."""
    words = word_hashes(b" ".join(bodies))
    n = len(words)
    sizes = np.array([body.count(b" ") + 1 for body in bodies], np.int64)
    begins = np.cumsum(sizes) - sizes
    grams = np.maximum(sizes - shingle + 1, 1)
    first = np.cumsum(grams) - grams
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        words = np.append(words, np.zeros(shingle, np.uint64))
        x = np.ones(n, np.uint64)  # of the words from each place on
        for k in range(shingle):
            x *= factor
            x += words[k : k + n]
        # a body's last places begin no shingle of its own
        x = x[np.arange(grams.sum()) + np.repeat(begins - first, grams)]
        for i in np.flatnonzero(sizes < shingle):
            y = np.ones(1, np.uint64)
            for w in words[begins[i] : begins[i] + sizes[i]]:
                y = y * factor + w
            x[first[i]] = y[0]
        x ^= x >> np.uint64(32)
    return x, first


def band_keys(bodies: list[bytes], bands: int, rows: int, shingle: int = SHINGLE, some: range | None = None) -> np.ndarray:
    """One 64-bit key per band (of ``some``) of each body; equal minima give equal keys."""
    x, first = gram_hashes(bodies, shingle)
    rng = np.random.default_rng(SEED)
    a = rng.integers(1, 1 << 63, bands * rows, np.uint64) | np.uint64(1)
    b = rng.integers(0, 1 << 63, bands * rows, np.uint64)
    some = range(bands) if some is None else some
    keys = np.zeros((len(bodies), len(some)), np.uint64)
    with np.errstate(over="ignore"):
        for k, band in enumerate(some):
            for j in range(band * rows, (band + 1) * rows):
                y = x * a[j] + b[j]
                y ^= y >> np.uint64(29)
                low = np.minimum.reduceat(y, first)
                keys[:, k] = (keys[:, k] + low + np.uint64(band + 1)) * np.uint64(0x9E3779B97F4A7C15)
                keys[:, k] ^= keys[:, k] >> np.uint64(31)
    return keys.view(np.int64)


def _bands_of(paragraphs: DataFrame, bands: int, rows: int, some: range) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for first in range(0, big.num_rows, 4096):
                b = big.slice(first, 4096)
                keys = band_keys(b.column(2).cast(pa.binary()).to_pylist(), bands, rows, some=some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(b.column(0).to_numpy(), len(some))),
                     pa.array(np.repeat(b.column(1).to_numpy(), len(some)))], ["key", "uid", "n"],
                )

    return paragraphs.select("uid", "n", "body").mapInArrow(run, "key long, uid long, n long")


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key, most frequent first → (key, centre, uid) of the rows after the first."""
    last_key, centre = None, None
    for b in batches:
        if not b.num_rows:
            continue
        key, uid = b.column(0).to_numpy(), b.column(1).to_numpy()
        new = np.append(key[0] != last_key if last_key is not None else True, key[1:] != key[:-1])
        begin = np.where(new, np.arange(len(key)), -1)
        np.maximum.accumulate(begin, out=begin)
        mid = np.where(begin >= 0, uid[np.maximum(begin, 0)], 0 if centre is None else centre)
        last_key, centre = key[-1], mid[-1]
        rest = ~new
        yield pa.RecordBatch.from_arrays([pa.array(key[rest]), pa.array(mid[rest]), pa.array(uid[rest])], ["key", "centre", "uid"])


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            good = [
                jaccard(shingle_set(x.as_py()), shingle_set(y.as_py())) >= threshold
                for x, y in zip(b.column(2), b.column(3))
            ]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in b.columns[:2]], ["src", "dst"])

    return run


def block_links(uids: list, labels: list, bodies: list[str], threshold: float) -> list[tuple]:
    """Spanning-forest links of the pairs of different labels at or above the threshold."""
    if len(set(labels)) < 2:
        return []
    held: dict[str, list[int]] = {}
    size = np.zeros(len(uids))
    for i, body in enumerate(bodies):
        grams = shingle_set(body)
        size[i] = len(grams)
        for g in grams:
            held.setdefault(g, []).append(i)
    shared = [rows for rows in held.values() if len(rows) > 1]
    both = np.zeros((len(uids), len(uids)), np.float32)
    for first in range(0, len(shared), 4096):  # whole numbers, exact; memory bounded by the block
        part = shared[first : first + 4096]
        m = np.zeros((len(uids), len(part)), np.float32)
        for k, rows in enumerate(part):
            m[rows, k] = 1
        both += m @ m.T
    union = size[:, None] + size - both
    near = both >= threshold * union.astype(float) - 1e-6
    group = {v: v for v in labels}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v

    out = []
    for i, j in zip(*np.nonzero(np.triu(near, 1))):
        a, b = root(labels[i]), root(labels[j])
        if a != b and float(both[i, j]) / float(union[i, j]) >= threshold:
            group[max(a, b)] = min(a, b)
            out.append((uids[i], uids[j]))
    return out


def _open_pairs(threshold: float):
    """Rows sorted by (key, i, j) → links; a group is at most two blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, {}

        def out():
            got = block_links(list(rows), [v[0] for v in rows.values()], [v[1] for v in rows.values()], threshold)
            return pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())], ["src", "dst"]
            )

        for b in batches:
            for key, i, j, uid, label, body in zip(*[c.to_pylist() for c in b.columns]):
                if (key, i, j) != at:
                    if len(rows) > 1:
                        yield out()
                    at, rows = (key, i, j), {}
                rows[uid] = (label, body)
        if len(rows) > 1:
            yield out()

    return run


def similar_links(paragraphs: DataFrame, threshold: float, recall: float, rows: int) -> DataFrame:
    """Links ``(src, dst)`` whose components are those of all colliding pairs at the threshold.

    ``paragraphs``: a stored table ``(uid, n, body)``, one row per different paragraph.
    """
    bands = tune_bands(threshold, recall, rows)
    # the bands go in waves, so that only a part of their rows lies in shuffle files at once
    star, waves = None, []
    for at in range(0, bands, WAVE):
        keyed = _bands_of(paragraphs, bands, rows, range(at, min(at + WAVE, bands)))
        waves.append(stored_tight(
            keyed.repartition("key").sortWithinPartitions("key", F.desc("n"), "uid").select("key", "uid")
            .mapInArrow(_stars, "key long, centre long, uid long"),
            "passage-stars",
        ))
        star = waves[-1] if star is None else star.unionByName(waves[-1])
    # the bodies that any comparison needs, fetched once: the joins below move these alone
    met = star.select("uid").unionByName(star.select(F.col("centre").alias("uid"))).distinct()
    body = stored_tight(paragraphs.select("uid", "body").join(met, "uid", "left_semi"), "passage-bodies")
    asked = star.select("centre", "uid").distinct()
    with_body = asked.join(body.withColumnsRenamed({"uid": "centre", "body": "x"}), "centre").join(body, "uid")
    first = stored_tight(
        with_body.select("centre", "uid", "x", "body").mapInArrow(_verified(threshold), "src long, dst long"), "passage-links"
    )
    part = stored(connected_components(first), "passage-parts")
    label = lambda c: part.select(F.col("node").alias(c), F.col("component").alias(f"{c}_label"))
    # every row is compared with its bucket's centre, so only pairs of the others can be open, and
    # of these only pairs of two components: a bucket of two rows or of one component is settled
    left = stored_tight(
        star.join(label("uid"), "uid", "left").select("key", "uid", F.coalesce("uid_label", "uid").alias("label")),
        "passage-open",
    )
    sizes = left.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi")
    ).where("lo < hi").select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = left.join(sizes, "key").withColumn("mine", mine).withColumn("other", other).select(
        "key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "uid", "label"
    )
    second = (
        dealt.join(body, "uid").select("key", "i", "j", "uid", "label", "body")
        .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        .mapInArrow(_open_pairs(threshold), "src long, dst long")
    )
    second = stored_tight(second, "passage-open-links")
    for table in (*waves, body, part, left):
        drop_stored(table)
    return first.unionByName(second)


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL,
    band_rows: int = BAND_ROWS, min_unit: int = MIN_UNIT, min_passage: int = MIN_PASSAGE, row: str | None = None,
) -> DataFrame:
    """``(row, key, start, length, words, n_units, cluster_id, removed)``, one row per passage.

    ``start`` and ``length`` are code points; ``cluster_id`` is the cluster of the passage's
    first paragraph; ``removed`` is false where the passage is the first occurrence.
    """
    cut = stored_tight(cut_units(docs, key, text, row, min_unit), "passage-units")
    paragraphs = stored_tight(
        cut.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.min("body").alias("body"))
        .where("n > 1 or body is not null"), "passage-texts",
    )
    links = similar_links(paragraphs.where("body is not null"), threshold, recall, band_rows)
    part = stored(connected_components(links), "passage-clusters")
    # stored, so that the next join knows its size and can split a paragraph that many documents share
    cluster = stored_tight(
        paragraphs.select("uid", "n").join(part.withColumnRenamed("node", "uid"), "uid", "left")
        .where("n > 1 or component is not null")
        .select("uid", F.coalesce("component", "uid").alias("cluster")), "passage-members",
    )
    for table in (links, part, paragraphs):
        drop_stored(table)
    found = stored_tight(cut.drop("body").join(cluster, "uid"), "passage-found")
    for table in (cut, cluster):
        drop_stored(table)
    place = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"), F.col("place"), F.col("last"))
    # stored, so that the join shuffles both sides and can split a hot cluster
    first = stored_tight(found.groupBy("cluster").agg(F.min(place).alias("first")), "passage-first")
    marked = found.join(first, "cluster").withColumn(
        "removed", (F.col("row") != F.col("first.row")) | (F.col("place") > F.col("first.last"))
    ).drop("first", "uid")
    # runs of paragraphs with one mark that meet or have only shorter units between them
    w = Window.partitionBy("row", "removed").orderBy("place", "last")
    far = F.max("reach").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = marked.withColumn("new", F.coalesce((F.col("place") > far).cast("int"), F.lit(1)))
    runs = runs.withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    order = F.shiftleft(F.col("place").cast("long"), 32) + F.col("last")  # a number, so that the groups are hashed
    spans = runs.groupBy("row", "removed", "run").agg(
        F.min("id").alias(key), F.min("start").alias("start"), F.max("end").alias("end"),
        (F.max(F.col("before") + F.col("words")) - F.min("before")).cast("long").alias("words"),
        F.count(F.lit(1)).alias("n_units"), F.min_by("cluster", order).alias("cluster_id"),
    )
    return spans.where(F.col("words") >= min_passage).select(
        "row", key, "start", (F.col("end") - F.col("start")).alias("length"), "words", "n_units", "cluster_id", "removed"
    )


def remove_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, all but their first occurrences."""
    row, spans = free_name(docs, "_passage_row"), free_name(docs, "_passage_spans")
    columns = docs.columns
    docs = stored(spread_rows(docs).withColumn(row, F.monotonically_increasing_id()), "passage-documents")
    found = repeated_passages(docs, key, text, row=row, **options).where("removed")
    gone = found.groupBy(F.col("row").alias(row)).agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias(spans)
    )
    return docs.join(gone, row, "left").withColumn(text, _without(F.col(text), F.col(spans))).select(*columns)


def _without(text: Column, spans: Column) -> Column:
    """The text without the spans (ascending, apart)."""
    state = F.struct(F.lit("").alias("kept"), F.lit(1).alias("at"))
    step = F.aggregate(
        spans, state,
        lambda a, s: F.struct(
            F.concat(a["kept"], F.substring(text, a["at"], s["start"] + 1 - a["at"])).alias("kept"),
            (s["start"] + s["length"] + 1).cast("int").alias("at"),
        ),
    )
    return F.when(spans.isNull(), text).otherwise(F.concat(step["kept"], F.substring(text, step["at"], F.length(text))))

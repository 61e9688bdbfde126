"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's 64-bit fingerprint is the bitwise majority over the hashes of its word
shingles. Two fingerprints link when they differ in at most ``radius`` bits. The search
uses a covering family of masks: every bit position gets a vector of ``radius + 1`` bits,
and the mask of each non-zero vector v holds the positions whose vector has an odd
product with v. The positions where two fingerprints differ span at most ``radius``
dimensions, so some v is orthogonal to all of them: under that mask the two agree. Every
pair within the radius therefore meets in at least one of the 2^(radius+1) - 1 tables.

Equal fingerprints are grouped first. A bucket with few different fingerprints is
compared in one task; only the links of a spanning forest leave it, so nothing
quadratic is written. A larger bucket is split by a second covering family over the bits
its mask left out, and again by a third, each of which still covers every close pair;
after three levels fewer than ``radius + 10`` free bits are left, which bounds a bucket
whatever the data.

Defined results: a null or empty text has fingerprint 0 and links like any other; fewer
words than the shingle length make one shingle of the whole sequence; repeated rows
share fingerprint and component; a component's id is its smallest document id (null when
all its ids are null); an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import free_name, spread_rows, stored
from toxiscope.llm.components import connected_components

#: Production parameters of the registered query (fixed by its contract).
SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
#: Buckets with more different fingerprints than this are split by the next level's masks.
BUCKET_SPLIT = 256


def fingerprint_bytes(text: bytes, shingle: int = SHINGLE, seed: int = SEED, block: int = 1 << 16) -> int:
    """Fingerprint of one UTF-8 text; ``bytes.lower`` and ``bytes.split`` are ASCII-only."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams: list[bytes] = [b" ".join(words)]
    else:
        grams = None
    h = functools.partial(xxhash.xxh64_intdigest, seed=seed)
    ones = np.zeros(BITS, np.int64)
    n = 1 if grams else len(words) - shingle + 1
    for at in range(0, n, block):
        part = grams or map(b" ".join, zip(*[words[at + j : min(at + j + block, n + j)] for j in range(shingle)]))
        x = np.fromiter(map(h, part), np.uint64, min(block, n - at))
        ones += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str, keep: dict[str, Column], shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns and ``fp`` (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.num_columns - 1).cast(pa.binary())
            fps = np.array([fingerprint_bytes(t.as_py() or b"", shingle) for t in texts], np.uint64)
            cols = [*b.columns[:-1], pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, [*b.schema.names[:-1], "fp"])

    slim = spread_rows(docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text).alias("_text")))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]] + ["fp long"])
    return slim.mapInArrow(run, schema)


def covering_masks(free: int, radius: int) -> list[int]:
    """Masks over the set bits of ``free`` that cover every ``radius`` or fewer positions.

    The bits take the non-zero vectors of radius + 1 dimensions in turn, so the masks are
    of nearly equal weight (about 8/15 of the free bits for radius 3).
    """
    kinds = (1 << (radius + 1)) - 1
    vectors = {}
    for i, bit in enumerate(b for b in range(BITS) if free >> b & 1):
        vectors[bit] = i % kinds + 1
    return [
        sum(1 << bit for bit, vec in vectors.items() if (vec & v).bit_count() & 1) for v in range(1, kinds + 1)
    ]


def mask_tree(radius: int = RADIUS, levels: int = 3) -> list[dict[int, list[int]]]:
    """Per level: parent mask → its refined masks (each holds the parent's bits and more)."""
    full = (1 << BITS) - 1
    tree, parents = [], [0]
    for _ in range(levels):
        level = {p: [p | m for m in covering_masks(full & ~p, radius)] for p in parents}
        tree.append(level)
        parents = sorted({m for ms in level.values() for m in ms})
    return tree


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def forest_links(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning-forest links of the close pairs inside each run of ``fps``.

    Runs begin at ``starts``; values in a run share a bucket. All pairs at one distance
    along the run are compared at once, so memory stays linear in the rows.
    """
    n = len(fps)
    ends = np.append(starts[1:], n)
    left = np.repeat(ends, ends - starts) - np.arange(n)
    label = np.arange(n)
    src, dst = [], []

    def root(i: int) -> int:
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    step, at = 1, np.flatnonzero(left > 1)
    while len(at):
        close = np.bitwise_count(fps[at] ^ fps[at + step]) <= radius
        for i in at[close]:
            a, b = root(i), root(i + step)
            if a != b:
                label[max(a, b)] = min(a, b)
                src.append(i)
                dst.append(i + step)
        step += 1
        at = at[left[at] > step]
    return fps[np.array(src, int)], fps[np.array(dst, int)]


def _bucket_links(radius: int, rows: int = 1 << 15):
    """Arrow task: rows sorted by (mask, value) → links; whole buckets, bounded batches."""

    def pieces(batches):
        rest = None
        for b in batches:
            m, k, f = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            now = (m, k, f) if rest is None else tuple(np.concatenate(x) for x in zip(rest, (m, k, f)))
            if len(now[0]) < rows:
                rest = now
                continue
            cut = np.flatnonzero((now[0][1:] != now[0][:-1]) | (now[1][1:] != now[1][:-1]))
            if not len(cut):
                rest = now
                continue
            c = cut[-1] + 1
            yield tuple(x[:c] for x in now)
            rest = tuple(x[c:] for x in now)
        if rest is not None and len(rest[0]):
            yield rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for m, k, f in pieces(batches):
            new = np.flatnonzero(np.append(True, (m[1:] != m[:-1]) | (k[1:] != k[:-1])))
            a, b = forest_links(f.view(np.uint64), new, radius)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["src", "dst"])

    return run


def close_links(fps: DataFrame, radius: int = RADIUS, split: int = BUCKET_SPLIT) -> DataFrame:
    """Links ``(src, dst)`` over different fingerprints whose components equal those of all
    pairs within ``radius`` bits. ``fps``: one column ``fp``, each value once."""
    links = None
    todo = fps.select("fp", F.lit(0).cast("long").alias("parent"))
    tree = mask_tree(radius)
    for depth, level in enumerate(tree):
        cases = F.create_map(*[
            x for p, ms in level.items()
            for x in (F.lit(_signed(p)), F.array(*[F.lit(_signed(m)) for m in ms]))
        ]) if depth else F.array(*[F.lit(_signed(m)) for m in level[0]])
        masks = cases[F.col("parent")] if depth else cases
        keyed = todo.select("fp", F.explode(masks).alias("mask")).select(
            "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("value"), "fp"
        )
        if depth:
            keyed = keyed.distinct()  # one fingerprint can reach a bucket by two ways
        sizes = keyed.groupBy("mask", "value").count().where("count > 1")
        met = stored(keyed.join(sizes, ["mask", "value"]), f"simhash-buckets{depth}")
        last = depth == len(tree) - 1
        few = met if last else met.where(F.col("count") <= split)
        found = (
            few.select("mask", "value", "fp")
            .repartition("mask", "value")
            .sortWithinPartitions("mask", "value")
            .mapInArrow(_bucket_links(radius), "src long, dst long")
        )
        links = found if links is None else links.unionByName(found)
        if last:
            break
        todo = met.where(F.col("count") > split).select("fp", F.col("mask").alias("parent"))
        if todo.isEmpty():
            break
    return links.distinct()


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """``(key, fp, component_id)``, one row per row of ``docs``."""
    rows = stored(fingerprints(docs, text, {"id": F.col(key)}, shingle), "simhash-fp")
    return components_of(rows, radius).select(F.col("id").alias(key), "fp", "component_id")


def components_of(rows: DataFrame, radius: int = RADIUS, id_col: str = "id") -> DataFrame:
    """Add ``component_id`` to rows with a fingerprint ``fp`` (a stored table)."""
    groups = stored(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "simhash-groups")
    comp = connected_components(close_links(groups.select("fp"), radius))
    labelled = groups.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = stored(labelled.join(least, "component").select("fp", "component_id"), "simhash-components")
    return rows.join(by_fp, "fp")


def one_of_each(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """One row of each component: the smallest key (null last), then the first stored row.

    The text is written once, beside a row number; components are found on the numbers.
    """
    row = free_name(docs, "_simhash_row")
    columns = docs.columns
    docs = stored(spread_rows(docs).withColumn(row, F.monotonically_increasing_id()), "simhash-documents")
    rows = stored(fingerprints(docs, text, {"id": F.col(key), "row": F.col(row)}, shingle), "simhash-fp")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    per_fp = stored(rows.groupBy("fp").agg(F.min(place).alias("first")), "simhash-first")
    comp = connected_components(close_links(per_fp.select("fp"), radius)).withColumnRenamed("node", "fp")
    kept = per_fp.join(comp, "fp", "left").groupBy(F.coalesce("component", "fp")).agg(F.min("first").alias("first"))
    return docs.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").select(*columns)


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of the unsigned 64 bits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

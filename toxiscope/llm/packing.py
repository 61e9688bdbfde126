"""Packing documents into fixed-length sequences by cutting-stock column generation.

1. Each document is tokenized whole, ends with the end id, and is cut into full pieces of
   ``CAPACITY`` ids and one rest. A full piece is a sequence of its own. Length, start and
   CRC of every piece are known from this one pass; no id is stored or shuffled.
2. The histogram of the rests over length classes of ``UNIT`` tokens (at most
   ``CAPACITY / UNIT`` rows, whatever the input) reaches the driver. There a linear
   program over packing patterns is solved by column generation: the simplex prices the
   next pattern by a knapsack dynamic program over the dual values of the classes.
   Pattern counts are rounded down; what is left (at most a few items per class) is packed
   best-fit in decreasing order.
3. Documents are ranked inside their class by a global sort. A pattern owns a range of
   ranks in each of its classes, so each document finds its sequence by its rank with a
   lookup in a table of bounded size. Offsets are running sums inside a sequence.

Defined results: a null or empty text is the end id alone; repeated rows and ids are
documents of their own; an empty table gives an empty result; a text of any length is
tokenized whole. A sequence whose used length is a power of two needs no padding.
"""

from __future__ import annotations

import bisect
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toxiscope.llm.common import spread_rows, stored
from toxiscope.operators.ranking import global_index

#: Production parameters of the registered query (fixed by its contract, but for UNIT).
CAPACITY = 2048
END_ID = 1
UNIT = 8
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
#: The linear program stops within this share of its lower bound.
LP_GAP = 1e-3
LP_STEPS = 6000

PIECES = "array<struct<start:long,length:long,crc:long>>"


@functools.cache
def _encoder(json_path: str, ranks_path: str):
    """text → little-endian uint32 ids.

    The byte-level BPE is the same vocabulary in both files. The rank form is several
    times faster; it takes Latin-script texts, where both libraries' letter classes are
    the same, and the JSON form takes every other text.
    """
    import base64
    import re
    from array import array

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(json_path)
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID}
    )
    other = re.compile("[^\x00-ɏ]")

    def encode(text: str) -> bytes:
        if other.search(text):
            ids = exact.encode(text, add_special_tokens=False).ids
        elif SPECIAL in text:
            ids = fast.encode(text, allowed_special="all")
        else:
            ids = fast.encode_ordinary(text)
        return array("I", ids).tobytes()

    return encode


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut_documents(docs: DataFrame, text: str, keep: dict[str, Column], capacity: int = CAPACITY) -> DataFrame:
    """``keep`` columns, ``doc_tokens`` and ``pieces`` of every row."""
    paths = tokenizer_paths()
    end = np.array([END_ID], "<u4").tobytes()

    def pieces(ids: bytes) -> list[dict]:
        view, step = memoryview(ids), 4 * capacity
        return [
            {"start": i // 4, "length": len(part) // 4, "crc": zlib.crc32(part)}
            for i in range(0, len(ids), step)
            for part in (view[i : i + step],)
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(*paths)
        for b in batches:
            ids = (encode(t.as_py() or "") + end for t in b.column(b.num_columns - 1))
            n, cut = [], []
            for x in ids:
                n.append(len(x) // 4)
                cut.append(pieces(x))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))
            names = [*b.schema.names[:-1], "doc_tokens", "pieces"]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(n, pa.int64()), pa.array(cut, kind)], names
            )

    slim = spread_rows(docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text).alias("_text")))
    head = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    return slim.mapInArrow(run, ", ".join([*head, "doc_tokens long", f"pieces {PIECES}"]))


def price_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the most valuable multiset of classes that fits."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for s in range(1, capacity + 1):
        best[s] = best[s - 1]
        k = fits[s]
        if k:
            cand = best[s - sizes[:k]] + values[:k]
            j = int(cand.argmax())
            if cand[j] > best[s]:
                best[s], pick[s] = cand[j], j
    counts, s = np.zeros(len(sizes), int), capacity
    while s > 0:
        if pick[s] < 0:
            s -= 1
        else:
            counts[pick[s]] += 1
            s -= sizes[pick[s]]
    return float(best[capacity]), counts


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one per row) and their fractional counts; sizes ascending, demand > 0.

    Revised simplex with a dense inverse (one row per class); the entering pattern comes
    from :func:`price_pattern`. Stops at the optimum, within LP_GAP of the best lower
    bound (volume, or scaled dual values), or after LP_STEPS steps; an early stop costs padding only.
    """
    m = len(sizes)
    rows = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / (capacity // sizes))
    need = demand.astype(float)
    x = inverse @ need
    bound, centre = need @ sizes / capacity, sizes / capacity
    for _ in range(LP_STEPS):
        if x.sum() <= bound * (1 + LP_GAP):
            break
        duals = inverse.sum(0)
        # smoothed prices first: they jump about less, and their scaled value is a bound
        for prices in (0.7 * centre + 0.3 * np.maximum(duals, 0), np.maximum(duals, 0)):
            value, pattern = price_pattern(prices, sizes, capacity)
            lower = need @ prices / max(value, 1.0)
            if lower > bound:
                bound, centre = lower, prices / max(value, 1.0)
            if duals @ pattern > 1 + 1e-6:
                break
        else:
            break
        way = inverse @ pattern
        ok = way > 1e-9
        ratio = np.full(m, np.inf)
        ratio[ok] = np.maximum(x[ok], 0) / way[ok]
        out = int(ratio.argmin())
        step = ratio[out]
        x -= step * way
        x[out] = step
        rows[out] = pattern
        pivot = inverse[out] / way[out]
        inverse -= np.outer(way, pivot)
        inverse[out] = pivot
    return rows.astype(int), np.maximum(x, 0)


def plan_sequences(sizes: list[int], demand: list[int], capacity: int) -> tuple[list[tuple], int]:
    """``(class, first_rank, per_sequence, first_sequence)`` of every rank range, and the
    number of sequences. A range ends where the next one of its class begins."""
    if not sizes:
        return [], 0
    order = np.argsort(sizes)
    w, b = np.array(sizes)[order], np.array(demand)[order]
    patterns, x = solve_patterns(w, b, capacity)
    left, todo = b.copy(), []
    for pattern, n in sorted(zip(patterns.tolist(), np.floor(x + 1e-6).astype(int).tolist()), key=lambda p: -p[1]):
        used = [j for j, a in enumerate(pattern) if a]
        n = min([n, *(left[j] // pattern[j] for j in used)])
        if n > 0:
            for j in used:
                left[j] -= n * pattern[j]
            todo.append((int(n), {j: pattern[j] for j in used}))
    bins: list[tuple[int, int]] = []  # (room, number), ascending
    held: list[dict[int, int]] = []
    for j in range(len(w) - 1, -1, -1):
        for _ in range(int(left[j])):
            at = bisect.bisect_left(bins, (int(w[j]), -1))
            room, k = bins.pop(at) if at < len(bins) else (capacity, len(held))
            if k == len(held):
                held.append({})
            held[k][j] = held[k].get(j, 0) + 1
            bisect.insort(bins, (room - int(w[j]), k))
    todo += [(1, counts) for counts in held]
    taken, ranges, first = [0] * len(w), [], 0
    for n, counts in todo:
        for j, a in counts.items():
            ranges.append((int(w[j]), taken[j], a, first))
            taken[j] += n * a
        first += n
    return ranges, first


def pack(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``key, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    spark = docs.sparkSession
    cut = cut_documents(docs, text, {"id": F.col(key), "row": F.monotonically_increasing_id()}, capacity)
    cut = stored(cut, "pack-pieces")
    rest = cut.where(F.col("doc_tokens") % capacity > 0).select(
        "id", "row", "doc_tokens", F.element_at("pieces", -1).alias("p")
    )
    size_class = F.ceil(F.col("p.length") / F.lit(UNIT)).cast("int")
    rest = rest.select("id", "row", "doc_tokens", "p.*", size_class.alias("class"))
    hist = sorted(rest.groupBy("class").count().collect())  # at most capacity / UNIT rows
    ranges, n_sequences = plan_sequences([h[0] for h in hist], [h[1] for h in hist], capacity // UNIT)

    starts, total = {}, 0
    for c, n in hist:
        starts[c] = total
        total += n
    table = spark.createDataFrame(
        [(c, starts[c] + f, starts[c] + f, a, s) for c, f, a, s in ranges],
        "class int, from long, first long, per long, sequence long",
    )
    # the class's range that holds a rank: the last one that begins at or before it
    by_class = table.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("from", "first", "per", "sequence"))).alias("ranges"))
    ranked = global_index(rest, [F.col("class"), F.col("length").desc(), F.col("row")], "rank")
    hit = F.element_at(F.filter("ranges", lambda r: r["from"] <= F.col("rank")), -1)
    placed = ranked.join(F.broadcast(by_class), "class").withColumn("hit", hit)
    slot = F.col("rank") - F.col("hit.first")
    placed = placed.select(
        "id", "start", "length", "crc", "doc_tokens", "class", "rank",
        (F.col("hit.sequence") + F.floor(slot / F.col("hit.per"))).alias("sequence_id"),
    )
    before = Window.partitionBy("sequence_id").orderBy(F.col("class").desc(), "rank").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    full = (
        cut.where(F.col("doc_tokens") >= capacity)
        .select("id", "row", "doc_tokens", F.explode("pieces").alias("p"))
        .where(F.col("p.length") == capacity)
        .select("id", "row", "doc_tokens", "p.*")
    )
    full = global_index(full, [F.col("row"), F.col("start")], "sequence_id").select(
        "id", "start", "length", "crc", "doc_tokens",
        (F.col("sequence_id") + n_sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    cols = ["id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"]
    return placed.select(*cols).unionByName(full).withColumnsRenamed({"id": key, "crc": "ids_crc32"})

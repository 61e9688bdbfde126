"""Periodic run detection: an online, sparse dynamic program over the diagonals of a text.

A run is a stretch of words with smallest period q (words q apart are the same), at least
``max(MIN_WORDS, MIN_REPEATS * q)`` words long, that no neighbouring word extends.

For each word, its earlier occurrences increment the match lengths of the active lags: at
lag d a diagonal grows by one as long as word i equals word i - d. All occurrences of a
common word would make that quadratic, so only those that can still become a run are taken.
A run of period q matches at lag q over at least max(24 - q, 2 q) words. So for lags in
(w / 2, w] with w = 16, 32, 64, … (and all lags up to 16) an occurrence counts when the last
w words agree too, and of those only the nearest one: had the w words before occurred at a
shorter lag r inside the run, the stretch would have both periods, hence their greatest
common divisor (Fine and Wilf), and q would not be the smallest. That leaves at most one
active lag per word and scale, and no run is lost. Words with the same last w words are
named by doubling (a name of 2 w words is a pair of names), which is exact; words whose
context occurs once in their text drop out, so the later scales only see repetitive texts.

Rows never meet: one narrow pass, no shuffle, a lost executor only repeats its own rows.
Texts are read whole, in groups of at least ``GROUP_BYTES`` (one text may be longer).

Null text is the empty text (no words, no runs, empty collapsed text). Repeated rows each
get their result; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import free_name, spread_rows

MIN_WORDS = 24
MIN_REPEATS = 3
#: Least context: a run of period q has at least MIN_WORDS - q words that match at lag q,
#: and at least (MIN_REPEATS - 1) * q, so never fewer than this.
CONTEXT = 16
#: Texts are handled together until they hold this many bytes.
GROUP_BYTES = 2 << 20

#: Changes the words of a text before the search; gets the key's value and the words.
Change = Callable[[object, list[bytes]], list[bytes]]
Run = tuple[int, int, int]


def _names(keys: np.ndarray) -> np.ndarray:
    return pd.factorize(keys)[0].astype(np.int64)


def earlier_occurrences(ids: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per scale w: the words (by position) with an earlier occurrence at a lag of that scale
    whose last w words agree, and the nearest such lag. ``doc`` tells the texts apart."""
    n = len(ids)
    at, width = np.arange(n), 1
    name = _names(doc * (int(ids.max()) + 1 if n else 1) + ids)
    while len(at):
        keep = np.bincount(name)[name] > 1
        at, name = at[keep], name[keep]
        if width >= CONTEXT:
            order = np.argsort(name, kind="stable")
            same = name[order][1:] == name[order][:-1]
            here, lag = at[order][1:][same], (at[order][1:] - at[order][:-1])[same]
            fits = (lag <= width) & ((width == CONTEXT) | (2 * lag > width))
            here, lag = here[fits], lag[fits]
            by_place = np.argsort(here)
            yield width, here[by_place], lag[by_place]
        before = np.full(n, -1, np.int64)
        before[at] = name
        whole = at >= width
        whole[whole] = (before[at[whole] - width] >= 0) & (doc[at[whole] - width] == doc[at[whole]])
        at, name = at[whole], name[whole]
        if len(at):
            name = _names(name * (int(before.max()) + 1) + before[at - width])
        width *= 2


def diagonals(width: int, places: np.ndarray, lags: np.ndarray) -> Iterator[Run]:
    """Runs of one scale, each emitted as soon as its diagonal ends."""
    lag, length, last = 0, 0, -2
    for i, d in zip(places.tolist(), lags.tolist()):
        if d == lag and i == last + 1:
            length += 1
        else:
            if length + lag >= max(MIN_WORDS, MIN_REPEATS * lag) and lag:
                yield last - length - lag + 1, length + lag, lag
            lag, length = d, width
        last = i
    if lag and length + lag >= max(MIN_WORDS, MIN_REPEATS * lag):
        yield last - length - lag + 1, length + lag, lag


def find_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """``(start, length, period)`` of every run of every text, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    found: list[list[Run]] = [[] for _ in texts]
    words = [w for t in texts if len(t) >= MIN_WORDS for w in t]
    if not words:
        return found
    long_enough = np.flatnonzero(sizes >= MIN_WORDS)
    sizes = sizes[long_enough]
    begins = np.cumsum(sizes) - sizes
    held = np.empty(len(words), object)
    held[:] = words
    ids = _names(held)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    for width, places, lags in earlier_occurrences(ids, doc):
        for start, length, period in diagonals(width, places, lags):
            k = int(doc[start])
            found[long_enough[k]].append((start - int(begins[k]), length, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words that no run repeats (each run keeps its first period), joined by one blank."""
    if runs:
        kept = np.ones(len(words), bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    change: Change | None = None,
    runs: str = "runs",
    collapsed: str = "collapsed",
) -> DataFrame:
    """``docs`` without its text, with the array ``runs`` of (start, length, period), by start,
    then period, and the ``collapsed`` text. A free name is taken where a column has that name.

    ``change`` alters a text's words before the search (it gets the ``key`` value).
    """
    keep = [c for c in docs.columns if c != text]
    slim = spread_rows(docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(text), F.lit("")).alias(text)))
    runs, collapsed = free_name(slim, runs), free_name(slim, collapsed)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    key_at = slim.columns.index(key) if key in keep else None

    def rows(b: pa.RecordBatch, begin: int, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = find_runs(texts)
        flat = np.array([r for f in found for r in f], np.int64).reshape(-1, 3)
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        fields = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
        part = b.slice(begin, len(texts))
        left = pa.array([collapse(t, f) for t, f in zip(texts, found)], pa.binary()).cast(pa.string())
        cols = [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), fields).cast(run_type), left]
        return pa.RecordBatch.from_arrays(cols, [*b.schema.names[:-1], runs, collapsed])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(key_at).to_pylist() if change and key_at is not None else None
            begin, held, texts = 0, 0, []
            for i, t in enumerate(b.column(b.num_columns - 1).cast(pa.binary())):
                body = t.as_py()
                words = body.split()  # bytes are split at ASCII white space only
                texts.append(change(keys[i] if keys else None, words) if change else words)
                held += len(body)
                if held >= GROUP_BYTES:
                    yield rows(b, begin, texts)
                    begin, held, texts = i + 1, 0, []
            if texts:
                yield rows(b, begin, texts)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]]
    out = [f"`{runs}` array<struct<start:bigint,length:bigint,period:bigint>>", f"`{collapsed}` string"]
    return slim.mapInArrow(search, ", ".join(kept + out))


def strongest(runs) -> F.Column:
    """The run with the greatest length / period (ties: the first by start, then period)."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(
        runs, none,
        lambda best, r: F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
        ).otherwise(best),
    )

"""Language identification with a byte convolutional network trained in numpy.

A text's UTF-8 bytes (A-Z lower-cased) are cut into windows of ``WINDOW`` bytes. Bytes are
embedded; filters of several widths slide over a window; their maxima over the window
feed a softmax over the languages. A document's probabilities are the means over all its
windows, weighted by their bytes, so the whole text counts.

Training reads a bounded, documented sample: about ``DOCS_PER_LABEL`` labelled documents
of each language (those with the least seeded hash) and ``WINDOWS_PER_DOC`` windows spread
over each of them. Every language is learned: with many of them the ``SAMPLE_DOCS`` documents
that the sample holds on average are dealt over all.
Prediction covers every row and the whole of each text, in batches of windows of fixed
memory. For prediction the embedding and the filters are multiplied out into tables by
byte pair, so a filter response is one to three additions.

Defined results: a null text or a text without a letter is ``und`` with score 0; without
any labelled row every text is ``und``; rows with a null language teach nothing; repeated
rows get the same answer; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import pickle

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import spread_rows

UNKNOWN = "und"
#: Bounds of the training sample.
DOCS_PER_LABEL = 400
WINDOWS_PER_DOC = 4
SAMPLE_DOCS = 25_600
#: The network.
WINDOW = 192
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 16
EPOCHS = 8
BATCH = 128
RATE = 4e-3
SEED = 4
#: Windows per numpy call when predicting: their filter responses stay in the cache.
CHUNK = 96

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def windows_of(text: bytes, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text (the last one padded with zero bytes) and their byte counts."""
    n = max(1, -(-len(text) // window))
    flat = np.zeros(n * window, np.uint8)
    flat[: len(text)] = np.frombuffer(text, np.uint8)
    used = np.full(n, window)
    used[-1] = max(1, len(text) - (n - 1) * window)
    return LOWER[flat].reshape(n, window), used


class ByteConvNet:
    """Embedding, convolutions of several widths, max pooling, softmax; Adam on cross-entropy."""

    def __init__(self, labels: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.w = {"embed": rng.normal(0, 0.5, (256, EMBED))}
        for k in WIDTHS:
            self.w[f"conv{k}"] = rng.normal(0, (2 / (k * EMBED)) ** 0.5, (k * EMBED, FILTERS))
            self.w[f"bias{k}"] = np.zeros(FILTERS)
        self.w["out"] = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(labels)))
        self.w["shift"] = np.zeros(len(labels))

    def _forward(self, x: np.ndarray):
        e = self.w["embed"][x]
        pooled, kept = [], []
        for k in WIDTHS:
            n = x.shape[1] - k + 1
            cols = np.concatenate([e[:, j : j + n] for j in range(k)], axis=2)
            z = cols @ self.w[f"conv{k}"] + self.w[f"bias{k}"]
            top = z.argmax(1)
            pooled.append(np.maximum(np.take_along_axis(z, top[:, None], 1)[:, 0], 0))
            kept.append((cols, top))
        h = np.concatenate(pooled, 1)
        return h, kept, _softmax(h @ self.w["out"] + self.w["shift"])

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        h, kept, p = self._forward(x)
        p[np.arange(len(y)), y] -= 1
        p /= len(y)
        g = {"out": h.T @ p, "shift": p.sum(0), "embed": np.zeros_like(self.w["embed"])}
        dh = (p @ self.w["out"].T) * (h > 0)
        for i, (k, (cols, top)) in enumerate(zip(WIDTHS, kept)):
            d = dh[:, i * FILTERS : (i + 1) * FILTERS]
            at = cols[np.arange(len(y))[:, None], top]  # the input of each maximum
            g[f"conv{k}"] = np.einsum("bfc,bf->cf", at, d)
            g[f"bias{k}"] = d.sum(0)
            de = (d[:, :, None] * self.w[f"conv{k}"].T[None]).reshape(len(y), FILTERS, k, EMBED)
            for j in range(k):
                np.add.at(g["embed"], np.take_along_axis(x, top + j, 1), de[:, :, j])
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int = SEED) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(w) for k, w in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for i in range(0, len(y), BATCH):
                step += 1
                rows = order[i : i + BATCH]
                for k, g in self._gradients(x[rows], y[rows]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.w[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    @functools.cached_property
    def tables(self) -> dict[int, list[np.ndarray]]:
        """Filter responses by byte pair (65,536 rows), and by last byte for odd widths."""
        e, tables = self.w["embed"], {}
        for k in WIDTHS:
            parts = self.w[f"conv{k}"].reshape(k, EMBED, FILTERS)
            one = [(e @ p).astype(np.float32) for p in parts]
            pairs = [
                (one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS) for j in range(0, k - 1, 2)
            ]
            pairs[0] += self.w[f"bias{k}"].astype(np.float32)
            tables[k] = pairs + ([one[-1]] if k % 2 else [])
        return tables

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Class probabilities of windows, ``CHUNK`` windows at a time."""
        out = []
        for i in range(0, len(x), CHUNK):
            part = x[i : i + CHUNK]
            pair = (part[:, :-1].astype(np.int32) << 8) | part[:, 1:]
            pooled = []
            for k in WIDTHS:
                n = part.shape[1] - k + 1
                z = None
                for j, table in enumerate(self.tables[k]):
                    keys = pair if len(table) > 256 else part
                    got = table.take(keys[:, 2 * j : 2 * j + n], axis=0)
                    z = got if z is None else np.add(z, got, out=z)
                pooled.append(np.maximum(z.max(1), 0))
            out.append(_softmax(np.concatenate(pooled, 1) @ self.w["out"] + self.w["shift"]))
        return np.concatenate(out)

    def __getstate__(self):
        return {"labels": self.labels, "w": self.w}


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def training_sample(
    docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", per_label: int = DOCS_PER_LABEL
) -> tuple[list[bytes], list[str]]:
    """A bounded sample: rows whose seeded hash is below the share that gives ``per_label``
    rows of a language on average, at most twice that many."""
    known = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = known.groupBy(F.col(label).alias("l")).count()
    counts = sizes.collect()  # one row a language
    if not counts:
        return [], []
    per_label = max(1, min(per_label, SAMPLE_DOCS // len(counts)))
    u = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col(key)), 11).cast("double") / F.lit(float(1 << 53))
    share = F.coalesce(*[F.when(F.col(label) == r["l"], min(1.0, per_label / r["count"])) for r in counts])
    rows = (
        known.where(u < share)
        .select(F.col(label).alias("l"), F.col(text).alias("t"), u.alias("u"))
        .select("l", "u", _cut_windows(F.col("t").cast("binary")).alias("t"))
        .orderBy("u", "l", "t")
        .limit(2 * per_label * len(counts))
        .collect()
    )
    return [bytes(w) for r in rows for w in r["t"]], [r["l"] for r in rows for _ in r["t"]]


def _cut_windows(data: Column) -> Column:
    """Up to WINDOWS_PER_DOC windows spread evenly over the bytes."""
    room = F.greatest(F.octet_length(data) - WINDOW, F.lit(0))
    at = F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOC - 1))
    begin = F.array_distinct(F.transform(at, lambda i: F.floor(room * i / (WINDOWS_PER_DOC - 1)).cast("int")))
    return F.transform(begin, lambda b: F.substring(data, b + 1, F.lit(WINDOW)))


def train(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> ByteConvNet | None:
    """The network learned from the labelled rows of ``docs``; None when there are none."""
    texts, labels = training_sample(docs, text, label, key)
    if not texts:
        return None
    names = sorted(set(labels))
    x = np.concatenate([windows_of(t)[0][:1] for t in texts])
    y = np.array([names.index(v) for v in labels])
    net = ByteConvNet(names).fit(x, y)
    return net


@functools.lru_cache(maxsize=2)
def _loaded(data: bytes) -> ByteConvNet:
    return pickle.loads(data)


def document_scores(net: ByteConvNet, texts: list[bytes], room: int = 1 << 14) -> tuple[list[str], list[float]]:
    """Label and mean probability of each text; at most about ``room`` windows at a time."""
    names, scores, todo, held = [], [], [], 0

    def flush():
        if not todo:
            return
        p = net.probabilities(np.concatenate([x for x, _ in todo]))
        used = np.concatenate([u for _, u in todo])
        first = np.cumsum([0] + [len(u) for _, u in todo[:-1]])
        mean = np.add.reduceat(p * used[:, None], first) / np.add.reduceat(used, first)[:, None]
        best = mean.argmax(1)
        names.extend(net.labels[i] for i in best)
        scores.extend(np.minimum(mean[np.arange(len(best)), best], 1.0).tolist())
        todo.clear()

    for t in texts:
        x, used = windows_of(t)
        if held + len(x) > room:
            flush()
            held = 0
        todo.append((x, used))
        held += len(x)
    flush()
    return names, scores


def predict(docs: DataFrame, net: ByteConvNet | None, text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs`` plus the predicted language and its score."""
    if net is None:
        return docs.withColumns({out[0]: F.lit(UNKNOWN), out[1]: F.lit(0.0)})
    model = pickle.dumps(net)

    @F.pandas_udf("struct<lang:string,score:double>")
    def classify(texts: pd.Series) -> pd.DataFrame:
        names, scores = document_scores(_loaded(model), [t.encode() for t in texts])
        return pd.DataFrame({"lang": names, "score": scores})

    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    got = classify(F.when(has_letter, F.col(text)).otherwise(F.lit("")))
    rows = docs.withColumn(out[0], got)
    found = F.col(out[0])
    return rows.withColumns({
        out[1]: F.when(has_letter, found["score"]).otherwise(F.lit(0.0)),
        out[0]: F.when(has_letter, found["lang"]).otherwise(F.lit(UNKNOWN)),
    })

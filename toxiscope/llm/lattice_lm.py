"""Language-model scoring by subword lattice likelihood.

The vocabulary is an existing one (its pieces and their ranks); piece probabilities start
from the ranks and are re-estimated on the distinct training words by expectation
maximization. A word's lattice probability is the sum over all segmentations into pieces, by
a forward recursion in log space. Pieces begin a word with the mark ``▁`` and never cross
it, so the recursion over a text factors into its words, and each distinct word needs it
once, whatever its count. A word seen in training has one more arc over its whole length,
with its relative frequency; Good-Turing's estimate of the share of new words weighs the two.

There is one such model per component (the groups of a training column, such as language);
a text's probability is marginal over the components too: the sum over k of the component's
share times the product of its words' and its end's probabilities under k.

1. Words are counted per task, then per word (one shuffle of partial counts).
2. Every round of re-estimation is one pass over the distinct words of training; what
   returns to the driver is one number per piece and component (a fixed vocabulary).
3. Each distinct word gets its counts and log probabilities in a stored table.
4. A pass over the documents adds up what a bounded table of frequent words gives
   (``HOT_WORDS`` entries of at most ``HOT_BYTES`` bytes); other words are joined to the
   word table, with repeats in a document added up before the shuffle.

Defined results: a null text is empty and has the end alone; without training documents
every count is 0 and the piece ranks give the probabilities; characters outside the
vocabulary are spelt in byte pieces; a null group, and groups beyond the ``COMPONENTS`` most
frequent, share the last component; repeated rows are documents of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import spread_rows, stored

MARK = "▁"
#: Production parameters.
ROUNDS = 3
COMPONENTS = 6
SMOOTHING = 0.1
HOT_WORDS = 200_000
HOT_BYTES = 64
#: Distinct words held per task before they are passed on.
FLUSH = 400_000
LOG10 = math.log(10)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Pieces a lower-cased word can hold and their ids; the byte pieces come first.

    Substrings are looked up by a 64-bit rolling hash of their code points in a slot table;
    the pieces that share a slot are in a small sorted array.
    """

    SLOT_BITS = 18
    BASE = np.uint64(0x9E3779B97F4A7C15)
    SPREAD = np.uint64(0xD6E8FEB86659FD93)

    def __init__(self, pieces: list[str]):
        own = [p for p in pieces if not any("A" <= c <= "Z" for c in p) and MARK not in p[1:]]
        self.names = list(dict.fromkeys(own))
        self.n = 256 + len(self.names)
        self.longest = max(map(len, self.names), default=1)
        self.ids = {p: 256 + i for i, p in enumerate(self.names)}
        keys = np.array([self._hash(p) for p in self.names], np.uint64)
        ids = np.arange(256, self.n, dtype=np.int32)
        slot = self._slot(keys)
        alone = np.bincount(slot, minlength=1 << self.SLOT_BITS)[slot] == 1
        self.slot_key = np.zeros(1 << self.SLOT_BITS, np.uint64)
        self.slot_id = np.full(1 << self.SLOT_BITS, -1, np.int32)
        self.slot_key[slot[alone]], self.slot_id[slot[alone]] = keys[alone], ids[alone]
        self.slot_id[slot[~alone]] = -2
        order = np.argsort(keys[~alone])
        self.shared_keys, self.shared_ids = keys[~alone][order], ids[~alone][order]

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(self.BASE) + ord(c) + 1) % (1 << 64)
        return h

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.SPREAD) >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ids of hashed substrings; -1 for none."""
        slot = self._slot(keys)
        got = self.slot_id[slot]
        out = np.where(self.slot_key[slot] == keys, got, -1)
        shared = got == -2
        if shared.any():
            asked = keys[shared]
            at = np.minimum(np.searchsorted(self.shared_keys, asked), len(self.shared_keys) - 1)
            out[shared] = np.where(self.shared_keys[at] == asked, self.shared_ids[at], -1)
        return out

    def first_scores(self) -> np.ndarray:
        """Natural log probabilities from the vocabulary's order, p ~ 1 / (rank + 3)."""
        rank = np.concatenate([np.full(256, len(self.names)), np.arange(len(self.names))])
        p = 1 / (rank + 3.0)
        return np.log(p / p.sum())


@functools.cache
def load_pieces(path: str) -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = [i for i in range(model.get_piece_size())
             if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return Pieces([model.id_to_piece(i) for i in usual])


def _lattice(words: list[str], pieces: Pieces, extra: dict[str, int]) -> np.ndarray:
    """ids[w, j, l-1]: piece of length l that ends at position j; -1 for none. Words of one length.

    ``extra`` takes the characters that are no piece; their ids begin at ``pieces.n``.
    """
    length = len(words[0]) + 1
    codes = np.full((len(words), length), ord(MARK), np.uint64)
    if length > 1:
        codes[:, 1:] = np.array(words, f"<U{length - 1}").view(np.uint32).reshape(len(words), -1)
    most = min(pieces.longest, length)
    ids = np.full((len(words), length + 1, most), -1, np.int32)
    marks = codes[:, 1:] == ord(MARK)  # the mark itself inside a word begins no piece
    h = np.zeros(codes.shape, np.uint64)
    for n in range(1, most + 1):
        h = h[:, : length - n + 1] * pieces.BASE + codes[:, n - 1 :] + np.uint64(1)
        found = pieces.find(h)
        if marks.any():
            found[:, 1:][marks[:, : length - n]] = -1
        ids[:, n:, n - 1] = found
    single = ids[:, 1:, 0]
    for c in np.unique(codes[single < 0]):
        single[(single < 0) & (codes == c)] = extra.setdefault(chr(c), pieces.n + len(extra))
    return ids


def _scores(ids: np.ndarray, logp: np.ndarray, extra: dict[str, int]) -> np.ndarray:
    spelt = [logp[list(c.encode("utf-8", "surrogatepass"))].sum() for c in extra]
    return np.concatenate([logp, spelt, [-np.inf]])[ids]


def _logsumexp(x: np.ndarray) -> np.ndarray:
    top = x.max(1)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(x - safe[:, None]).sum(1))


def forward(score: np.ndarray) -> np.ndarray:
    """Log probability of every prefix; score as :func:`_lattice` ids."""
    n, ends, most = score.shape
    alpha = np.full((n, ends), -np.inf)
    alpha[:, 0] = 0
    for j in range(1, ends):
        m = min(most, j)
        alpha[:, j] = _logsumexp(alpha[:, j - 1 :: -1][:, :m] + score[:, j, :m])
    return alpha


def expected_counts(ids: np.ndarray, score: np.ndarray, size: int) -> np.ndarray:
    """Expected uses of each piece in the words."""
    alpha = forward(score)
    n, ends, most = score.shape
    beta = np.full((n, ends), -np.inf)
    beta[:, -1] = 0
    for i in range(ends - 2, -1, -1):
        m = min(most, ends - 1 - i)
        steps = np.arange(m)
        beta[:, i] = _logsumexp(beta[:, i + 1 : i + 1 + m] + score[:, i + 1 + steps, steps])
    total = np.zeros(size)
    for j in range(1, ends):
        m = min(most, j)
        use = np.exp(alpha[:, j - 1 :: -1][:, :m] + score[:, j, :m] + (beta[:, j] - alpha[:, -1])[:, None])
        at = ids[:, j, :m]
        ok = at >= 0
        total += np.bincount(at[ok], use[ok], minlength=size)
    return total


def _by_length(words: list[str], cells: int = 1 << 15) -> Iterator[np.ndarray]:
    """Positions of words of one length, few enough for bounded memory."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cut = np.flatnonzero(np.diff(sizes[order])) + 1
    for same in np.split(order, cut) if len(order) else []:
        step = max(1, cells // (int(sizes[same[0]]) + 1))
        for i in range(0, len(same), step):
            yield same[i : i + step]


def count_words_by_task(docs: DataFrame, parts: int) -> DataFrame:
    """``(word, k, n)``. ``docs``: text, k (the training component, or ``parts`` for none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(parts + 1)]

        def out():
            for k, c in enumerate(counts):
                if c:
                    keys = pa.array(list(c.keys()), pa.binary()).cast(pa.string())
                    at, n = pa.array(np.full(len(c), k, np.int32)), pa.array(list(c.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([keys, at, n], ["word", "k", "n"])
                    c.clear()

        for b in batches:
            for t, k in zip(b.column(0).cast(pa.binary()), b.column(1).to_pylist()):
                counts[k].update((t.as_py() or b"").lower().split())
                if sum(map(len, counts)) > FLUSH:
                    yield from out()
        yield from out()

    return docs.select("text", "k").mapInArrow(run, "word string, k int, n long")


def reestimate(words: DataFrame, parts: int, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log probabilities of the pieces per component after ``rounds`` passes over the distinct
    ``words(word, c)``; ``c`` holds the counts per component."""
    pieces = load_pieces(path)
    logp = np.tile(pieces.first_scores(), (parts, 1))
    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], logp=logp) -> Iterator[pa.RecordBatch]:
            known = load_pieces(path)
            total = np.zeros((parts, known.n))
            for b in batches:
                names = b.column(0).to_pylist()
                c = b.column(1).flatten().to_numpy().reshape(-1, parts)
                for at in _by_length(names):
                    extra: dict[str, int] = {}
                    ids = _lattice([names[i] for i in at], known, extra)
                    for k in range(parts):
                        mine = ids[c[at, k] > 0]
                        if not len(mine):
                            continue
                        got = expected_counts(mine, _scores(mine, logp[k], extra), known.n + len(extra))
                        total[k] += got[: known.n]
                        for ch, i in extra.items():
                            for byte in ch.encode("utf-8", "surrogatepass"):
                                total[k, byte] += got[i]
            k, used = np.nonzero(total)
            cols = [pa.array(k.astype(np.int32)), pa.array(used.astype(np.int64)), pa.array(total[k, used])]
            yield pa.RecordBatch.from_arrays(cols, ["k", "piece", "uses"])

        uses = words.mapInArrow(run, "k int, piece long, uses double").groupBy("k", "piece").agg(F.sum("uses")).collect()
        total = np.full((parts, pieces.n), SMOOTHING)
        for k, i, v in uses:
            total[k, i] += v
        logp = np.log(total / total.sum(1, keepdims=True))
    return logp


def word_table(words: DataFrame, logp: np.ndarray, known_share: np.ndarray, tokens: np.ndarray, path: str) -> DataFrame:
    """Adds ``ln`` to ``words(word, n, c)``: per component its corpus arc and its lattice, mixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load_pieces(path)
        with np.errstate(divide="ignore"):
            arc, rest = np.log(known_share), np.log(1 - known_share)
            for b in batches:
                names = b.column(0).to_pylist()
                lattice = np.zeros((len(names), len(logp)))
                for at in _by_length(names):
                    extra: dict[str, int] = {}
                    ids = _lattice([names[i] for i in at], known, extra)
                    for k in range(len(logp)):
                        lattice[at, k] = forward(_scores(ids, logp[k], extra))[:, -1]
                seen = np.log(b.column(2).flatten().to_numpy().reshape(lattice.shape) / np.maximum(tokens, 1))
                got = np.logaddexp(arc + seen, rest + lattice)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(got))], ["word", "n", "c", "ln"])

    return words.mapInArrow(run, "word string, n long, c array<long>, ln array<double>")


def frequent_words(table: DataFrame, most: int = HOT_WORDS, width: int = HOT_BYTES) -> list:
    """``(word, c, ln)`` of the most frequent short words, ``most`` at most.

    The limit comes from a histogram of counts (a few hundred rows), not from a sort.
    """
    short = table.where(F.octet_length("word") <= width)
    step = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    taken, least = 0, None
    for r in sorted(short.groupBy(step.alias("s")).count().collect(), reverse=True):
        taken += r["count"]
        if taken > most:
            break
        least = r["s"]
    if least is None:
        return []
    return short.where(step >= least).select("word", "c", "ln").collect()


def score_documents(
    docs: DataFrame, train: Column, keep: dict[str, Column], text: str = "text", group: str | None = None,
    path: str | None = None, rounds: int = ROUNDS,
) -> DataFrame:
    """``keep`` columns, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    path = path or vocabulary_path()
    value = F.col(group).cast("string") if group else F.lit(None).cast("string")
    rows = spread_rows(docs.select(
        F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"), value.alias("group"),
        *[c.alias(k) for k, c in keep.items()],
    ))
    shares = rows.where("train").groupBy("group").count()
    top = shares.where("group is not null").orderBy(F.desc("count"), "group").limit(COMPONENTS).collect()
    n_train = shares.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    ends = np.array([r["count"] for r in top] + [n_train - sum(r["count"] for r in top)], float)
    if len(ends) > 1 and not ends[-1]:
        ends = ends[:-1]  # no training document is left for the component of the rest
    parts = len(ends)
    k = F.coalesce(*[F.when(F.col("group") == r["group"], F.lit(i)) for i, r in enumerate(top)], F.lit(parts - 1))
    rows = rows.withColumn("k", F.when(F.col("train"), k).otherwise(F.lit(parts))).drop("train", "group")

    per = count_words_by_task(rows, parts).groupBy("word").agg(
        F.sum("n").alias("n"),
        F.array(*[F.coalesce(F.sum(F.when(F.col("k") == i, F.col("n"))), F.lit(0)) for i in range(parts)]).alias("c"),
    )
    words = stored(per, "lm-words")
    in_all = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)
    known = words.where(in_all > 0)
    sums = known.agg(
        F.count(F.lit(1)),
        *[F.coalesce(F.sum(F.col("c")[i]), F.lit(0)) for i in range(parts)],
        *[F.coalesce(F.sum((F.col("c")[i] == 1).cast("long")), F.lit(0)) for i in range(parts)],
    ).first()
    kinds = sums[0] + (n_train > 0)
    tokens, once = np.array(sums[1 : parts + 1], float) + ends, np.array(sums[parts + 1 :], float)
    n_tokens = int(tokens.sum())
    logp = reestimate(known.select("word", "c"), parts, path, rounds if sums[0] else 0)
    # Good-Turing: words seen once, out of all tokens, are the share of new words to come
    new = np.minimum(0.5, np.maximum(once, 1) / np.maximum(tokens, 1))
    known_share = np.where(tokens > 0, 1 - new, 0.0)
    table = stored(word_table(words, logp, known_share, tokens, path), "lm-table")

    whole = n_tokens + 0.5 * (kinds + 1)
    hot = frequent_words(table)
    index = {r[0].encode(): i for i, r in enumerate(hot)}
    hot_c = np.array([sum(r[1]) for r in hot], float)
    # columns: base score, whether known, log probability per component
    facts = np.column_stack([np.log10((hot_c + 0.5) / whole), hot_c > 0, np.array([r[2] for r in hot]).reshape(-1, parts)])
    del hot
    # the end is a token too; without training documents it is as likely as a fair coin
    end_ln = np.log(known_share * ends / np.maximum(tokens, 1)) if n_train else np.full(parts, math.log(0.5))
    end = np.concatenate([[math.log10((n_train + 0.5) / whole), n_train > 0], end_ln])
    prior = np.log(ends / n_train) if n_train else np.zeros(parts)
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
        final = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
        for all_rows in batches:
            for first in range(0, all_rows.num_rows, 256):
                b = all_rows.slice(first, 256)
                sizes, sums, rare = [], np.zeros((b.num_rows, parts + 2)), []
                for i, t in enumerate(b.column(0).cast(pa.binary())):
                    words = (t.as_py() or b"").lower().split()
                    at, n, other = [], [], []
                    for w, uses in Counter(words).items():
                        j = index.get(w)
                        if j is None:
                            other.append({"word": w, "n": uses})
                        else:
                            at.append(j)
                            n.append(uses)
                    sums[i] = end + np.array(n, float) @ facts[at] if at else end
                    sizes.append(len(words) + 1)
                    rare.append(other)
                cols = [pa.array(sizes, pa.int64()), pa.array(list(sums)), pa.array(rare, kind).cast(final)]
                yield pa.RecordBatch.from_arrays([*b.columns[1:-1], *cols], [*names, "n_tokens", "sums", "rare"])

    head = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:-1]]
    schema = ", ".join([*head, "n_tokens long, sums array<double>, rare array<struct<word:string,n:long>>"])
    part = stored(rows.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "lm-documents")
    facts_of = table.select("word", in_all.alias("c"), "ln")
    rest = (
        part.select("_row", F.explode("rare").alias("r")).select("_row", F.col("r.word").alias("word"), F.col("r.n").alias("m"))
        .join(facts_of, "word")
        .groupBy("_row")
        .agg(F.array(
            F.sum(F.col("m") * F.log10((F.col("c") + 0.5) / F.lit(whole))),
            F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).cast("double"),
            *[F.sum(F.col("m") * F.col("ln")[i]) for i in range(parts)],
        ).alias("more"))
    )
    done = part.drop("rare").join(rest, "_row", "left")
    total = [F.col("sums")[i] + F.coalesce(F.col("more")[i], F.lit(0.0)) for i in range(parts + 2)]
    joint = [t + F.lit(float(p)) for t, p in zip(total[2:], prior)]
    top_one = F.greatest(*joint) if parts > 1 else joint[0]
    score = top_one + F.log(functools.reduce(lambda a, x: a + x, [F.exp(j - top_one) for j in joint]))
    return done.select(
        *names, "n_tokens", total[1].cast("long").alias("n_known"), F.lit(n_tokens).cast("long").alias("train_tokens"),
        total[0].alias("base_score"), (score / LOG10).alias("score"),
    )

"""Multinomial Naive Bayes as relational Spark jobs (M1), many models in one pass.

Same estimates as ``pyspark.ml.classification.NaiveBayes`` (multinomial, additive
smoothing α) on exact term counts over the training vocabulary:

    log π_c   = ln(W_c + α) − ln(W + K·α)          W_c = Σ weights of class-c rows
    log θ_ct  = ln(S_ct + α) − ln(S_c + V·α)       S_ct = Σ weight·tf over class-c rows
    score_c   = log π_c + Σ_t tf_t · log θ_ct      (terms outside the vocabulary ignored)

A *run* is one (label column, row weight) pair; several runs (all labels × all
rebalancing methods) are fitted by the same scan: the token stream is exploded once
and one ``groupBy(term)`` computes every S_ct as a conditional sum, with map-side
partial aggregation, so a very frequent term costs one row per partition in the
shuffle. Over-sampling is a weight (number of copies) and under-sampling a 0/1
weight: the sums are identical to fitting on the duplicated or filtered rows.
The per-run scalars (W_c, S_c, V: a few numbers per run) are the only values that
reach the driver; the term table is written to the shared checkpoint folder.

A row whose label is null in one run takes no part in that run and in no other way: the
other runs count it, and a run's vocabulary holds the terms of its own rows.
"""

from __future__ import annotations

import math
import re
from functools import reduce
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.operators.features import explode_terms
from toxiscope.operators.term_join import BROADCAST_MAX_BYTES, join_terms
from toxiscope.session import cut_lineage

CLASSES = (0, 1)


@dataclass
class NBRun:
    name: str
    label_col: str
    weight: Column = field(default_factory=lambda: F.lit(1.0))


@dataclass
class NBModel:
    """Fitted twin: ``terms`` (term, lt{c}_{run} …) plus per-run log priors."""

    terms: DataFrame
    runs: list[str]
    log_prior: dict[str, dict[int, float]]
    vocab_sizes: dict[str, int]
    smoothing: float
    size: int  # bytes of the term table
    occurrences: float

    @property
    def vocab_size(self) -> int:
        """Terms of the largest run."""
        return max(self.vocab_sizes.values())


def _s(c: int, run: str) -> str:
    return f"s{c}_{run}"


def _lt(c: int, run: str) -> str:
    return f"lt{c}_{run}"


def nb_fit(
    train: DataFrame,
    runs: list[NBRun],
    tokens_col: str = "tokens",
    smoothing: float = 1.0,
    checkpoint: bool = True,
    text_col: str | None = None,
) -> NBModel:
    """Fit one NB model per run on ``train`` (label columns plus either a token array
    ``tokens_col`` or raw text ``text_col``, tokenized and stop-word filtered here)."""
    if not runs:
        raise ValueError("need at least one run")
    names = [r.name for r in runs]
    bad = [n for n in names if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", n)]
    if bad:
        raise ValueError(f"run names must be identifiers: {bad}")
    if len(set(names)) != len(names):
        raise ValueError("run names must be unique")
    src = F.col(text_col) if text_col else F.col(tokens_col)
    rows = train.select(
        src.alias("_src"),
        *[F.col(r.label_col).cast("int").alias(f"y_{r.name}") for r in runs],
        *[r.weight.cast("double").alias(f"w_{r.name}") for r in runs],
    ).where(reduce(lambda a, b: a | b, [F.col(f"y_{r.name}").isNotNull() for r in runs]))

    # W_c per run: one global aggregate over document rows.
    prior_aggs = [
        F.sum(F.when(F.col(f"y_{r.name}") == c, F.col(f"w_{r.name}")).otherwise(0.0)).alias(f"W{c}_{r.name}")
        for r in runs
        for c in CLASSES
    ]
    prior_row = rows.agg(*prior_aggs).first()

    # S_ct per run: explode tokens once, one groupBy(term) with conditional sums.
    keep = [c for c in rows.columns if c != "_src"]
    exploded = explode_terms(
        rows, keep, text_col="_src" if text_col else None, tokens_col=None if text_col else "_src"
    )
    sums = [
        F.sum(F.when(F.col(f"y_{r.name}") == c, F.col(f"w_{r.name}")).otherwise(0.0)).alias(_s(c, r.name))
        for r in runs
        for c in CLASSES
    ]
    # occurrences in a run's own rows: runs of one label column share them
    of_label = {r.name: f"n_{runs[[x.label_col for x in runs].index(r.label_col)].name}" for r in runs}
    used = [
        F.sum(F.col(f"y_{n[2:]}").isNotNull().cast("long")).alias(n) for n in dict.fromkeys(of_label.values())
    ]
    terms = exploded.groupBy("term").agg(F.count(F.lit(1)).alias("occurrences"), *used, *sums)
    terms = cut_lineage(terms) if checkpoint else terms.persist()

    tot = terms.agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("occurrences"),
        F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("chars"),
        F.count(F.lit(1)).alias("rows"),
        *[F.sum((F.col(n) > 0).cast("long")).alias(n) for n in dict.fromkeys(of_label.values())],
        *[F.sum(_s(c, r.name)).alias(_s(c, r.name)) for r in runs for c in CLASSES],
    ).first()
    vocab = {r.name: int(tot[of_label[r.name]] or 0) for r in runs}
    if not all(vocab.values()):
        raise ValueError("the training rows hold no terms: the vocabulary is empty")

    log_prior: dict[str, dict[int, float]] = {}
    lt_cols = []
    for r in runs:
        w = {c: float(prior_row[f"W{c}_{r.name}"] or 0.0) for c in CLASSES}
        denom = math.log(w[0] + w[1] + len(CLASSES) * smoothing)
        log_prior[r.name] = {c: math.log(w[c] + smoothing) - denom for c in CLASSES}
        for c in CLASSES:
            s_c = float(tot[_s(c, r.name)] or 0.0)
            theta = F.log(F.col(_s(c, r.name)) + F.lit(smoothing)) - F.lit(math.log(s_c + vocab[r.name] * smoothing))
            lt_cols.append(F.when(F.col(of_label[r.name]) > 0, theta).alias(_lt(c, r.name)))
    model_terms = terms.select("term", "occurrences", *lt_cols)
    size = int(tot["chars"]) + int(tot["rows"]) * (8 * (1 + len(lt_cols)) + 32)
    return NBModel(model_terms, names, log_prior, vocab, smoothing, size, float(tot["occurrences"]))


def nb_log_theta(model: NBModel, run: str) -> DataFrame:
    """``term, log_theta0, log_theta1`` of one run (one row per vocabulary term)."""
    return model.terms.where(F.col(_lt(0, run)).isNotNull()).select(
        "term", F.col(_lt(0, run)).alias("log_theta0"), F.col(_lt(1, run)).alias("log_theta1")
    )


def nb_predict(
    model: NBModel,
    df: DataFrame,
    key: str,
    tokens_col: str = "tokens",
    keep_cols: list[str] | None = None,
    text_col: str | None = None,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Scores of every run for every row of ``df``.

    Output: ``key, keep_cols…, run, score0, score1, margin, probability, prediction``.
    Tokens are first counted per ``(key, term)``, so a repeated token meets the term table
    once. A table within ``broadcast_max_bytes`` (measured when it was fitted) is broadcast
    and nothing is shuffled on ``term``; beyond it see :func:`join_terms`. The per-key sums
    are left-joined back to the rows on the unique ``key``, so a row without any vocabulary
    term keeps its prior and no null join key piles up in one partition.
    """
    keep_cols = list(keep_cols or [])
    terms = explode_terms(df, [key], text_col=text_col, tokens_col=None if text_col else tokens_col)
    counted = terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("_tf"))
    sums = [F.sum(F.col("_tf") * F.col(_lt(c, r))).alias(f"d{c}_{r}") for r in model.runs for c in CLASSES]
    met = join_terms(counted, model.terms, model.size, "occurrences", model.occurrences, broadcast_max_bytes)
    per_key = met.groupBy(key).agg(*sums)
    per_doc = df.select(key, *keep_cols).join(per_key, key, "left")
    parts = []
    for r in model.runs:
        lp = model.log_prior[r]
        parts.append(
            f"'{r}', coalesce(d0_{r}, 0D) + ({lp[0]!r}D), coalesce(d1_{r}, 0D) + ({lp[1]!r}D)"
        )
    long = per_doc.select(
        key,
        *keep_cols,
        F.expr(f"stack({len(parts)}, {', '.join(parts)}) as (run, score0, score1)"),
    )
    margin = F.col("score1") - F.col("score0")
    return long.select(
        key,
        *keep_cols,
        "run",
        "score0",
        "score1",
        margin.alias("margin"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("probability"),
        (margin > 0).cast("int").alias("prediction"),
    )

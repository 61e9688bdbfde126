"""Class rebalancing (B1–B3): weighting, over-sampling, under-sampling.

All three are map-only once two scalars (rows, positives) are known: no shuffle,
no global sort, no per-class window (the negative class can hold nearly all rows).
Apply them to the training part only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxiscope.functions.hashing import unit_hash
from toxiscope.operators.profile import balancing_ratio

WEIGHT_COL = "classWeightCol"
SAMPLE_SEED = 2024  # must differ from the split seed, or kept rows correlate with the split
METHODS = ("weight", "oversample", "undersample")


def weight_expr(label: str, ratio: float):
    """B1 rule: label 1 → r, label 0 → 1 − r, with r = (N − pos) / N; a null label has no weight."""
    return F.when(F.col(label) == 1, F.lit(ratio)).when(F.col(label).isNotNull(), F.lit(1.0 - ratio))


def class_weights(
    df: DataFrame, label: str, weight_col: str = WEIGHT_COL, ratio: float | None = None
) -> DataFrame:
    """B1: append the class weight column (a literal-only expression, stays in codegen)."""
    if ratio is None:
        _, _, ratio = balancing_ratio(df, label)
    return df.withColumn(weight_col, weight_expr(label, ratio))


def oversample_copies_expr(label: str, key: str, pos: int, neg: int, seed: int = SAMPLE_SEED):
    """Number of copies of each row for a ≈1:1 ratio.

    Positives get ⌊neg/pos⌋ copies plus one more with probability frac(neg/pos)
    (decided by a hash of the key, so it is reproducible); negatives keep one.
    """
    if pos == 0:
        return F.lit(1)
    q = neg / pos
    base, frac = math.floor(q), q - math.floor(q)
    extra = (unit_hash(key, seed) < F.lit(frac)).cast("int")
    return F.when(F.col(label) == 1, F.greatest(F.lit(base) + extra, F.lit(1))).otherwise(F.lit(1))


def undersample_keep_expr(label: str, key: str, pos: int, neg: int, seed: int = SAMPLE_SEED):
    """Keep every positive; keep a negative with probability pos/neg (hash decided)."""
    if neg == 0:
        return F.lit(True)
    keep_rate = min(1.0, pos / neg)
    return (F.col(label) == 1) | (unit_hash(key, seed) < F.lit(keep_rate))


def oversample(
    df: DataFrame,
    label: str,
    key: str,
    seed: int = SAMPLE_SEED,
    counts: tuple[int, int] | None = None,
) -> DataFrame:
    """B2: duplicate positives to ≈1:1; adds ``copy`` (1-based).

    The copies of one row are hash-partitioned by ``(key, copy)``: with a very rare
    positive class one row can have as many copies as there are negatives, and
    leaving them where ``explode`` made them would put that whole group in one task.
    """
    n, pos = counts if counts is not None else balancing_ratio(df, label)[:2]
    copies = oversample_copies_expr(label, key, pos, n - pos, seed)
    dup = df.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return dup.repartition(key, "copy")  # the session's shuffle partitions; plans nothing yet


def undersample(df: DataFrame, label: str, key: str, seed: int = SAMPLE_SEED) -> DataFrame:
    """Drop negatives at random (by key hash) to ≈1:1; a pure filter."""
    n, pos, _ = balancing_ratio(df, label)
    return df.where(undersample_keep_expr(label, key, pos, n - pos, seed))


def rebalance(df: DataFrame, label: str, key: str, method: str, seed: int = SAMPLE_SEED) -> DataFrame:
    """One entry point for the three published experiments (+ ``none``)."""
    if method == "weight":
        return class_weights(df, label)
    if method == "oversample":
        return oversample(df, label, key, seed).drop("copy")
    if method == "undersample":
        return undersample(df, label, key, seed)
    if method == "none":
        return df
    raise ValueError(f"unknown rebalancing method {method!r}; use one of {METHODS} or 'none'")


def method_weight_expr(method: str, label: str, key: str, pos: int, n: int, seed: int = SAMPLE_SEED):
    """Per-row training weight that has the same effect as ``method`` on count-based
    estimators (Naive Bayes sums): weight, number of copies, or kept (1) / dropped (0)."""
    neg = n - pos
    if method == "weight":
        return weight_expr(label, (n - pos) / n if n else 0.0)
    if method == "oversample":
        return oversample_copies_expr(label, key, pos, neg, seed).cast("double")
    if method == "undersample":
        return undersample_keep_expr(label, key, pos, neg, seed).cast("double")
    if method == "none":
        return F.lit(1.0)
    raise ValueError(f"unknown rebalancing method {method!r}")


COPIES_COL = "sampleWeight"


def rebalance_for_fit(
    df: DataFrame,
    label: str,
    key: str,
    method: str,
    supports_weight: bool,
    seed: int = SAMPLE_SEED,
    counts: tuple[int, int] | None = None,
) -> tuple[DataFrame, str | None]:
    """Training rows and weight column for an estimator.

    For estimators with a weight column, over-sampling is a copy count used as the
    row weight: the weighted loss (or NB sums) equals the one over duplicated rows,
    but no copy is materialized, so a rare positive with many copies does not grow
    one partition (or one CV fold) by as many rows as all negatives together.
    Estimators without weights get real copies, re-spread by ``(key, copy)``.
    ``counts`` = (rows, positives) when already known (saves one pass).
    """
    if counts is None and method in ("weight", "oversample", "undersample"):
        counts = balancing_ratio(df, label)[:2]
    if method == "weight":
        n, pos = counts
        return df.withColumn(WEIGHT_COL, weight_expr(label, (n - pos) / n)), WEIGHT_COL
    if method == "oversample":
        n, pos = counts
        copies = oversample_copies_expr(label, key, pos, n - pos, seed)
        if supports_weight:
            return df.withColumn(COPIES_COL, copies.cast("double")), COPIES_COL
        return oversample(df, label, key, seed, counts=(n, pos)).drop("copy"), None
    if method == "undersample":
        n, pos = counts
        return df.where(undersample_keep_expr(label, key, pos, n - pos, seed)), None
    if method == "none":
        return df, None
    raise ValueError(f"unknown rebalancing method {method!r}; use one of {METHODS} or 'none'")

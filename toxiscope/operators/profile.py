"""Label profiling (A1–A5): all labels in one pass, partial aggregation on the map side."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_counts(df: DataFrame, labels: list[str]) -> DataFrame:
    """A1: ``label, positives, total`` for every label from a single aggregate job."""
    aggs = [F.sum((F.col(l) == 1).cast("long")).alias(f"pos_{l}") for l in labels]
    totals = [F.count(l).alias(f"n_{l}") for l in labels]  # rows whose label is known
    wide = df.agg(*totals, *aggs)
    parts = ", ".join(f"'{l}', pos_{l}, n_{l}" for l in labels)
    long = wide.select(F.expr(f"stack({len(labels)}, {parts}) as (label, positives, total)"))
    return long.select("label", F.coalesce("positives", F.lit(0)).alias("positives"), "total")


def balancing_ratio(df: DataFrame, label: str) -> tuple[int, int, float]:
    """A2: ``(total, positives, (total - positives) / total)`` as driver scalars.

    Two numbers from one aggregate over the rows whose label is known. The reference
    raises nothing on an empty frame (NaN) — we refuse it.
    """
    row = df.agg(
        F.count(label).alias("n"), F.sum((F.col(label) == 1).cast("long")).alias("pos")
    ).first()
    n, pos = int(row["n"]), int(row["pos"] or 0)
    if n == 0:
        raise ValueError("cannot compute a balancing ratio on an empty frame")
    return n, pos, (n - pos) / n


def label_distribution(df: DataFrame, labels: list[str]) -> DataFrame:
    """A3: count and share of positives per label.

    ``pct_truncated`` is the percentage cut (not rounded) to one decimal, the way the
    published table shows it.
    """
    counts = label_counts(df, labels)
    share = F.try_divide(F.col("positives"), F.col("total"))
    return counts.select(
        "label",
        "positives",
        "total",
        F.round(share, 6).alias("share"),
        (F.floor(share * 1000) / 10).alias("pct_truncated"),
    )


def tagged_share(df: DataFrame, labels: list[str]) -> DataFrame:
    """A4: rows with at least one positive label, out of all rows."""
    tagged = (F.greatest(*[F.coalesce(F.col(l), F.lit(0)) for l in labels]) == 1).cast("long")
    return df.agg(F.sum(tagged).alias("tagged"), F.count(F.lit(1)).alias("total")).select(
        F.coalesce("tagged", F.lit(0)).alias("tagged"),
        "total",
        F.round(F.try_divide(F.col("tagged"), F.col("total")), 6).alias("share"),
    )


def label_correlation(df: DataFrame, labels: list[str]) -> DataFrame:
    """A5: Pearson correlation of every label pair (a < b in the given order), one job.

    A constant label has no correlation: NULL (``corr`` gives NaN, or fails under ANSI).
    """
    pairs = list(combinations(labels, 2))
    def pearson(a: str, b: str):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        # try_divide: a constant column (zero spread) gives NULL, also under ANSI mode
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    aggs = [pearson(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    long = wide.select(F.expr(f"stack({len(pairs)}, {parts}) as (label_a, label_b, corr)"))
    c = F.col("corr")
    return long.select(
        "label_a", "label_b", F.when(F.isnan(c), None).otherwise(F.round(c, 6)).alias("corr")
    )

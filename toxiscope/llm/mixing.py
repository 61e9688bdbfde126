"""Mixing sources to target weights, DataFrame functions only.

One aggregation gives each source's size. The targets are water-filled over the small
source table: a source's share is proportional to its weight, capped at a multiple of
its own size; what a cap cuts off is shared again among the others until no target is
above its cap. A source's repetition rate is target / size, and a document is emitted
``floor(rate)`` times plus one more time when its hash-seeded uniform number is below
the fraction. The number depends on the document's key and the seed only, so reruns and
retried tasks agree.

Defined results: a null text has size 0; a null source is a source of its own, last in
the order; sources are ordered by code point and take the weights in turn; a source
whose documents are all empty has target 0 and its documents are emitted 0 times;
rows that repeat a key get the same draw; an empty table gives an empty result. Extra
columns of any name pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import broadcast_bounded, free_name, stored
from toxiscope.operators.ranking import global_index

#: Production parameters of the registered query (fixed by its contract).
WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
CAP = 2.0
SEED = 20


def source_targets(
    sizes: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: tuple[int, ...] = WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    cap: float = CAP,
) -> DataFrame:
    """``(source, source_size, weight, target, rate)``, one row per source.

    Each round is one aggregate over the source table (two numbers reach the driver):
    sources whose proportional share reaches their cap are fixed there and the rest is
    shared again. Every round but the last fixes at least one more source.
    """
    per = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size"))
    ranked = global_index(per, [F.col("source").isNull(), F.col("source")], "_rank")
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    base = stored(ranked.withColumn("weight", pick.cast("long")).drop("_rank"), "mix-sources")
    limit = F.col("source_size") * F.lit(float(cap))
    total = base.agg(F.sum("source_size")).first()[0] or 0
    budget = float(budget_share) * total
    # level = target per unit of weight; below it a source keeps its share, else its cap
    level = 0.0
    while True:
        capped = limit <= F.col("weight") * F.lit(level)
        held, open_weight = base.agg(
            F.sum(F.when(capped, limit).otherwise(0.0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))
        ).first()
        if not open_weight:
            break
        new = (budget - held) / open_weight
        if new <= level:
            break
        level = new
    target = F.least(limit, F.col("weight") * F.lit(level))
    return base.select(
        "source",
        "source_size",
        "weight",
        target.alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def copies(rate: Column, key: Column, seed: int = SEED) -> Column:
    """floor(rate) plus a Bernoulli copy; its uniform number is the first 52 bits of
    md5("seed:key"), the same in every engine and on every run (a null key is empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    uniform = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    whole = F.floor(rate)
    return (whole + F.when(uniform < rate - whole, 1).otherwise(0)).cast("long")


def with_rates(docs: DataFrame, targets: DataFrame, source: str = "source") -> tuple[DataFrame, str]:
    """Attach a struct column with each document's source row; returns its name.

    The source table is broadcast only within a byte budget measured on it. Beyond it the
    documents of a source are dealt over ``SALTS`` join keys, so that a hot source is no
    single task, and the source rows are repeated once per salt.
    """
    info = free_name(docs, "_mix")
    fields = F.struct("source_size", "weight", "target", "rate").alias(info)
    n, width = targets.agg(
        F.count(F.lit(1)), F.max(F.coalesce(F.octet_length("source"), F.lit(0)))
    ).first()
    other, slot = free_name(docs, "_mix_source"), free_name(docs, "_mix_slot")
    right = targets.select(F.col("source").alias(other), fields)
    small = broadcast_bounded(right, n, 64 + (width or 0))
    if small is not right:
        return docs.join(small, docs[source].eqNullSafe(F.col(other)), "left").drop(other), info
    salts = 64
    salt = free_name(docs, "_mix_salt")
    left = docs.withColumn(salt, F.pmod(F.xxhash64(*docs.columns), F.lit(salts)))
    right = right.withColumn(slot, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    on = (left[salt] == F.col(slot)) & left[source].eqNullSafe(F.col(other))
    return left.join(right, on, "left").drop(other, slot, salt), info


def mix(
    docs: DataFrame,
    targets: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """Every document as often as the mix takes it; the columns of ``docs`` and no other."""
    joined, info = with_rates(docs, targets, source)
    n = copies(F.col(f"{info}.rate"), F.col(key), seed)
    return joined.withColumn(info, F.explode(F.array_repeat(F.lit(1), n.cast("int")))).drop(info)

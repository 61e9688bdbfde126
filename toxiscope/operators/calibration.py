"""Probabilities for margins (M10): isotonic calibration by pooling adjacent violators.

The fit sums the rows to one step per distinct score (map-side combine), range-sorts the
steps, and pools adjacent violators within each range partition. While the last block of one
partition is not below the first of the next, neighbouring partitions are merged two by two
and pooled again, so only what may still pool meets, and the rounds are at most the logarithm
of the partition count. A partition's blocks have strictly increasing shares of positives,
hence at most in the order of n^(2/3) blocks stand for n rows.

The fitted probability is a step function: a score gets the value of the last block that
begins at or below it, a score below all blocks that of the first.

Defined results: rows with a null label, or a null or NaN score, take no part in a fit; a
null or NaN score gets a null probability, as does every score when the fit had no row.
Ties are one step. Columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toxiscope.session import cut_lineage

BLOCK = "part int, low double, high double, rows long, positives long"
NAMES = ["part", "low", "high", "rows", "positives"]


def _known(score: Column) -> Column:
    return score.isNotNull() & ~F.isnan(score)


def _pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (part, low) → blocks of strictly increasing share, part by part."""
    part, stack = None, []

    def out() -> pa.RecordBatch:
        cols = list(zip(*stack))
        types = [pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(stack), pa.int32()), *(pa.array(c, t) for c, t in zip(cols, types))], NAMES
        )

    for b in batches:
        for at, low, high, rows, positives in zip(*[c.to_pylist() for c in b.columns]):
            if at != part:
                if stack:
                    yield out()
                part, stack = at, []
            while stack and stack[-1][3] * rows >= positives * stack[-1][2]:  # whole numbers, exact
                before = stack.pop()
                low, rows, positives = before[0], rows + before[2], positives + before[3]
            stack.append((low, high, rows, positives))
    if stack:
        yield out()


def _violated(blocks: DataFrame) -> bool:
    """Does a partition end at or above the share with which the next one begins?"""
    share = F.col("positives") / F.col("rows")
    ends = blocks.groupBy("part").agg(F.min_by(share, "low").alias("first"), F.max_by(share, "low").alias("last"))
    before = F.lag("last").over(Window.orderBy("part"))  # one row a partition
    return not ends.withColumn("before", before).where("before >= first").isEmpty()


def fit_calibration(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Blocks ``low, high, rows, positives, probability`` in increasing order of both."""
    s = F.col(score).cast("double")
    steps = df.where(F.col(label).isNotNull() & _known(s)).groupBy(s.alias("low")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(label) == 1).alias("positives")
    )
    steps = steps.orderBy("low").select(F.spark_partition_id().alias("part"), "low", F.col("low").alias("high"), "rows", "positives")
    # written first: the partitions of the sort, with their order, are what the first pass pools
    blocks = cut_lineage(cut_lineage(steps).mapInArrow(_pooled, BLOCK))
    while _violated(blocks):
        merged = blocks.withColumn("part", F.floor(F.col("part") / 2).cast("int"))
        blocks = cut_lineage(merged.repartition("part").sortWithinPartitions("part", "low").mapInArrow(_pooled, BLOCK))
    return blocks.select("low", "high", "rows", "positives", (F.col("positives") / F.col("rows")).alias("probability"))


def calibrate(df: DataFrame, blocks: DataFrame, score: str = "score", out: str = "probability") -> DataFrame:
    """``df`` with the probability of ``score`` in column ``out`` (replaced where it is there).

    The distinct scores and the blocks are range-sorted together; a running maximum within a
    partition and the maximum of the partitions before it (one row each) find the block, so
    neither side is sent whole to a task, and a score of many rows is one row of the sort.
    """
    s = F.col(score).cast("double")
    asked = df.select(s.alias("s")).where(_known(F.col("s"))).distinct()
    both = asked.select("s", F.lit(1).alias("kind"), F.lit(None).cast("double").alias("p")).unionByName(
        blocks.select(F.col("low").alias("s"), F.lit(0).alias("kind"), F.col("probability").alias("p"))
    )
    both = cut_lineage(both.orderBy("s", "kind").withColumn("part", F.spark_partition_id()))
    ends = both.groupBy("part").agg(F.max("p").alias("top"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    carried = ends.select("part", F.max("top").over(earlier).alias("carried"))
    here = Window.partitionBy("part").orderBy("s", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    least = F.lit(blocks.agg(F.min("probability")).first()[0]).cast("double")
    found = both.withColumn("seen", F.max("p").over(here)).join(F.broadcast(carried), "part").where("kind = 1")
    taken = {c.lower() for c in [*df.columns, out]}
    key, value = "_score", "_found"
    while key in taken or value in taken:
        key, value = key + "_", value + "_"
    found = found.select(F.col("s").alias(key), F.coalesce("seen", "carried", least).alias(value))
    return df.join(found, s == F.col(key), "left").drop(key).withColumn(out, F.col(value)).drop(value)

"""Areas under the ROC and precision-recall curves (M11), exact, from tie groups.

Rows are first summed to one row per distinct score (map-side combine), so ties are one step
of both curves. The groups are range-sorted by score; running counts are prefix sums within a
partition plus the totals of the partitions before it, which are one row a partition. No
score is binned and no partition holds all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from toxiscope.session import cut_lineage


def ranking_areas(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row ``positives, negatives, auc_roc, auc_pr``.

    A row with a null label or score takes no part. ROC: the share of (positive, negative)
    pairs in order, ties half. PR: trapezoids over (recall, precision), from recall 0 at the
    first step's precision, as Spark's evaluator draws it. Both are NULL without a row of
    each class (PR: without a positive).
    """
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    yes = (F.col(label) == 1).cast("long")
    steps = known.groupBy(F.col(score).alias("s")).agg(F.sum(yes).alias("p"), F.sum(1 - yes).alias("n"))
    steps = cut_lineage(steps.orderBy(F.desc("s")).withColumn("part", F.spark_partition_id()))
    totals = steps.groupBy("part").agg(F.sum("p").alias("part_p"), F.sum("n").alias("part_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = totals.select(
        "part", F.coalesce(F.sum("part_p").over(earlier), F.lit(0)).alias("off_p"),
        F.coalesce(F.sum("part_n").over(earlier), F.lit(0)).alias("off_n"),
    )
    here = Window.partitionBy("part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = steps.join(F.broadcast(offsets), "part").select(
        "p", "n", (F.col("off_p") + F.sum("p").over(here)).alias("tp"), (F.col("off_n") + F.sum("n").over(here)).alias("fp")
    )
    before_tp, before_fp = F.col("tp") - F.col("p"), F.col("fp") - F.col("n")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    # before the first step, its own precision
    last = F.when(before_tp + before_fp == 0, precision).otherwise(F.try_divide(before_tp, before_tp + before_fp))
    sums = curve.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("positives"), F.coalesce(F.sum("n"), F.lit(0)).alias("negatives"),
        F.sum(F.col("n") * (before_tp + F.col("p") / 2)).alias("ordered"), F.sum(F.col("p") * (precision + last) / 2).alias("area"),
    )
    return sums.select(
        "positives", "negatives", F.try_divide("ordered", F.col("positives").cast("double") * F.col("negatives")).alias("auc_roc"),
        F.try_divide("area", F.col("positives")).alias("auc_pr"),
    )

"""Global dense row numbering without a single-partition window.

``row_number() over (order by …)`` with no partition moves every row into one task.
Here the frame is range-partitioned and sorted by ``orderBy``; within a sorted
partition the position is ``monotonically_increasing_id()`` minus the partition's
base, and per-partition offsets come from a table with one row per partition
(bounded by the partition count, so broadcasting it is safe). The sorted frame is
checkpointed once so both uses see the same partitions, also after a task retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toxiscope.session import cut_lineage


def global_index(df: DataFrame, order: list[Column], index_col: str = "index") -> DataFrame:
    """Add a 0-based position in the total order ``order`` (make the order strict)."""
    pid = F.spark_partition_id()
    ranked = cut_lineage(
        df.orderBy(*order).select(
            "*",
            pid.alias("_pid"),
            (F.monotonically_increasing_id() - F.shiftleft(pid.cast("long"), 33)).alias("_local"),
        )
    )
    sizes = ranked.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_off"),
    )
    return (
        ranked.join(F.broadcast(offsets), "_pid")
        .withColumn(index_col, (F.col("_off") + F.col("_local")).cast("long"))
        .drop("_pid", "_local", "_off")
    )

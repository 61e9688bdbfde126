"""Connected components of a link table by alternating large-star and small-star steps.

Each step is one min-aggregation per node (combined before the shuffle) and one join;
the links are written to the shared folder after every round. Rounds grow with the
logarithm of the longest chain. Nothing but two counters reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxiscope.llm.common import drop_stored, stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Connect each node's larger (large) or smaller (small) neighbours to its least one."""
    if large:
        both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("least"))
        joined = both.where("dst > src").join(least, "src")
        return joined.select(F.col("dst").alias("src"), F.col("least").alias("dst")).where("src <> dst").distinct()
    down = links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = down.groupBy("src").agg(F.min("dst").alias("least"))
    moved = down.join(least, "src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    kept = least.select("src", F.col("least").alias("dst"))
    return moved.unionByName(kept).where("src <> dst").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(src, dst)``; component = least node.

    Links may repeat, run either way and hold loops; nodes without a link do not appear.
    """
    now = stored(links.select("src", "dst").where("src <> dst").distinct(), "components")
    state = None
    while True:
        new = stored(_star(_star(now, True), False), "components")
        sums = new.agg(
            F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("src", "dst")), F.lit(0)),
            F.coalesce(F.sum(F.xxhash64("dst", "src").cast("decimal(38,0)")), F.lit(0)),
        ).first()
        drop_stored(now)
        now = new
        if tuple(sums) == state:
            break
        state = tuple(sums)
    nodes = now.select(F.col("src").alias("node"), F.col("dst").alias("component"))
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return nodes.unionByName(roots)

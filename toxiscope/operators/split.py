"""Train / test separation by a deterministic hash of the row key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxiscope.functions.hashing import unit_hash

SPLIT_SEED = 42
TEST_FRACTION = 0.2


def hash_split(
    df: DataFrame, key: str, seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION
) -> DataFrame:
    """Add ``split_u`` (uniform in [0,1)) and ``is_test`` (``split_u < test_fraction``).

    Map-only: no shuffle, no sort, and the same rows land on the same side whatever
    the partitioning or a task retry (``randomSplit`` gives neither guarantee).
    """
    u = unit_hash(key, seed)
    return df.withColumn("split_u", u).withColumn("is_test", F.col("split_u") < F.lit(test_fraction))


def train_test(
    df: DataFrame, key: str, seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION
) -> tuple[DataFrame, DataFrame]:
    """(train, test) parts of ``df``; both are filters of one lazy plan."""
    marked = hash_split(df, key, seed, test_fraction)
    train = marked.where(~F.col("is_test")).drop("split_u", "is_test")
    test = marked.where(F.col("is_test")).drop("split_u", "is_test")
    return train, test

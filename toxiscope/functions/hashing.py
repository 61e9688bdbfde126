"""Deterministic per-row pseudo-random numbers from a key (no dependence on partitioning)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_POW_32 = 4294967296.0


def unit_hash(key: str | Column, seed: int | str) -> Column:
    """u in [0, 1): first 32 bits of md5(key ':' seed), scaled.

    The same number comes out of any engine with md5 and hex parsing, so splits and
    samples built on it can be checked outside Spark. Unlike ``rand``/``randomSplit``
    it does not change with the number or order of partitions, and a recomputed
    task (lost executor) gives the same rows.
    """
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(_TWO_POW_32)


"""Join per-document term rows with a per-term table, whatever the table's size.

Within a byte budget measured on the term table the whole of it is broadcast. Beyond the
budget only the hot terms are: those with at least 1 / ``HOT_SHARE`` of all occurrences, of
which there can be no more than ``HOT_SHARE``, so that broadcast is bounded by arithmetic.
The other terms meet in a shuffle join, where no key holds more than that share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 10_000
BROADCAST_MAX_BYTES = 64 << 20


def table_bytes(terms: DataFrame, n_columns: int) -> int:
    """Bytes of the term table: its strings, and 8 for each other column plus row overhead."""
    n, chars = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    return int(chars) + int(n) * (8 * n_columns + 32)


def join_terms(
    rows: DataFrame,
    terms: DataFrame,
    size: int,
    weight: str | Column,
    total: float,
    max_bytes: int = BROADCAST_MAX_BYTES,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Inner join of ``rows`` and ``terms`` on ``term``.

    ``weight`` is a term's number of occurrences, ``total`` their sum, ``size`` the bytes
    of ``terms``.
    """
    if size <= max_bytes:
        return rows.join(F.broadcast(terms), "term")
    occurrences = F.col(weight) if isinstance(weight, str) else weight
    is_hot = occurrences * F.lit(float(hot_share)) >= F.lit(float(total))
    hot, rest = terms.where(is_hot), terms.where(~is_hot)
    names = F.broadcast(hot.select("term"))
    cold_rows = rows.join(names, "term", "left_anti")
    # the terms of a partition are a hash table: neither side is sorted
    return rows.join(F.broadcast(hot), "term").unionByName(cold_rows.join(rest.hint("shuffle_hash"), "term"))

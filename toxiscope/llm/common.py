"""Helpers shared by the training-data operators: scratch tables, hashing, table reads.

Intermediate tables are written as Parquet under ``spark.checkpoint.dir`` (the shared
folder of the session), so a lost executor never sends a later stage back to the raw
input, and every reader sees the same row keys after a task retry.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from toxiscope.session import checkpoint_dir

#: ASCII white space of all contracts: blank and the five control characters 0x09-0x0D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/toxiscope-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_tight(df: DataFrame, name: str) -> DataFrame:
    """:func:`stored` for large tables: zstd, and the shuffle files of the job go when it ends."""
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path = f"{checkpoint_dir(spark).rstrip('/')}/toxiscope-llm/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table written by :func:`stored` that no later plan reads."""
    spark = df.sparkSession
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, as the contracts ask."""
    return F.translate(text, UPPER, UPPER.lower())


def count_words(text: Column) -> Column:
    """Number of words (long); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def id_remainder(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, mod ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m


def spread_rows(df: DataFrame) -> DataFrame:
    """Deal the rows evenly when the scan has fewer splits than the session has cores.

    Only the placement of rows changes, never a result; large inputs stay as they are.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * n) if df.rdd.getNumPartitions() < n else df


def broadcast_bounded(df: DataFrame, rows: int, width: int, budget: int = 8 << 20) -> DataFrame:
    """Broadcast hint when ``rows`` rows of at most ``width`` bytes are within ``budget`` bytes."""
    return F.broadcast(df) if rows * max(width, 1) <= budget else df

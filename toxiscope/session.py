"""Session-level helpers: the shared checkpoint folder and the spreading of small scans.

The library never builds a session and never picks a master. It reads
``spark.checkpoint.dir`` from the running session; only a local session (tests,
bench) without that setting gets a fresh scratch folder of its own.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session, registering it with the context.

    On a cluster the folder must be configured (``spark.checkpoint.dir``); a
    machine-local temporary folder is only made for ``local[...]`` masters.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{_CKPT_KEY} is not set; point it at a folder every executor can reach"
            )
        configured = tempfile.mkdtemp(prefix="toxiscope-ckpt-")
        spark.conf.set(_CKPT_KEY, configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of written intermediate results."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/toxiscope/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared folder, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as compressed Parquet to the shared folder and read it back.

    For wide rows such as token arrays, of which a checkpoint takes a multiple of the text.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition ``df`` by ``key`` when the scan gives fewer partitions than cores.

    A large input arrives in many file splits and is left alone (no extra shuffle of
    raw text). A small input stored as one row group would otherwise tokenize in a
    single task. The hash partitioning on ``key`` satisfies later ``groupBy(key, …)``
    and joins on ``key`` between frames spread this way without another exchange.
    """
    n = spread_partitions(df)
    return df.repartition(n, key) if n else df


def spread_partitions(df: DataFrame) -> int | None:
    """Partitions that :func:`spread` deals ``df`` out to; None when it is left alone."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return None
    # CPU-bound text work wants about two tasks per core, not the session's shuffle
    # partition number (often 200 for a few thousand rows); aggregations on the key
    # accept any partition count, and joins whose sides both come from here line up
    return max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * cores))


#: Least and usual bytes of a partition that an iterative estimator reads again and again.
SMALL_PARTITION = 1 << 20
FULL_PARTITION = 32 << 20


def size_by_bytes(df: DataFrame) -> DataFrame:
    """Coalesce ``df`` (a written table) to partitions of measured size.

    At most ``FULL_PARTITION`` bytes each on average; down to one per core as long as they
    hold ``SMALL_PARTITION`` bytes. An estimator that runs one job per gradient would else
    spend a few hundred rows' fit on starting near-empty tasks. Only ever lowers the count.
    """
    import math

    held = df.persist()
    try:
        held.count()
        size = int(str(held._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    finally:
        held.unpersist()
    cores = df.sparkSession.sparkContext.defaultParallelism
    want = max(math.ceil(size / FULL_PARTITION), min(cores, math.ceil(size / SMALL_PARTITION)), 1)
    return df.coalesce(want) if want < df.rdd.getNumPartitions() else df

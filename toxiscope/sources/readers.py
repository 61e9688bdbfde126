"""Scans: labelled comments (CSV / Parquet), message files, and the driver tables.

Schemas are always explicit; schema inference would cost a full extra pass over
the input and can turn a 0/1 label column into a string.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from toxiscope.functions.text import clean_text
from toxiscope.schema import COMMENT_SCHEMA, TEXT_COL
from toxiscope.session import spread


def read_comments(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType = COMMENT_SCHEMA,
    multi_line: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Labelled comments with a header row, columns found by their header names.

    A missing column raises; other columns are dropped, whatever the order. ``"`` is the
    escape, so quoted comments may hold commas, doubled quotes and, with ``multi_line``,
    newlines. Multi-line CSV is read by one task per file; files without newlines inside
    comments are split over many with ``multi_line=False``. A row with a wrong number of
    fields stops the read; with ``mode="DROPMALFORMED"`` it is left out. A null comment is
    the empty text; a label that is no integer is null (:func:`label_quality` counts them).
    """
    if fmt == "csv":
        reader = (
            spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
            .option("mode", mode).option("enforceSchema", False)
        )
        df = reader.csv(path)  # header names, every field a string; no pass over the data
    elif fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}; use 'csv' or 'parquet'")
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path} has no column {missing}; its columns are {df.columns}")
    cols = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols).fillna("", [c for c in (TEXT_COL,) if c in schema.names])


def label_quality(df: DataFrame, labels: list[str], text_col: str = TEXT_COL) -> DataFrame:
    """One row: ``rows``, ``empty_text``, and per label its null and its other-than-0/1 values.

    Rows with a null label take no part in that label's training and metrics, and in no
    other way; this counts them.
    """
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(F.trim(F.coalesce(text_col, F.lit(""))) == "").alias("empty_text")]
    for label in labels:
        aggs.append(F.count_if(F.col(label).isNull()).alias(f"null_{label}"))
        aggs.append(F.count_if(~F.col(label).isin(0, 1)).alias(f"other_{label}"))
    return df.agg(*aggs)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Message files, one message per file (lines are kept, joined by newlines).

    Unlike collecting the lines to the driver and concatenating them, every file
    stays a row, so a folder of any size is read in parallel. A file without any byte is
    the empty message; Spark's readers skip it, so it comes from the listing of the files.
    Schema: ``message_id long, clean_comment string``.
    """
    df = spark.read.text(path, wholetext=True)
    read = df.select(
        F.xxhash64(F.col("_metadata.file_path")).alias("message_id"),
        F.col("value").alias(TEXT_COL),
    )
    # the listing writes file:///x where the rows' path is file:/x
    name = F.regexp_replace("file", "^([^:/]+):///", "$1:/")
    listed = spark.createDataFrame([(f,) for f in df.inputFiles()], "file string").select(
        F.xxhash64(name).alias("message_id"), F.lit("").alias(TEXT_COL)
    )
    return read.unionByName(listed.join(read.select("message_id"), "message_id", "left_anti"))


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def training_frame(spark: SparkSession, sf_dir: str, clean: bool = True) -> DataFrame:
    """The labelled-comment frame built from the driver tables.

    ``documents ⋈ labels`` on ``doc_id`` → ``doc_id, clean_comment, toxic, low_quality``
    (``low_quality = 1 - quality``). A document without any known label is no training row;
    one null label leaves the document to the other label.
    The join is left to the optimizer: ``labels`` is the small side and AQE turns
    the shuffle join into a broadcast from its measured size, not from a guess.
    """
    docs = spread(load_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    labels = load_table(spark, sf_dir, "labels").where(
        F.col("toxic").isNotNull() | F.col("quality").isNotNull()
    )
    text = clean_text("text") if clean else F.coalesce(F.col("text"), F.lit(""))
    return docs.join(labels, "doc_id", "inner").select(
        "doc_id",
        text.alias(TEXT_COL),
        F.col("toxic").cast("int").alias("toxic"),
        (F.lit(1) - F.col("quality")).cast("int").alias("low_quality"),
    )


def label_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, toxic, low_quality`` from ``labels`` alone: no text and no join."""
    return load_table(spark, sf_dir, "labels").select(
        "doc_id", F.col("toxic").cast("int").alias("toxic"), (F.lit(1) - F.col("quality")).cast("int").alias("low_quality")
    )


def message_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as messages to score: ``message_id, clean_comment``.

    The id is ``conv_id:turn``, which no two turns share. Null text is empty.
    """
    conv = spread(load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id")
    return conv.select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"),
        F.coalesce(clean_text("text"), F.lit("")).alias(TEXT_COL),
    )

"""Structured Streaming scoring: new messages → fitted features + label models → sink.

Scoring is stateless (no aggregation), so there is no watermark and no state store;
exactly-once comes from the file sink's commit log plus the checkpoint, both in the
shared checkpoint folder, so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from toxiscope.functions.text import clean_text
from toxiscope.operators.score import score_labels
from toxiscope.schema import TEXT_COL
from toxiscope.session import cut_lineage, drop_path, scratch_path, spread_partitions


def score_stream(messages: DataFrame, features: PipelineModel, models: dict, key: str) -> DataFrame:
    """Streaming (or batch) frame ``key, clean_comment`` → ``key, label, prediction, probability``."""
    return score_labels(features.transform(messages), models, key)


def start_scoring(
    scored: DataFrame,
    sink_path: str,
    checkpoint_path: str,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Write a scored stream as Parquet (append)."""
    w = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint_path).outputMode("append")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(sink_path)


def read_message_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of text files as a stream: one message per file (``message_id, clean_comment``)."""
    r = spark.readStream.format("text").option("wholetext", True)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(folder)
    return df.select(F.xxhash64(F.col("_metadata.file_path")).alias("message_id"), F.col("value").alias(TEXT_COL))


def read_table_stream(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table as a stream, be it one file or a folder of part files."""
    r = spark.readStream.schema(spark.read.parquet(path).schema)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(fs_path).isDirectory():
        return r.parquet(path)
    # the file source watches a folder; the glob keeps it to the one file
    return r.option("pathGlobFilter", fs_path.getName()).parquet(fs_path.getParent().toString())


def stream_score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: fit weighted NB per label on the training frame, stream the
    documents table through it, and compare what the sink committed with the batch scores.

    ``label, rows, equal_to_batch``. The sink and the checkpoint are dropped afterwards.
    """
    from toxiscope.operators.balance import WEIGHT_COL, class_weights
    from toxiscope.operators.classifiers import make_classifier
    from toxiscope.operators.split import train_test
    from toxiscope.plans.training import prepare_features
    from toxiscope.schema import DRIVER_LABELS
    from toxiscope.sources.readers import training_frame

    train, test = train_test(training_frame(spark, sf_dir), "doc_id")
    fm, train_f, _ = prepare_features(train, test, "doc_id", DRIVER_LABELS, "hashing")
    models = {
        label: make_classifier("nb", label, weight_col=WEIGHT_COL).fit(class_weights(train_f, label))
        for label in DRIVER_LABELS
    }
    table = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    stream = read_table_stream(spark, f"{sf_dir.rstrip('/')}/documents.parquet").select("doc_id", "text")
    # files of few row groups would be scored by as few tasks; the stream is dealt out like the table
    docs = table.select("doc_id", "text")
    n = spread_partitions(docs)
    stream, docs = (stream.repartition(n, "doc_id"), docs.repartition(n, "doc_id")) if n else (stream, docs)
    text = F.coalesce(clean_text("text"), F.lit("")).alias(TEXT_COL)
    sink, ckpt = scratch_path(spark, "stream-sink"), scratch_path(spark, "stream-ckpt")
    q = start_scoring(score_stream(stream.select("doc_id", text), fm, models, "doc_id"), sink, ckpt)
    q.awaitTermination()
    asked, got = table.count(), spark.read.parquet(sink).groupBy("label").count().collect()
    short = {label: n for label in models if (n := {r["label"]: r["count"] for r in got}.get(label, 0)) < asked}
    if short:
        raise RuntimeError(f"the stream committed {short} rows of {asked} rows a label")
    batch = score_labels(fm.transform(docs.select("doc_id", text)), models, "doc_id")
    theirs = batch.select("doc_id", "label", F.col("prediction").alias("p"), F.col("probability").alias("b"))
    same = F.col("prediction").eqNullSafe(F.col("p")) & (F.abs(F.col("probability") - F.col("b")) < 1e-9)
    found = cut_lineage(
        spark.read.parquet(sink).join(theirs, ["doc_id", "label"], "left").groupBy("label").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(same).alias("equal_to_batch")
        )
    )
    drop_path(spark, sink)
    drop_path(spark, ckpt)
    return found

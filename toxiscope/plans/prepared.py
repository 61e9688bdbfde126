"""Shared building blocks of the driver-table plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxiscope.functions.text import clean_text
from toxiscope.operators.split import SPLIT_SEED, TEST_FRACTION, hash_split
from toxiscope.schema import TEXT_COL
from toxiscope.session import spread
from toxiscope.sources.readers import load_table, training_frame


def cleaned_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, clean_comment`` for every document (whole texts)."""
    docs = spread(load_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", clean_text("text").alias(TEXT_COL))


def labelled_documents(
    spark: SparkSession, sf_dir: str, seed: int = SPLIT_SEED, test_fraction: float = TEST_FRACTION
) -> DataFrame:
    """Training frame + ``is_test`` (hash split on ``doc_id``)."""
    return hash_split(training_frame(spark, sf_dir), "doc_id", seed, test_fraction).drop("split_u")


def split_parts(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    return labelled.where(~F.col("is_test")), labelled.where(F.col("is_test"))

"""Corpus preparation: language ID, line deduplication, SimHash near-duplicates, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's documents. All but
the last return the columns of the documents. ``run`` applies them to the documents table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxiscope.llm import langid, linededup, mixing, packing, simhash
from toxiscope.llm.common import count_words, free_name, id_remainder, read_table, spread_rows, stored

#: Documents whose predicted language is this unsure are rejected; so are texts without a
#: letter. Among L languages a score is at least 1 / L, so this rejects only texts that
#: look like no single language.
LEAST_SCORE = 0.3

#: None: a trained network, 64-bit fingerprints and a tokenizer are beyond SQL; the tests
#: hold the stages against brute force.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known language. The network learns as in the operator's query."""
    docs = spread_rows(docs)
    pred, score = free_name(docs, "_lang_pred"), free_name(docs, "_lang_score")
    net = langid.train(docs.where(id_remainder(F.col("doc_id"), 3) != 1))
    found = langid.predict(docs, net, out=(pred, score))
    if net is None:  # nothing is labelled: only texts without a letter can be told apart
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return found.where((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; documents with nothing left go with them."""
    return linededup.dedup_lines(docs, drop_emptied=True)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id."""
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask."""
    size = free_name(docs, "_size")
    sizes = stored(docs.select("source", count_words(F.col("text")).alias(size)).groupBy("source").agg(F.sum(size).alias(size)), "mix-sizes")
    return mixing.mix(docs, mixing.source_targets(sizes, size=size))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "pipeline-" + name.lower().replace(" ", "-"))
    return docs

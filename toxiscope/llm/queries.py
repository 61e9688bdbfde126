"""Registered queries of the training-data operators (production parameters, whole tables)."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from toxiscope.llm import (
    kdtree, langid, lattice_lm, licenses, linededup, mixing, nndescent, packing, passages, periodic, repair, simhash,
    toolcalls,
)
from toxiscope.llm.common import count_words, id_remainder, read_table, spread_rows, stored


def op1_nndescent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every query vector."""
    return nndescent.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their source's target and the words the mix takes of each."""
    docs = read_table(spark, sf_dir, "documents")
    slim = stored(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "mix-sizes")
    joined, info = mixing.with_rates(slim, mixing.source_targets(slim))
    taken = mixing.copies(F.col(f"{info}.rate"), F.col("doc_id")) * F.col("size")
    return joined.select(
        "doc_id", "source", "size", F.col(f"{info}.source_size").alias("source_size"),
        F.col(f"{info}.target").alias("target"), taken.alias("taken"),
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from the documents not held out."""
    docs = spread_rows(
        read_table(spark, sf_dir, "documents")
        .withColumn("held_out", id_remainder(F.col("doc_id"), 3) == 1)
        .select("doc_id", "text", "lang", "held_out")
    )
    net = langid.train(docs.where(~F.col("held_out")))
    found = langid.predict(docs.select("doc_id", "held_out", "text"), net)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines before and after deduplication, and the text that is left."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("long")
    found = linededup.dedup_lines(docs.withColumn("n_lines", lines), removed="removed")
    return found.select(
        "doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed"), F.md5("text").alias("text_md5"),
    )


def op6_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice and base log probability of every document."""
    held_out = id_remainder(F.col("doc_id"), 5) == 1
    keep = {"doc_id": F.col("doc_id"), "held_out": held_out}
    return lattice_lm.score_documents(read_table(spark, sf_dir, "documents"), ~held_out, keep, group="lang")


def op7_toolcalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of the conversations, read as tool use, linked, checked and in order."""
    calls = toolcalls.as_tool_messages(read_table(spark, sf_dir, "conversations"))
    found = toolcalls.link_tool_calls(calls, toolcalls.TOOLS)
    return found.withColumn("json_md5", F.md5("json")).drop("json")


def op8_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that repeats across or within the documents, and whether it is removed."""
    found = passages.repeated_passages(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", "words", "n_units", "cluster_id", "removed")


def op9_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest integer inner products of every query vector."""
    return kdtree.integer_topk(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact license phrases and license notices of every document."""
    found = licenses.scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    exact = F.filter("spans", lambda s: s["base"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    starts = F.transform(exact, lambda s: s["start"])
    return found.select(
        "doc_id", "n_words", F.size(exact).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(exact).alias("base_labels"), labels(F.col("spans")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("spans", lambda s: s["similarity"])), F.lit(0.0)), 6).alias("score"),
    )


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the texts (by crc32 of the id) end in a loop; a null id changes nothing."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a : a + p]
    return words[:a] + (loop * ((n - a) // len(loop) + 1))[: n - a]


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs: their number, the strongest, and digests of all runs
    and of the text that is left."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.periodic_runs(docs, change=looped)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    top = periodic.strongest("runs")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), top["start"].alias("start"),
        top["length"].alias("length"), top["period"].alias("period"),
        F.call_function("div", top["length"] * 1000, top["period"]).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a fifth of their turns spoiled, by crc32 of ``conv_id:turn``. A null
    is one blank, in the key too; conv_id and turn stay null."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(plain("text"), ".!?", "")).otherwise(plain("text"))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(plain("role")).alias("role"), text.alias("text"),
        F.explode(F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def conversation_digests(turns: DataFrame) -> DataFrame:
    """``conv_id, digest``: sha256 of the lines ``role:text`` in order. A digest is one
    sequential computation, so a conversation's lines pass one task, in a stream; nothing of
    them is held but the digest's state."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, begun = None, None, False
        for b in batches:
            done = []
            for conv, line in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not begun or conv != now:
                    if begun:
                        done.append((now, state.hexdigest()))
                    now, state, begun = conv, hashlib.sha256(line.encode()), True
                else:
                    state.update(b"\n" + line.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], b.schema.field(0).type), pa.array([d[1] for d in done])], ["conv_id", "digest"])
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([now], b.schema.field(0).type), pa.array([state.hexdigest()])], ["conv_id", "digest"])

    lines = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part")
    kind = turns.schema["conv_id"].dataType.simpleString()
    return lines.select("conv_id", F.concat("role", F.lit(":"), "text")).mapInArrow(digest, f"conv_id {kind}, digest string")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after the damage: its faults, cheapest edits and repaired text."""
    rows = read_table(spark, sf_dir, "conversations")
    found = repair.repair_conversations(damaged(rows))
    out = rows.select("conv_id").distinct().alias("o")
    same = lambda t: F.col("o.conv_id").eqNullSafe(F.col(f"{t}.conv_id"))
    joined = out.join(found.conversations.alias("f"), same("f"), "left").join(
        conversation_digests(found.turns).alias("d"), same("d"), "left"
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "o.conv_id", *[F.coalesce(f"f.{c}", F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("f.audit", F.lit("")).alias("audit"),
        F.coalesce("d.digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_nndescent": op1_nndescent,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_langid": op4_langid,
    "op5_linededup": op5_linededup,
    "op6_lattice": op6_lattice,
    "op7_toolcalls": op7_toolcalls,
    "op8_passages": op8_passages,
    "op9_kdtree": op9_kdtree,
    "op10_packing": op10_packing,
    "op11_licenses": op11_licenses,
    "op12_periodic": op12_periodic,
    "op13_repair": op13_repair,
}

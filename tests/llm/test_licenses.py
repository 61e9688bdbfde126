import re

import duckdb
import pytest
from pyspark.sql import functions as F

from toxiscope.llm import licenses, queries
from toxiscope.llm.oracle import ORACLES

MIT = next(t.text for t in licenses.NOTICES if t.label == "mit")


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_base(doc_id, text):
    words, places = words_of(text), []
    for t in licenses.PHRASES:
        p = words_of(t.text)
        places += [(i, t.label) for i in range(len(words)) if words[i : i + len(p)] == p]
    starts = [i for i, _ in places]
    return (doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


TEXTS = [
    "Released under the MIT License.", "under THE mit-license, under the MIT license", "cc by nc cc-by-nc 4.0 CC BY SA",
    "Apache License, Version 2.0", "apache license version 20", "", None, "under the mit", "é under the mit licenseé",
    "Åunder the mit license", "x\x00under\x01the\x7fmit`license", "under the mit license " * 400, "Kunder the mit license",
]


def test_base_places_equal_brute_force(spark, tmp_path, documents):
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0]), (None, TEXTS[1])]
    rows += [(r.doc_id + 100, r.text) for r in documents.select("doc_id", "text").collect()]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_licenses(spark, str(tmp_path))
    key = lambda r: tuple((x is not None, x) for x in r)
    found = [tuple(r)[:6] for r in out.collect()]
    assert sorted(found, key=key) == sorted((brute_base(*r) for r in rows), key=key)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in out.collect())


def test_sql_equals_query_on_edited_notices(spark, tmp_path):
    w = MIT.split()
    rows = [(0, MIT), (1, " ".join(w[:20] + ["oddly", "enough"] + w[20:])), (2, " ".join(w[:30] + w[33:])),
            (3, " ".join(w[:15])), (4, " ".join(w[::-1])), (5, f"{MIT} and {MIT}\n{MIT.upper()}")]
    rows += [(10 + i, f"start {t.text} end") for i, t in enumerate(licenses.TEMPLATES)]
    rows += [(100 + i, t) for i, t in enumerate(TEXTS) if t is None or "\x00" not in t]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    spark_rows = sorted(tuple(r) for r in queries.op11_licenses(spark, str(tmp_path)).select(columns).collect())
    assert spark_rows == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES['op11_licenses']})").fetchall())
    labels = {r[0]: r[6] for r in spark_rows}
    assert labels[0] == labels[1] == labels[2] == labels[5] == "mit" and labels[3] == labels[4] == ""
    assert all(t.label in labels[10 + i].split(",") for i, t in enumerate(licenses.TEMPLATES))


def test_spans_of_several_copies(spark):
    df = spark.createDataFrame([(1, f"a b {MIT} c {MIT}")], "doc_id long, text string")
    spans = licenses.scan_licenses(df).first().spans
    n = len(words_of(MIT))
    assert [(s.start, s.length, s.similarity) for s in spans] == [(2, n, 1.0), (n + 3, n, 1.0)]


def test_messy_and_empty_tables(messy, no_docs):
    clash = messy.withColumn("spans", F.lit(1)).withColumn("N_words", F.lit(2)).withColumn("template", F.lit(3))
    out = licenses.scan_licenses(clash)
    assert out.columns[-2:] == ["n_words_", "spans_"] and out.count() == messy.count()
    assert out.where("doc_id = 5").first().n_words_ == 60_000
    assert licenses.scan_licenses(no_docs).count() == 0
    with pytest.raises(ValueError):
        licenses.scan_licenses(messy, templates=(licenses.Template("x", "two words"),))

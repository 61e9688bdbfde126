
from pyspark.sql import functions as F

from toxiscope.sources.readers import read_comments, read_messages
from toxiscope.sources.sinks import render_metrics


def test_csv_multiline_quoted(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text('id,clean_comment,toxic\na,"hello, ""x""\nnext",1\n')
    schema = "id string, clean_comment string, toxic int"
    from pyspark.sql.types import _parse_datatype_string

    rows = read_comments(spark, str(p), "csv", _parse_datatype_string(schema)).collect()
    assert len(rows) == 1
    assert rows[0].clean_comment == 'hello, "x"\nnext' and rows[0].toxic == 1


def test_read_comments_parquet_projects_schema(spark, tmp_path, six_labels):
    out = str(tmp_path / "p")
    six_labels.withColumn("extra", F.lit(1)).write.parquet(out)
    df = read_comments(spark, out, "parquet")
    assert df.columns == six_labels.columns and df.count() == 4


def test_read_messages_one_row_per_file(spark, tmp_path):
    d = tmp_path / "msgs"
    d.mkdir()
    (d / "m1.txt").write_text("first line\nsecond line\n")
    (d / "m2.txt").write_text("another")
    rows = read_messages(spark, str(d)).collect()
    assert sorted(r.clean_comment for r in rows) == ["another", "first line\nsecond line\n"]
    assert len({r.message_id for r in rows}) == 2


def test_render_metrics(spark):
    m = spark.createDataFrame(
        [("toxic", None, "acc", 0.6), ("toxic", 0, "f1", 2 / 3), ("toxic", 1, "f1", 0.5), ("toxic", 1, "FPR", None),
         ("toxic", 0, "FPR", 0.5)],
        "label string, class int, metric string, value double")
    rows = {r.metric: r.text for r in render_metrics(m).collect()}
    assert rows["acc"] == "0.6"
    assert rows["f1"] == "0.6666666666666666 | 0.5"
    assert rows["FPR"] == "0.5 | NaN"


def test_empty_message_files_are_empty_messages(spark, tmp_path):
    texts = {"a b%1.txt": "x", "é#.txt": "y\nz", "2.txt": "", "c d.txt": "", "_skip.txt": "no", "sp ace.txt": " "}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    rows = read_messages(spark, str(tmp_path)).collect()
    assert sorted(r.clean_comment for r in rows) == ["", "", " ", "x", "y\nz"]
    assert len({r.message_id for r in rows}) == 5

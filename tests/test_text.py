import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer

from toxiscope.functions.stopwords import english_stop_words
from toxiscope.functions.text import clean_text, remove_stop_words, tokenize

TOKEN_CASES = [
    ("The  Cat sat ", ["the", "", "cat", "sat"]),
    ("", [""]),
    (" lead", ["", "lead"]),
    ("   ", []),
    ("I'll GO\tnow\n", ["i'll", "go", "now"]),
    ("a\x0bb\x0cc\r\nd", ["a", "b", "c", "", "d"]),
]


def test_stop_list_equals_spark_default(spark):
    assert list(english_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(english_stop_words()) == 181


@pytest.mark.parametrize("text,expected", TOKEN_CASES)
def test_tokenize_matches_ml_tokenizer(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    row = Tokenizer(inputCol="t", outputCol="w").transform(df).select("w", tokenize("t").alias("mine")).first()
    assert row.w == expected
    assert row.mine == expected


def test_stop_words_fixtures(spark):
    df = spark.createDataFrame([(["i'll", "go", "now"],), (["the", "", "cat", "sat"],), (["The", "CAT"],)], "w array<string>")
    ml = StopWordsRemover(inputCol="w", outputCol="k").transform(df).select("k", remove_stop_words("w").alias("mine"))
    rows = ml.collect()
    assert [r.k for r in rows] == [["go"], ["", "cat", "sat"], ["CAT"]]
    assert [r.mine for r in rows] == [r.k for r in rows]


def test_null_text_is_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(tokenize("t")).first()[0] == [""]


def test_clean_text_rule(spark):
    raw = "RT @iexistyaknow: Dan: drops http://x.co/ab his, rt rt WrappedArray(RT, 3 stores) l'été"
    df = spark.createDataFrame([(raw,), (None,), ("",)], "t string")
    out = [r[0] for r in df.select(clean_text("t")).collect()]
    assert out == ["dan drops his wrappedarray stores l'été", None, ""]


def test_clean_text_equals_its_rule_step_by_step(spark):
    import re

    texts = ["see HTTPS://a.b/c d", "www.x y", "Www. www", "a @Me_1 b@c @ d", "http:/x httpx", "RT rt x", "don't ÀB́c 漢字 ١٢ x2y", "ftp://q", " a\nb"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def rule(t):
        import unicodedata

        t = re.sub(r"(https?://|www\.)[^ \t\n\x0B\f\r]*", " ", t.lower())
        t = re.sub(r"@[a-z0-9_]+", " ", t)
        t = "".join(c if c == "'" or unicodedata.category(c)[0] in "LM" else " " for c in t)
        return re.sub(r" (rt )+", " ", " " + re.sub(" +", " ", t) + " ").strip(" ") if t.strip(" ") else ""

    def spaced(t):
        return re.sub(" +", " ", t)

    assert [r[0] for r in df.select(clean_text("t")).collect()] == [spaced(rule(t)) for t in texts]

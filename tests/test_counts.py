from pyspark.sql import functions as F

from toxiscope.functions.counts import keys_repeat, row_term_counts
from toxiscope.functions.stopwords import english_stop_words
from toxiscope.operators.features import explode_terms, term_counts, tfidf
from toxiscope.operators.term_join import join_terms

TEXTS = [
    "The bad  bad\trude\nWords ", "", "   ", None, " lead and trail \t", "a\x0bb\x0cc\rd a", "Éa éA ÀΣ çα 漢字 漢字", "it it is",
    "don't DON'T x", "\t\n", "the of and",
]


def plain(df):
    return sorted(map(str, map(tuple, df.collect())))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exploded_counts(df, key):
    return explode_terms(df, [key], text_col="t").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def test_row_counts_equal_the_exploded_tokens(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 200)], "id long, t string").repartition(3)
    got = row_term_counts(df, ["id"], text_col="t", stop_words=english_stop_words())
    assert plain(got) == plain(exploded_counts(df, "id"))
    arrays = spark.createDataFrame([(1, ["a", None, "a", None]), (2, []), (3, None), (4, ["the"])], "id long, tokens array<string>")
    assert plain(row_term_counts(arrays, ["id"], tokens_col="tokens")) == plain(
        explode_terms(arrays, ["id"], tokens_col="tokens").groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))
    )
    assert row_term_counts(df.limit(0), ["id"], text_col="t").count() == 0


def test_repeated_and_null_keys_are_added_up(spark):
    rows = [(1, "x y x"), (1, "x z"), (None, "x"), (None, "x y"), (2, "")]
    df = spark.createDataFrame(rows, "id long, t string").repartition(4)
    assert keys_repeat(df, "id") and keys_repeat(df.where("id is null"), "id") and not keys_repeat(df.where("id = 2"), "id")
    assert plain(term_counts(df, "id", text_col="t")) == plain(exploded_counts(df, "id"))


def test_counts_of_single_rows_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, f"w{i % 5} bad rude") for i in range(40)], "id long, t string")
    counts = term_counts(df, "id", text_col="t")
    assert "Exchange" not in plan(counts)
    out = tfidf(counts, 40, "id")
    assert out.count() == 120 and {r.term: round(r.idf, 6) for r in out.collect()}["bad"] == 0.0


def test_terms_beyond_the_broadcast_are_not_sorted(spark):
    rows = spark.createDataFrame([(i, f"w{j}") for i in range(30) for j in range(i + 1)], "id long, term string")
    terms = rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    found = join_terms(rows, terms, 1, "n", rows.count(), max_bytes=0, hot_share=20)
    assert "SortMergeJoin" not in plan(found) and "ShuffledHashJoin" in plan(found)
    assert plain(found.select("id", "term", "n")) == plain(rows.join(terms, "term").select("id", "term", "n"))

"""Text features (F1–F8): the Spark ML stages, plus relational forms of the counts.

* ``text_stages`` builds the reference's stage chain (Tokenizer → StopWordsRemover →
  HashingTF | CountVectorizer | HashingTF+IDF | Word2Vec); fitted once on the
  training part and applied to everything else.
* ``term_counts`` / ``vocabulary`` / ``tfidf`` give the same numbers as exact
  DataFrame aggregates (readable, checkable, and per-term rather than per-bucket).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    HashingTF,
    StopWordsRemover,
    Tokenizer,
    Word2Vec,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toxiscope.functions.counts import keys_repeat, row_term_counts
from toxiscope.functions.stopwords import english_stop_words
from toxiscope.functions.text import remove_stop_words, tokenize
from toxiscope.operators.ranking import global_index
from toxiscope.operators.term_join import join_terms, table_bytes
from toxiscope.operators.word_vectors import TableWord2Vec
from toxiscope.schema import TEXT_COL
from toxiscope.session import cut_lineage, store_table

DEFAULT_NUM_FEATURES = 1 << 18  # HashingTF default (262,144 buckets)

# Parameters of the saved Word2Vec stage.
W2V_VECTOR_SIZE = 100
W2V_WINDOW_SIZE = 5
W2V_MIN_COUNT = 5
W2V_MAX_ITER = 1
W2V_STEP_SIZE = 0.025
W2V_MAX_SENTENCE_LENGTH = 1000
W2V_SEED = -1961189076

# Training partitions of Word2Vec. The vectors depend on it (each partition trains its own
# copy, and the copies are averaged), so it is a fixed parameter and follows neither the
# cores nor the rows up to 4 million tokens a partition. The saved stage used 1, which puts all
# training in one task.
W2V_PARTITIONS = 8

# Beyond ``W2V_PARTITIONS`` times the first number, the training partitions grow with the tokens:
# multiples of ``W2V_STEP`` (even waves on most core counts) of at most the second number each.
W2V_SMALL_TOKENS = 4_000_000
W2V_FULL_TOKENS = 16_000_000
W2V_STEP = 24

# Spark's estimator holds some 4.5 KB a word on the driver. Beyond so many words the same training
# runs with its vectors in a table (``operators.word_vectors``). That many take at least
# ``W2V_MIN_COUNT`` times as many tokens; smaller tables are not asked.
W2V_DRIVER_WORDS = 300_000

# Exact vocabularies hold every term unless a caller asks for the top N.
UNCAPPED = (1 << 31) - 1


def text_stages(
    kind: str = "hashing",
    input_col: str = TEXT_COL,
    features_col: str = "features",
    num_features: int = DEFAULT_NUM_FEATURES,
    vocab_size: int = UNCAPPED,
    min_df: float = 1.0,
    w2v_partitions: int = W2V_PARTITIONS,
    w2v_vector_size: int = W2V_VECTOR_SIZE,
    w2v_min_count: int = W2V_MIN_COUNT,
    seed: int = W2V_SEED,
) -> Pipeline:
    """F8: Tokenizer → StopWordsRemover → featurizer, as one (unfitted) ``Pipeline``.

    ``kind``: ``hashing`` (raw hashed term counts, the reference's default),
    ``terms`` (exact vocabulary, held as a table), ``counts`` (the same by Spark's count
    vectorizer, vocabulary on the driver; for streams), ``tfidf`` (hashed counts × IDF), ``word2vec``
    (document = mean of word vectors, trained on ``w2v_partitions`` partitions, more of them
    beyond 4 million tokens each, see :func:`w2v_partitions_for`).
    """
    tok = Tokenizer(inputCol=input_col, outputCol="words")
    stop = StopWordsRemover(
        inputCol="words", outputCol="stopWordFilter", stopWords=list(english_stop_words()), caseSensitive=False
    )
    if kind == "hashing":
        last = [HashingTF(inputCol="stopWordFilter", outputCol=features_col, numFeatures=num_features)]
    elif kind == "terms":
        from toxiscope.operators.term_vectors import TermVectors

        kept = 0 if vocab_size >= UNCAPPED else vocab_size
        last = [TermVectors(inputCol="stopWordFilter", outputCol=features_col, vocabSize=kept, minDF=min_df)]
    elif kind == "counts":
        last = [
            CountVectorizer(inputCol="stopWordFilter", outputCol=features_col, vocabSize=vocab_size, minDF=min_df)
        ]
    elif kind == "tfidf":
        last = [
            Pipeline(stages=[
                HashingTF(inputCol="stopWordFilter", outputCol="tf", numFeatures=num_features),
                IDF(inputCol="tf", outputCol=features_col),
            ])
        ]
    elif kind == "word2vec":
        w2v = Word2Vec(
            inputCol="stopWordFilter",
            outputCol=features_col,
            vectorSize=w2v_vector_size,
            windowSize=W2V_WINDOW_SIZE,
            minCount=w2v_min_count,
            maxIter=W2V_MAX_ITER,
            stepSize=W2V_STEP_SIZE,
            maxSentenceLength=W2V_MAX_SENTENCE_LENGTH,
            seed=seed,
        )
        w2v.setNumPartitions(int(w2v_partitions))
        last = [w2v]
    else:
        raise ValueError(f"unknown feature kind {kind!r}")
    return Pipeline(stages=[tok, stop, *last])


def w2v_partitions_for(n_tokens: int, least: int = W2V_PARTITIONS) -> int:
    """Training partitions of Word2Vec for so many tokens: from the input alone, so that the
    vectors do not depend on the cores."""
    if n_tokens <= least * W2V_SMALL_TOKENS:
        return least
    return max(least, W2V_STEP * -(-n_tokens // (W2V_STEP * W2V_FULL_TOKENS)))


def fit_stages(
    pipeline: Pipeline, df: DataFrame, keep: list[str], with_tokens: bool = False
) -> tuple[PipelineModel, DataFrame]:
    """Fit the chain and return it with the transformed ``keep`` columns (and tokens) and
    features.

    The token columns are written once; a featurizer that passes over its input several
    times (vocabulary, IDF, Word2Vec) reads them instead of the text. Null text is empty.
    """
    *prepare, featurizer = pipeline.getStages()
    text = prepare[0].getInputCol()
    now = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias(text))
    for stage in prepare:
        now = stage.transform(now)
    tokens = now.select(*keep, prepare[-1].getOutputCol())
    extra = [prepare[-1].getOutputCol()] if with_tokens else []
    if getattr(featurizer, "vocabulary_is_table", False):
        model, out = featurizer.fit_transform(tokens)
        return PipelineModel([*prepare, model]), out.select(*keep, *extra, model.getOutputCol())
    tokens = cut_lineage(tokens)
    if isinstance(featurizer, Word2Vec):
        held = tokens.agg(F.coalesce(F.sum(F.size(featurizer.getInputCol())), F.lit(0))).first()[0]
        featurizer = featurizer.copy({featurizer.numPartitions: w2v_partitions_for(int(held), featurizer.getNumPartitions())})
        featurizer = _bounded_word2vec(featurizer, tokens, int(held))
    fitted = featurizer.fit(tokens) if hasattr(featurizer, "fit") else featurizer
    if isinstance(featurizer, Pipeline):  # a featurizer of two steps
        fitted = fitted.stages
    else:
        fitted = [fitted]
    out = tokens
    for stage in fitted:
        out = stage.transform(out)
    return PipelineModel([*prepare, *fitted]), out.select(*keep, *extra, fitted[-1].getOutputCol())


def _bounded_word2vec(w2v: Word2Vec, tokens: DataFrame, held: int) -> Word2Vec | TableWord2Vec:
    """The estimator itself, or the one whose vectors are a table where the words are many."""
    if held <= max(W2V_PARTITIONS * W2V_SMALL_TOKENS, W2V_DRIVER_WORDS * w2v.getMinCount()):
        return w2v
    column = w2v.getInputCol()
    counts = row_term_counts(tokens.select(column), [], tokens_col=column).groupBy("term").agg(F.sum("tf").alias("n"))
    if counts.where(F.col("n") >= w2v.getMinCount()).count() <= W2V_DRIVER_WORDS:
        return w2v
    same = ("inputCol", "outputCol", "vectorSize", "windowSize", "minCount", "maxIter", "stepSize", "maxSentenceLength", "seed", "numPartitions")
    return TableWord2Vec(**{name: w2v.getOrDefault(name) for name in same})


def with_tokens(df: DataFrame, text_col: str = TEXT_COL, out_col: str = "tokens") -> DataFrame:
    """F1 + F2 as column expressions: ``out_col`` = stop-word-filtered tokens."""
    return df.withColumn(out_col, remove_stop_words(tokenize(text_col)))


def explode_terms(
    df: DataFrame,
    keep_cols: list[str],
    text_col: str | None = None,
    tokens_col: str | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """One row per kept token occurrence: ``keep_cols…, term``.

    From text: tokenize, explode, then drop stop words with ``isin`` (a hash-set
    lookup inside whole-stage codegen). Exploding an array built by a lambda
    ``filter`` in the same stage runs an order of magnitude slower, so the
    relational paths filter after the explode. From a ready token array: explode it.
    """
    if text_col is not None:
        words = english_stop_words() if stop_words is None else stop_words
        exploded = df.select(*keep_cols, F.explode(tokenize(text_col)).alias("term"))
        return exploded.where(~F.lower(F.col("term")).isin([w.lower() for w in words]))
    if tokens_col is None:
        raise ValueError("give text_col or tokens_col")
    return df.select(*keep_cols, F.explode(tokens_col).alias("term"))


def term_counts(
    df: DataFrame, key: str, tokens_col: str = "tokens", text_col: str | None = None
) -> DataFrame:
    """F4 (exact counts): ``key, term, tf``, counted within each row; the rows of a key that
    repeats are then added up by a shuffle on (key, term) (none when ``df`` is already
    hash-partitioned by ``key``)."""
    if text_col is not None:
        counts = row_term_counts(df, [key], text_col=text_col, stop_words=english_stop_words())
    else:
        counts = row_term_counts(df, [key], tokens_col=tokens_col)
    if not keys_repeat(df, key):
        return counts
    return counts.groupBy(key, "term").agg(F.sum("tf").alias("tf"))


def vocabulary(
    counts: DataFrame, vocab_size: int | None = None, min_df: int = 1
) -> DataFrame:
    """F4 vocabulary: ``term, doc_freq, term_count, term_index``.

    Ordered by total count desc, then term asc (the index is the feature position of
    CountVectorizer; its own tie order is unspecified). ``vocab_size`` keeps the top
    entries — that cut is the feature, not a shortcut.
    """
    per_term = counts.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.sum("tf").alias("term_count")
    ).where(F.col("doc_freq") >= min_df)
    indexed = global_index(per_term, [F.col("term_count").desc(), F.col("term").asc()], "term_index")
    if vocab_size is not None:
        indexed = indexed.where(F.col("term_index") < vocab_size)
    return indexed


def tfidf(counts: DataFrame, n_docs: int, key: str) -> DataFrame:
    """``key, term, tf, idf, tfidf`` with idf = ln((N + 1) / (df + 1)) (Spark's IDF).

    The counts are written once (compressed), so the text is read and tokenized once for both
    uses; the document frequencies meet them as in :func:`join_terms`.
    """
    counts = store_table(counts, "term-counts")
    df_t = store_table(counts.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq")), "doc-freq")
    total = df_t.agg(F.coalesce(F.sum("doc_freq"), F.lit(0))).first()[0]
    idf = F.log(F.lit(float(n_docs + 1)) / (F.col("doc_freq") + F.lit(1.0)))
    return join_terms(counts, df_t, table_bytes(df_t, 1), "doc_freq", total).select(
        key, "term", "tf", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf")
    )

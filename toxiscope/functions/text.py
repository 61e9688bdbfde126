"""Built-in (JVM-side, codegen-friendly) column expressions for comment text.

All patterns avoid classes whose meaning differs between Java regex and RE2
(``\\s``, ``\\w``, ``\\b``) so the same text gives the same result in Spark and
in a SQL engine using RE2; whitespace is spelled out as the six characters Java's
``\\s`` matches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from toxiscope.functions.stopwords import english_stop_words

# The whitespace set of the tokenizer (Java's \s): space, tab,
# newline, vertical tab, form feed, carriage return.
WS = r"[ \t\n\x0B\f\r]"
NOT_WS = r"[^ \t\n\x0B\f\r]"

# Fixed values for our cleaning rule (see clean_text).
URL_PATTERN = r"(https?://|www\.)" + NOT_WS + "*"
MENTION_PATTERN = r"@[a-z0-9_]+"
NON_LETTER_PATTERN = r"[^a-z\p{L}\p{M}']+"  # a-z are letters; named, they need no lookup
RETWEET_PATTERN = r" (rt )+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: str | Column) -> Column:
    """Our definition of ``clean_comment`` (the reference names it but never ships it).

    lower-case → drop URLs → drop @mentions → every run of other than letters, their
    combining marks and apostrophes becomes one space → drop retweet markers ``rt`` → trim. Null stays null.
    """
    low = F.lower(_col(text))
    # a byte search finds the texts that can hold a URL or a mention; only these are matched
    marked = F.contains(low, F.lit("http")) | F.contains(low, F.lit("www.")) | F.contains(low, F.lit("@"))
    x = F.regexp_replace(F.regexp_replace(low, URL_PATTERN, " "), MENTION_PATTERN, " ")
    x = F.when(marked, x).otherwise(low)
    x = F.regexp_replace(x, NON_LETTER_PATTERN, " ")
    x = F.regexp_replace(F.concat(F.lit(" "), x, F.lit(" ")), RETWEET_PATTERN, " ")
    return F.trim(x)


def tokenize(text: str | Column) -> Column:
    """Column form of Spark ML's ``Tokenizer``.

    Lower-case, split on every single whitespace character; empty tokens inside
    and at the start are kept, trailing empty tokens are dropped (``''`` → ``['']``,
    all-blank → ``[]``). Null text is treated as ``''``.
    """
    low = F.lower(F.coalesce(_col(text), F.lit("")))
    stripped = F.regexp_replace(low, WS + "+$", "")
    return (
        F.when(low == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, WS))
    )


def remove_stop_words(tokens: str | Column, stop_words: list[str] | None = None) -> Column:
    """Column form of ``StopWordsRemover`` (case-insensitive): keeps order and duplicates."""
    words = english_stop_words() if stop_words is None else stop_words
    stop = F.array(*[F.lit(w.lower()) for w in words])
    return F.filter(_col(tokens), lambda t: ~F.array_contains(stop, F.lower(t)))


def tokens_digest(tokens: str | Column) -> Column:
    """md5 of the space-joined token list: a compact, comparable fingerprint."""
    return F.md5(F.array_join(_col(tokens), " "))

"""The English stop-word list used by the word filter: the default that Spark ML ships.

It equals the 181-word list of the saved stop-word stage, in order. (The SQL oracles keep a
list of their own.)
"""

from __future__ import annotations

import functools


@functools.cache
def english_stop_words() -> tuple[str, ...]:
    """The list; needs a running session, as every plan that uses it does."""
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords("english"))

"""Arrow-batched term counts of single rows: tokenized and counted where the row lies.

A row's tokens never leave its task as single rows: each slice of a batch is split into flat
token buffers, coded by a dictionary, and counted with one sort of (row, code) numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a batch that are counted at a time.
SLICE = 1024
_TO_SPACE = np.arange(256, dtype=np.uint8)
_TO_SPACE[[9, 10, 11, 12, 13]] = 32  # the tokenizer's white space; no other character's bytes


def _spaced(texts: pa.Array) -> pa.Array:
    """Texts (no nulls) with every white space character as a space."""
    valid, offsets, data = texts.buffers()
    if data is None:
        return texts
    data = pa.py_buffer(_TO_SPACE[np.frombuffer(data, np.uint8)])
    return pa.Array.from_buffers(texts.type, len(texts), [valid, offsets, data], offset=texts.offset)


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Tokens, flat, and their row: as :func:`toxiscope.functions.text.tokenize`."""
    texts = _spaced(texts)
    kept = pc.ascii_rtrim(texts, characters=" ")
    some = pc.or_(pc.not_equal(kept, ""), pc.equal(texts, ""))  # an all-blank text has no token
    at = np.flatnonzero(some.to_numpy(zero_copy_only=False))
    lists = pc.split_pattern(kept.take(pa.array(at)), " ")
    return lists.flatten(), np.repeat(at, pc.list_value_length(lists).to_numpy(zero_copy_only=False))


def row_term_counts(
    df: DataFrame, keep: list[str], text_col: str | None = None, tokens_col: str | None = None, stop_words: list[str] = ()
) -> DataFrame:
    """``keep…, term, tf`` for every row of ``df`` and each of its distinct terms: from a text
    (null: empty) as ``tokenize`` splits it, without ``stop_words``, or from a token array."""
    of_text = text_col is not None
    source = F.lower(F.coalesce(F.col(text_col), F.lit(""))) if of_text else F.col(tokens_col)
    stop = sorted({w.lower() for w in stop_words})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stopped = pa.array(stop, pa.string())
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                b = whole.slice(start, SLICE)
                column = b.column("_source")
                if of_text:
                    flat, row = _split(column)
                else:
                    flat = column.flatten()
                    row = np.repeat(np.arange(b.num_rows), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))
                coded = flat.dictionary_encode(null_encoding="encode")
                names, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
                if stop:
                    used = ~pc.is_in(names, value_set=stopped).to_numpy(zero_copy_only=False)[code]
                    row, code = row[used], code[used]
                cells, tf = np.unique(row * len(names) + code, return_counts=True)
                row, code = (pa.array(x) for x in np.divmod(cells, max(1, len(names))))
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c).take(row) for c in keep], names.take(code), pa.array(tf.astype(np.int64))], [*keep, "term", "tf"]
                )

    schema = T.StructType([*[df.schema[c] for c in keep], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    return df.select(*keep, source.alias("_source")).mapInArrow(count, schema)


def keys_repeat(df: DataFrame, key: str) -> bool:
    """Does a key (null counts as one) come in more than one row? Reads the key only."""
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()

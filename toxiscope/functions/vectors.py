"""Arrow-batched summaries of ML vector columns (no per-row Python, no densifying).

Spark ML vectors travel through Arrow as ``struct<type, size, indices, values>``;
per-row sums and non-zero counts come from one numpy pass over each batch's flat
``values`` buffer and its list offsets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def _row_sums(values: pa.ListArray, flat: np.ndarray) -> np.ndarray:
    offsets = values.offsets.to_numpy(zero_copy_only=False)
    cs = np.concatenate([[0.0], np.cumsum(flat, dtype=np.float64)])
    return cs[offsets[1:]] - cs[offsets[:-1]]


def vector_stats(df: DataFrame, vec_col: str, keep_cols: list[str]) -> DataFrame:
    """``keep_cols…, vec_size, nnz, total`` for every row of ``df`` (null vector → 0s)."""
    schema_keep = [f for f in df.schema.fields if f.name in keep_cols]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema_keep)
    ddl = (ddl + ", " if ddl else "") + "vec_size int, nnz long, total double"

    def summarize(batches):
        for b in batches:
            vec = b.column(vec_col)
            if isinstance(vec, pa.ChunkedArray):
                vec = vec.combine_chunks()
            values = vec.field("values")
            values = values.fill_null([]) if values.null_count else values
            flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            total = _row_sums(values, flat)
            nnz = _row_sums(values, (flat != 0).astype(np.float64)).astype(np.int64)
            is_dense = pc.equal(vec.field("type"), 1)
            size = pc.if_else(is_dense, pc.list_value_length(values), vec.field("size")).fill_null(0)
            cols = {c: b.column(c) for c in keep_cols}
            cols.update(
                {
                    "vec_size": size.cast(pa.int32()),
                    "nnz": pa.array(nnz, pa.int64()),
                    "total": pa.array(total, pa.float64()),
                }
            )
            yield pa.RecordBatch.from_pydict(cols)

    return df.select(*keep_cols, vec_col).mapInArrow(summarize, ddl)


def vector_entries(df: DataFrame, vec_col: str, key: str) -> DataFrame:
    """``key, index int, value double`` of every non-zero entry (a null vector has none)."""

    def entries(batches):
        for b in batches:
            vec = b.column(vec_col)
            values, indices = vec.field("values"), vec.field("indices")
            dense = pc.equal(vec.field("type"), 1).fill_null(False).to_numpy(zero_copy_only=False)
            n = pc.list_value_length(values).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            n[~vec.is_valid().to_numpy(zero_copy_only=False)] = 0
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)  # place within the row
            own = ~dense[row]
            sparse = np.flatnonzero(~dense & (n > 0))
            at[own] = indices.take(pa.array(sparse)).flatten().to_numpy(zero_copy_only=False)
            flat = values.take(pa.array(np.flatnonzero(n > 0))).flatten().to_numpy(zero_copy_only=False)
            kept = flat != 0
            yield pa.RecordBatch.from_arrays(
                [b.column(key).take(pa.array(row[kept])), pa.array(at[kept].astype(np.int32)), pa.array(flat[kept])],
                [key, "index", "value"],
            )

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, vec_col).mapInArrow(entries, f"`{key}` {kind}, index int, value double")

"""Integer vectors for the embedding operators: validity, rounding and blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a task handles as one matrix.
BLOCK = 4096


def complete(vector: Column) -> Column:
    """True for vectors that are not null and hold finite numbers only."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def integers(vector: Column, scale: int, shift: int, limit: int) -> Column:
    """``floor(scale * c) + shift`` of each entry ``c``, read as a double.

    Sums of squares must stay exact in 64 bits: an entry whose product leaves
    ``[-limit, limit]`` raises an error that names it."""

    def one(c: Column) -> Column:
        y = F.floor(c * F.lit(float(scale)))
        wide = F.abs(c * F.lit(float(scale))) > F.lit(float(limit))
        message = F.concat(F.lit("vector entry out of range: "), c.cast("string"))
        return F.when(wide, F.raise_error(message).cast("long")).otherwise(y + F.lit(shift))

    return F.transform(vector.cast("array<double>"), one)


def matrix(column) -> np.ndarray:
    """Rows of one Arrow list column of equal lengths."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


def blocks(batches, rows: int = BLOCK):
    """Arrow batches put together to blocks of about ``rows`` rows."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def keyed_sums(rows: DataFrame, task, kind: str = "long") -> dict[int, float]:
    """Totals by key of the ``(key, value)`` rows that ``task`` makes of its
    partition; a task sends each key once, and the driver gets one row a key."""
    parts = rows.mapInArrow(task, f"key long, value {kind}")
    return {r[0]: r[1] for r in parts.groupBy("key").agg(F.sum("value")).collect()}


def key_batch(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(values)], ["key", "value"])

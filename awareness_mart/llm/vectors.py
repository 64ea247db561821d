"""Integer vectors for the operators on embeddings, and a lookup by a key that may be hot."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

LARGEST = 2**31 - 1
HOT_SHARE = 1000  # a key with a thousandth of all rows is hot; there are at most so many


def _integers(lists: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows are whole and finite, and their lengths and floor(scale * x), end to end."""
    sizes = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    sizes = sizes.astype(np.int64)
    values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    there = np.maximum(sizes, 0)
    odd = np.append(0, np.cumsum(~np.isfinite(values)))
    ends = np.cumsum(there)
    good = (sizes >= 0) & (odd[ends] == odd[ends - there])
    whole = np.floor(values[np.repeat(good, there)] * scale)
    if len(whole) and max(whole.max(), -whole.min()) > LARGEST:
        raise ValueError(f"a component times {scale} is beyond 32 bits")
    return good, there[good], whole.astype("<i4")


def scaled(rows: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, vector, peak) of the rows whose vector is whole.

    vector holds the components floor(scale * x) as little-endian 32-bit integers, peak the
    largest of their absolute values. A row whose vector is null or holds a null or
    non-finite component goes; one beyond 32 bits stops the job.
    """
    label = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, sizes, whole = _integers(batch["vector"], scale)
            ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
            binary = pa.Array.from_buffers(
                pa.binary(), len(sizes), [None, pa.py_buffer(ends * 4), pa.py_buffer(whole)]
            )
            owner = np.repeat(np.arange(len(sizes)), sizes)
            peak = np.zeros(len(sizes), np.int64)
            np.maximum.at(peak, owner, np.abs(whole.astype(np.int64)))
            kept = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].filter(kept), batch["label"].filter(kept), binary, pa.array(peak)],
                names=["vec_id", "label", "vector", "peak"],
            )

    chosen = rows.select(F.col("vec_id").cast("bigint"), "label", F.col(vector).alias("vector"))
    return chosen.mapInArrow(run, f"vec_id bigint, label {label}, vector binary, peak bigint")


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of integers of a binary column; shorter ones end in zeros."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1] // 4
    values = np.frombuffer(data, "<i4") if data is not None and data.size else np.zeros(0, "<i4")
    values, lengths = values[ends[0] : ends[-1]], np.diff(ends)
    if np.all(lengths == size):
        return values.reshape(len(column), size)
    rows = np.zeros((len(column), size), "<i4")
    rows[np.arange(size) < lengths[:, None]] = values
    return rows


def exact_type(largest: int) -> type:
    """A type whose sums of products are exact while their absolute values stay below largest."""
    if largest >= 2**63:
        raise ValueError("the components are too large for sums of 64 bits")
    return np.float64 if largest < 2**53 else np.int64


def looked_up(rows: DataFrame, table: DataFrame, key: str, count: str, value: str) -> DataFrame:
    """rows with the value of their key from table (key, count of rows, value); nulls are a key.

    Hot keys, which are few by definition, are broadcast and never shuffled; the rows of the
    others are joined by key. A key that the table lacks gets a null. rows is read twice.
    """
    total = table.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * HOT_SHARE >= F.lit(total)
    name = unused(rows, "__key")
    keyed = table.select(F.col(key).alias(name), value, is_hot.alias(unused(rows, "__hot")))
    is_hot = keyed[keyed.columns[-1]]
    hot, cold = (F.broadcast(keyed.where(is_hot)), keyed.where(~is_hot))

    def same(right: DataFrame) -> Column:
        return rows[key].eqNullSafe(right[name])

    near = rows.join(hot, same(hot))
    far = rows.join(hot, same(hot), "left_anti").join(cold, same(cold), "left")
    return near.unionByName(far).select(*rows.columns, value)

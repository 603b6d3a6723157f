"""Vectors as exact integers, and sums of them that tasks combine before the shuffle."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_LONG = 2**63 - 1


def sound(vector: str) -> Column:
    """Whether a vector is there and has neither null nor non-finite components."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(wrong, F.lit(True))


def floored(vector: str, scale: int) -> Column:
    """``floor(scale * x)`` of each component, with x as a double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column whose lists all have ``width`` numbers."""
    values = np.asarray(column.flatten(), np.int64).reshape(len(column), width)
    largest = int(np.abs(values).max(initial=0))
    # A difference is at most twice as large; its squares are summed over all components.
    if values.min(initial=0) == -(2**63) or width * (2 * largest) ** 2 > MOST_LONG:
        raise OverflowError(f"components up to {largest}: squared distances would not fit 64 bits")
    return values


def lists(values: np.ndarray) -> pa.ListArray:
    """The rows of a matrix as a list column."""
    offsets = np.arange(len(values) + 1) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.ravel(), pa.int64()))


def sums_by(codes: np.ndarray, values: np.ndarray, codes_most: int) -> np.ndarray:
    """For each code below ``codes_most``: the sums of its rows' components, then their number."""
    out = np.zeros((codes_most, values.shape[1] + 1), np.int64)
    if len(codes):
        order = np.argsort(codes, kind="stable")
        found, first = np.unique(codes[order], return_index=True)
        out[found, :-1] = np.add.reduceat(values[order], first, axis=0)
        out[found, -1] = np.diff(np.append(first, len(codes)))
    return out


def slots(amounts: np.ndarray) -> pa.RecordBatch:
    """Amounts that are not zero, with their places."""
    flat = amounts.ravel()
    at = np.flatnonzero(flat)
    return pa.record_batch([pa.array(at, pa.int64()), pa.array(flat[at], pa.int64())], names=["slot", "amount"])


def added_up(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """The sums of ``slots`` of all tasks; as many numbers come to the driver as ``shape`` holds."""
    out = np.zeros(int(np.prod(shape)), np.int64)
    for row in parts.groupBy("slot").agg(F.sum("amount").alias("amount")).collect():
        out[row.slot] = row.amount
    return out.reshape(shape)


def decimals(values: np.ndarray) -> str:
    return ",".join(map(str, values.ravel().tolist()))

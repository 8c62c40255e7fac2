"""Embedding rows as exact integer matrices, shared by the operators on vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """Rows whose vector is there and has finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~bad, F.lit(False))


def integers(vector: str, scale: int) -> Column:
    """Each component x as floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def within(column: Column, largest: int) -> Column:
    """Whether no integer component is larger than that."""
    return F.forall(column, lambda x: x.between(-largest, largest))


def matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as an int64 matrix; shorter lists are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    width = int(lengths.max(initial=0)) if width is None else width
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return values.astype(np.int64).reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = at < width
    out[row[inside], at[inside]] = values[inside]
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The int64 product a @ b, by floating point where every partial sum is provably below 2^53."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b

"""Vectors as whole numbers, for operators whose results must not depend on rounding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# A component beyond this size after scaling counts as this.
LARGEST = float(1 << 40)
# Up to here a double holds every whole number, and a float up to its own bound.
EXACT_DOUBLE, EXACT_FLOAT = 1 << 53, 1 << 24
LONGS = np.iinfo(np.int64)


def usable(vector: Column) -> Column:
    """Whether a vector is there and has no null, NaN or infinite component."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector.cast("array<double>"), finite), F.lit(False))


def matrix(vectors: pa.Array, scale: int, width: int) -> np.ndarray:
    """floor(scale * component) as doubles, one row per vector; short ones end in zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    flat = np.clip(np.floor(flat * scale), -LARGEST, LARGEST)
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    if (lengths == width).all():
        return flat.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


def whole(values: np.ndarray) -> np.ndarray:
    """Doubles that are whole numbers as Python's unbounded integers."""
    return np.vectorize(int, otypes=[object])(values) if values.size else values.astype(object)


def to_longs(values: np.ndarray) -> np.ndarray:
    """Whole numbers of any type as 64-bit ones; larger ones count as the largest."""
    if values.dtype == object:
        values = np.clip(values, int(LONGS.min) + 1, int(LONGS.max))
    return values.astype(np.int64)

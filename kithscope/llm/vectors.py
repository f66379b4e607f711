"""Helpers of the operators on vectors: which vectors count, and Arrow lists as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = 1 << 53
"""Scaled entries are held within this, where a double still tells whole numbers apart."""


def usable(vector: Column) -> Column:
    """Not null, not empty, no null, NaN or infinite entry."""
    finite = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole(vector: Column, scale: int, shift: int = 0) -> Column:
    """floor(scale * c) + shift of each entry, as longs."""
    def one(c: Column) -> Column:
        scaled = c.cast("double") * F.lit(float(scale))
        return F.floor(F.greatest(F.least(scaled, F.lit(float(WHOLE))), F.lit(-float(WHOLE)))) + F.lit(shift).cast("bigint")

    return F.transform(vector, one)


def matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """Rows of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return flat.reshape(n, len(flat) // n if n else 0)


def ints(values: np.ndarray, most: int) -> np.ndarray:
    """The integers as they are if ``most`` shows that 64 bits hold all that is made of them, else as Python's own."""
    return values if most < 1 << 62 else values.astype(object)


def largest(values: np.ndarray) -> int:
    return int(np.abs(values).max()) if values.size else 0

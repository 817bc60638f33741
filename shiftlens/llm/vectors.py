"""Vectors as whole numbers: which rows can be used, and their components as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A component in steps of 1/256.
STEPS = 256
#: Above it squares and products of two vectors would no longer fit into 64 bits.
LARGEST = 1 << 26


def usable(vector: Column) -> Column:
    """Whether there is a vector, with one component at least, and all of them are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole_steps(column: pa.ListArray, size: int) -> np.ndarray:
    """``floor(256 x)`` of a batch's vectors, one row each; all must have ``size`` components of less than 2**26 steps."""
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes != size).any():
        raise ValueError(f"vectors of {size} components expected, one has {sizes[sizes != size][0]}")
    steps = np.floor(STEPS * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(steps) and np.abs(steps).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // STEPS}")
    return steps.astype(np.int64).reshape(-1, size)

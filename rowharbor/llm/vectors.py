"""Vectors as whole numbers, and Arrow columns of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A component x counts as floor(SCALE * x), but no further from 0 than LARGEST, so that
#: products and squared distances of vectors of some thousand components fit 64 bits.
SCALE = 256
LARGEST = 1 << 24


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """(vec_id, label, ints) of the rows whose vector is not null and has neither null
    nor non-finite components; ints are their components as whole numbers."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    ints = F.transform(
        vector,
        lambda x: F.floor(
            F.greatest(F.least(SCALE * x.cast("double"), F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
        ).cast("int"),
    )
    return rows.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias(vector)).where(
        F.col(vector).isNotNull() & finite
    ).select("vec_id", "label", ints.alias("ints"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A column of number lists as rows of ``width``; shorter lists end in zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(column), width).astype(np.int64)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def lists(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as a column of number lists."""
    offsets = np.arange(0, rows.size + 1, rows.shape[1] or 1, dtype=np.int32)[: len(rows) + 1]
    if not rows.shape[1]:
        offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.astype(np.int32).ravel()))

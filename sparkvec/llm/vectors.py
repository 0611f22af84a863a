"""Vectors in Arrow columns, and which of them can be compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, not zero, every component a finite number."""

    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def selected(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector)``; integer components become double ones."""
    vector = F.col(vector_col)
    if not dict(df.dtypes)[vector_col] == "array<float>":
        vector = vector.cast("array<double>")
    return df.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of one length as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; squares of tiny or huge components neither vanish nor overflow."""
    # A power of two changes no digit.
    _, size = np.frexp(np.abs(vectors).max(axis=1, initial=0.0, keepdims=True))
    vectors = np.ldexp(vectors, -size)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)

"""Arrow list columns to numpy blocks and back; used inside tasks only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def dense_block(column, dimension: int | None = None):
    """Return ``(rows, block)`` for the well-formed vectors of a list column.

    ``rows`` are the positions kept; a null vector, a null element or a wrong
    dimension drops the position. ``block`` is float64, one vector per row.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    if dimension is None:
        dimension = int(lengths.max(initial=0))
    good = lengths == dimension
    values = column.flatten()
    if values.null_count:
        owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
        holes = values.is_null().to_numpy(zero_copy_only=False)
        good[owner[holes]] = False
    if not good.all():
        column = column.filter(pa.array(good))
        values = column.flatten()
    rows = np.flatnonzero(good)
    flat = values.to_numpy(zero_copy_only=False)
    return rows, flat.reshape(len(rows), dimension).astype(np.float64)


def scatter(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Put ``values`` at ``rows`` of a column of length ``n``; NaN and the rest are null."""
    out = np.full(n, np.nan)
    out[rows] = values
    return pa.array(out, mask=np.isnan(out))


def list_column(block: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list array holding one row of ``block`` per entry."""
    n, width = block.shape
    offsets = np.arange(0, n * width + 1, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(block.ravel(), type=kind))


def list_column_at(rows: np.ndarray, block: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """Like :func:`list_column`, with nulls at the positions not in ``rows``."""
    if len(rows) == n:
        return list_column(block, kind)
    width = block.shape[1]
    present = np.zeros(n, dtype=bool)
    present[rows] = True
    ends = np.concatenate([[0], np.cumsum(np.where(present, width, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(ends), pa.array(block.ravel(), type=kind), mask=pa.array(~present)
    )


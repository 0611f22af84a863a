"""Scalar quantization: per-dimension affine codes of 8 or 4 bits."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from .arrow import dense_block, list_column_at
from .codec import pack, unpack

# Code range of each quantizer as (steps, lowest code).
LEVELS = {"int8": (255, -128), "int4": (15, 0)}


def quantizer_ranges(df: DataFrame, field: str, dimension: int) -> DataFrame:
    """Rows ``(dim, lo, hi)``: minimum and maximum per dimension.

    Each task folds its batches to one row per dimension; only those rows are
    shuffled. Rows with NaN or infinite elements do not take part.
    """

    def fold(batches):
        lo, hi = np.full(dimension, np.inf), np.full(dimension, -np.inf)
        for batch in batches:
            _, block = dense_block(batch.column(0), dimension)
            block = block[np.isfinite(block).all(axis=1)]
            if len(block):
                lo, hi = np.minimum(lo, block.min(axis=0)), np.maximum(hi, block.max(axis=0))
        if np.isfinite(lo).all():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimension, dtype=np.int32)), pa.array(lo), pa.array(hi)],
                names=["dim", "lo", "hi"],
            )

    parts = df.select(field).mapInArrow(fold, "dim int, lo double, hi double")
    return parts.groupBy("dim").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


@dataclass(frozen=True)
class HalfQuantizer:
    """fp16: two bytes per element, nothing to train."""

    dimension: int
    kind: str = "fp16"

    def encode(self, column: Column | str) -> Column:
        return F.when(F.size(column) == self.dimension, pack(column, "fp16"))

    def decode(self, column: Column | str) -> Column:
        return unpack(column, "fp16")

    def read(self, column, dimension: int):
        """Positions and values of a column of codes, inside a task."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        sizes = pc.fill_null(pc.binary_length(column), -1).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(sizes == 2 * dimension)
        raw = b"".join(column.take(pa.array(rows)).to_pylist())
        return rows, np.frombuffer(raw, "<f2").reshape(len(rows), dimension).astype(np.float64)


def trained(df: DataFrame, field: str, kind: str, dimension: int) -> HalfQuantizer | Quantizer:
    """Quantizer of a kind an index may ask for: fp16, int8 or int4."""
    return HalfQuantizer(dimension) if kind == "fp16" else Quantizer.train(df, field, kind, dimension)


@dataclass(frozen=True)
class Quantizer:
    """Trained ranges: two doubles per dimension."""

    kind: str
    lo: np.ndarray
    hi: np.ndarray

    @classmethod
    def train(cls, df: DataFrame, field: str, kind: str, dimension: int) -> "Quantizer":
        if kind not in LEVELS:
            raise InvalidArgument(f"unknown quantizer '{kind}'")
        rows = sorted(quantizer_ranges(df, field, dimension).collect())  # one row per dimension
        lo, hi = np.zeros(dimension), np.zeros(dimension)
        for dim, low, high in rows:
            lo[dim], hi[dim] = low, high
        return cls(kind, lo, hi)

    @property
    def dimension(self) -> int:
        return len(self.lo)

    def codes(self, block: np.ndarray) -> np.ndarray:
        steps, least = LEVELS[self.kind]
        width = self.hi - self.lo
        flat = width == 0
        share = (block - self.lo) / np.where(flat, 1.0, width)
        level = np.floor(np.clip(np.where(flat, 0.0, share), 0.0, 1.0) * steps + 0.5)
        return (level + least).astype(np.int8)

    def values(self, codes: np.ndarray) -> np.ndarray:
        steps, least = LEVELS[self.kind]
        return self.lo + (codes.astype(np.float64) - least) * (self.hi - self.lo) / steps

    def encode(self, column: Column | str) -> Column:
        """array<tinyint> codes; unusable vectors give null."""

        @F.arrow_udf(T.ArrayType(T.ByteType()))
        def coded(vectors: pa.Array) -> pa.Array:
            rows, block = dense_block(vectors, self.dimension)
            sound = ~np.isnan(block).any(axis=1)
            rows, block = rows[sound], block[sound]
            return list_column_at(rows, self.codes(block), len(vectors), pa.int8())

        return coded(column)

    def read(self, column, dimension: int):
        """Positions and values of a column of codes, inside a task."""
        rows, codes = dense_block(column, dimension)
        return rows, self.values(codes)

    def decode(self, column: Column | str) -> Column:
        """array<double> of the values the codes stand for."""

        @F.arrow_udf(T.ArrayType(T.DoubleType()))
        def decoded(codes: pa.Array) -> pa.Array:
            rows, block = dense_block(codes, self.dimension)
            return list_column_at(rows, self.values(block), len(codes), pa.float64())

        return decoded(column)

"""Vector encodings as column functions over Arrow batches.

Layouts are little-endian. int4 puts the first of two values in the high nibble
and pads an odd length with zero; bit vectors put the first of eight in the most
significant place; fp16 cuts the mantissa instead of rounding it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from .arrow import list_column

# Names of the dense encodings.
ENCODINGS = ("fp32", "fp64", "fp16", "int8", "int16", "int4", "binary32", "binary64")
_PLAIN = {"fp32": "<f4", "fp64": "<f8", "int8": "<i1", "int16": "<i2"}


def fp16_bits(values: np.ndarray) -> np.ndarray:
    """Half-precision bit patterns of float32 values, truncated toward zero."""
    bits = values.astype(np.float32).view(np.uint32)
    sign = (bits >> 16) & 0x8000
    exponent = ((bits >> 23) & 0xFF).astype(np.int64)
    mantissa = bits & 0x7FFFFF
    half = exponent - 112
    shift = np.clip(14 - half, 0, 31).astype(np.uint32)
    tiny = ((mantissa | 0x800000) >> shift) & 0x3FF
    body = np.select(
        [exponent == 0, exponent == 255, half >= 31, half > 0, half > -10],
        [0, 0x7C00 | (mantissa >> 13), 0x7C00, (np.maximum(half, 0) << 10) | (mantissa >> 13), tiny],
        0,
    )
    return (sign | body).astype(np.uint16)


def fp16_values(bits: np.ndarray) -> np.ndarray:
    return bits.view(np.float16).astype(np.float32)


def _encode_flat(values: np.ndarray, encoding: str) -> np.ndarray:
    """Bytes of one run of equally long vectors, as (rows, bytes)."""
    n = len(values)
    if encoding == "fp16":
        return fp16_bits(values).astype("<u2").view(np.uint8).reshape(n, -1)
    if encoding in ("fp32", "fp64"):
        return np.ascontiguousarray(values.astype(_PLAIN[encoding])).view(np.uint8).reshape(n, -1)
    whole = values.astype(np.int64)
    if encoding in ("int8", "int16"):  # out of range wraps
        return np.ascontiguousarray(whole.astype(_PLAIN[encoding])).view(np.uint8).reshape(n, -1)
    if encoding == "int4":
        if whole.shape[1] % 2:
            whole = np.column_stack([whole, np.zeros(n, np.int64)])
        low = (whole & 0xF).astype(np.uint8)
        return (low[:, ::2] << 4) | low[:, 1::2]
    return np.packbits(whole != 0, axis=1)


def _decode_flat(raw: np.ndarray, encoding: str) -> np.ndarray:
    if encoding == "fp16":
        return fp16_values(raw.view("<u2"))
    if encoding in _PLAIN:
        return raw.view(_PLAIN[encoding])
    if encoding == "int4":  # unsigned nibbles
        return np.stack([raw >> 4, raw & 0xF], axis=2).reshape(len(raw), -1)
    return np.unpackbits(raw, axis=1)


def _by_length(lengths: np.ndarray):
    for width in np.unique(lengths[lengths >= 0]):
        yield int(width), np.flatnonzero(lengths == width)


def _in_order(parts: list[pa.Array], rows: list[np.ndarray]) -> pa.Array:
    """One column from parts that hold the given row positions."""
    place = np.argsort(np.concatenate(rows), kind="stable")
    return pa.concat_arrays(parts).take(pa.array(place))


def _binary_rows(block: np.ndarray) -> pa.Array:
    n, width = block.shape
    offsets = (np.arange(n + 1) * width).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(block).tobytes())]
    return pa.Array.from_buffers(pa.binary(), n, buffers)


def _binary_bytes(cells: pa.Array) -> np.ndarray:
    """All bytes of a binary column without nulls, end to end."""
    _, offsets, data = cells.cast(pa.binary()).buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[cells.offset : cells.offset + len(cells) + 1]
    if data is None or not len(cells):
        return np.empty(0, np.uint8)
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]]


def _check(encoding: str) -> str:
    if encoding not in ENCODINGS:
        raise InvalidArgument(f"unknown encoding '{encoding}'")
    return encoding


def pack(column: Column | str, encoding: str) -> Column:
    """Array of numbers to packed binary. Null vectors and null elements give null."""
    _check(encoding)

    @F.arrow_udf("binary")
    def packed(vectors: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False).copy()
        values = vectors.flatten()
        if values.null_count:
            owner = np.repeat(np.arange(len(lengths)), np.maximum(lengths, 0))
            lengths[owner[values.is_null().to_numpy(zero_copy_only=False)]] = -1
        parts, order = [], []
        for width, rows in _by_length(lengths):
            flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            block = flat.reshape(len(rows), width)
            parts.append(_binary_rows(_encode_flat(block, encoding) if width else block.astype(np.uint8)))
            order.append(rows)
        missing = np.flatnonzero(lengths < 0)
        return _in_order([*parts, pa.nulls(len(missing), pa.binary())], [*order, missing])

    return packed(column)


# Element type a decoded column gets.
DECODED: dict[str, T.DataType] = {
    "fp32": T.FloatType(),
    "fp64": T.DoubleType(),
    "fp16": T.FloatType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int4": T.ByteType(),
    "binary32": T.ByteType(),
    "binary64": T.ByteType(),
}
_ELEMENT_BYTES = {"fp32": 4, "fp64": 8, "fp16": 2, "int16": 2}


def unpack(column: Column | str, encoding: str) -> Column:
    """Packed binary to array of numbers; a torn last element gives null."""
    _check(encoding)
    kind = DECODED[encoding]

    @F.arrow_udf(T.ArrayType(kind))
    def unpacked(cells: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        element = to_arrow_type(kind)
        lengths = pc.fill_null(pc.binary_length(cells), -1).to_numpy(zero_copy_only=False).copy()
        lengths[lengths % _ELEMENT_BYTES.get(encoding, 1) != 0] = -1
        parts, order = [], []
        for width, rows in _by_length(lengths):
            raw = _binary_bytes(cells.take(pa.array(rows))).reshape(len(rows), width)
            block = _decode_flat(raw, encoding) if width else np.zeros((len(rows), 0))
            parts.append(list_column(np.ascontiguousarray(block), element))
            order.append(rows)
        missing = np.flatnonzero(lengths < 0)
        return _in_order([*parts, pa.nulls(len(missing), pa.list_(element))], [*order, missing])

    return unpacked(column)


def _elementwise(column: Column | str, fn: Callable[[np.ndarray], np.ndarray], kind: T.DataType) -> Column:
    """Apply ``fn`` to every element of an array column; nulls stay null."""

    @F.arrow_udf(T.ArrayType(kind))
    def mapped(vectors: pa.Array) -> pa.Array:
        from pyspark.sql.pandas.types import to_arrow_type

        values = vectors.flatten()
        holes = values.is_null().to_numpy(zero_copy_only=False) if values.null_count else None
        done = fn(values.to_numpy(zero_copy_only=False))
        lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        body = pa.array(done, type=to_arrow_type(kind), mask=holes)
        mask = vectors.is_null() if vectors.null_count else None
        return pa.ListArray.from_arrays(offsets, body, mask=mask)

    return mapped(column)


def truncate_fp16(column: Column | str) -> Column:
    """Array of floats holding the fp16-representable values."""
    return _elementwise(
        column, lambda v: fp16_values(fp16_bits(np.asarray(v, dtype=np.float32))), T.FloatType()
    )


def sign_bits(column: Column | str) -> Column:
    """Binary embedding: one bit per element, set where the element is positive."""
    return pack(
        F.transform(F.col(column) if isinstance(column, str) else column, lambda x: (x > 0).cast("int")),
        "binary64",
    )


def sign_words(column: Column | str, dimension: int) -> Column:
    """The same bits as an array of 64-bit words, built from plain expressions."""
    column = F.col(column) if isinstance(column, str) else column

    def word(start: int) -> Column:
        part = F.slice(column, start + 1, min(64, dimension - start))
        return F.aggregate(
            part,
            F.lit(0).cast("bigint"),
            lambda acc, x: F.shiftleft(acc, 1).bitwiseOR((x > 0).cast("bigint")),
        )

    return F.when(F.size(column) == dimension, F.array(*[word(s) for s in range(0, dimension, 64)]))


def bit_words(column: Column | str) -> Column:
    """Packed bits (binary) as 64-bit words, padded with zero bits at the end."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def words(cells: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.binary_length(cells), 0).to_numpy(zero_copy_only=False)
        counts = -(-lengths // 8)
        ends = np.concatenate([[0], np.cumsum(counts)])
        # Each value's bytes go to the start of its words; the rest stays zero.
        padded = np.zeros(8 * ends[-1], np.uint8)
        raw = _binary_bytes(pc.fill_null(cells, b"").cast(pa.binary()))
        shift = 8 * ends[:-1] - (np.cumsum(lengths) - lengths)
        padded[np.arange(len(raw)) + np.repeat(shift, lengths)] = raw
        offsets, body = pa.array(ends.astype(np.int32)), pa.array(padded.view(">i8").astype(np.int64))
        return pa.ListArray.from_arrays(offsets, body, mask=cells.is_null() if cells.null_count else None)

    return words(column)


def _count_bits(words: Column) -> Column:
    return F.aggregate(words, F.lit(0), lambda acc, w: acc + F.bit_count(w))


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two word arrays; its square root is l2 on bits."""
    return _count_bits(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)))


def common_bits(a: Column, b: Column) -> Column:
    """Bits set in both word arrays: the inner product on bits."""
    return _count_bits(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)))


def bit_score(metric: str, a: Column, b: Column) -> Column:
    """The four metrics on bit vectors. mipsl2 takes the word width as norm bound.

    Vectors of another width have no score.
    """
    return F.when(F.size(a) == F.size(b), _bit_score(metric, a, b))


def _bit_score(metric: str, a: Column, b: Column) -> Column:
    both = common_bits(a, b).cast("double")
    if metric == "l2":
        return F.sqrt(hamming(a, b).cast("double"))
    if metric == "ip":
        return both
    sizes = F.sqrt(_count_bits(a).cast("double")) * F.sqrt(_count_bits(b).cast("double"))
    if metric == "cosine":
        return F.lit(1.0) - F.try_divide(both, sizes)
    if metric == "mipsl2":
        bound = (F.size(a) * 64).cast("double")
        return F.sqrt(bound + _count_bits(b).cast("double") - both * 2.0)
    raise InvalidArgument(f"unknown metric '{metric}'")

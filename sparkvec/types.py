"""Declared field types and the Spark types that hold them."""

from __future__ import annotations

from pyspark.sql import types as T

SPARSE_STRUCT = T.StructType(
    [
        T.StructField("indices", T.ArrayType(T.LongType())),
        T.StructField("values", T.ArrayType(T.FloatType())),
    ]
)

# Spark has no unsigned types: 32 bits fit a bigint, 64 bits need a decimal.
SCALARS: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint32": T.LongType(),
    "uint64": T.DecimalType(20, 0),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "binary": T.BinaryType(),
}

ARRAYS: dict[str, T.DataType] = {
    f"array_{name}": T.ArrayType(dtype) for name, dtype in SCALARS.items()
}

DENSE: dict[str, T.DataType] = {
    "vector_fp32": T.ArrayType(T.FloatType()),
    "vector_fp64": T.ArrayType(T.DoubleType()),
    "vector_fp16": T.ArrayType(T.FloatType()),
    "vector_int8": T.ArrayType(T.ByteType()),
    "vector_int16": T.ArrayType(T.ShortType()),
    "vector_int4": T.ArrayType(T.ByteType()),
    "vector_binary32": T.BinaryType(),
    "vector_binary64": T.BinaryType(),
}

SPARSE: dict[str, T.DataType] = {
    "sparse_vector_fp32": SPARSE_STRUCT,
    "sparse_vector_fp16": SPARSE_STRUCT,
}

VECTORS = {**DENSE, **SPARSE}
FORWARD = {**SCALARS, **ARRAYS}
ALL = {**FORWARD, **VECTORS}

VECTOR_INDEXES = ("hnsw", "ivf", "flat")
SCALAR_INDEXES = ("invert",)
METRICS = ("l2", "ip", "cosine", "mipsl2")
QUANTIZERS = ("fp16", "int8", "int4")

# Inclusive ranges that a Spark type wider than the declared one must respect.
RANGES = {
    "uint32": (0, 2**32 - 1),
    "uint64": (0, 2**64 - 1),
    "array_uint32": (0, 2**32 - 1),
    "array_uint64": (0, 2**64 - 1),
    "vector_int4": (-8, 15),
}


def spark_type(name: str) -> T.DataType:
    return ALL[name]


def is_vector(name: str) -> bool:
    return name in VECTORS


def is_sparse(name: str) -> bool:
    return name in SPARSE


def is_bits(name: str) -> bool:
    return name in ("vector_binary32", "vector_binary64")


def declared_name(dtype: T.DataType) -> str:
    """Best declared name for a Spark type that carries no metadata."""
    if isinstance(dtype, T.DecimalType):
        return "uint64" if (dtype.precision, dtype.scale) == (20, 0) else dtype.simpleString()
    if isinstance(dtype, T.StructType):
        return "sparse_vector_fp32" if set(dtype.names) == {"indices", "values"} else dtype.simpleString()
    if isinstance(dtype, T.ArrayType):
        inner = declared_name(dtype.elementType)
        return f"array_{inner}" if inner in SCALARS else dtype.simpleString()
    for name, known in SCALARS.items():
        if type(known) is type(dtype):
            return name
    return dtype.simpleString()

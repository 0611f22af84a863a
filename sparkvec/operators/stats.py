"""Counts and profiles of a collection, each one aggregate pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types as vt
from ..functions.sparse import nnz
from ..schema import Field, Schema, field_of
from ..sources.records import observed_dimension

# Bytes of one value of a fixed-width type.
_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8}


def doc_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("doc_count"))


def index_completeness(base: DataFrame, indexed: DataFrame, *, pk: str) -> DataFrame:
    """One row: share of documents the index table holds; 1.0 for no documents."""
    held = indexed.select(pk).distinct().withColumn("_in", F.lit(1.0))
    share = F.avg(F.coalesce("_in", F.lit(0.0)))
    return base.select(pk).join(held, pk, "left").agg(F.coalesce(share, F.lit(1.0)).alias("completeness"))


def value_bytes(column: Column, kind: T.DataType) -> Column:
    """Bytes of the values themselves, without any container overhead."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(column).cast("bigint")
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        if inner.simpleString() in _WIDTHS:
            return F.size(column).cast("bigint") * _WIDTHS[inner.simpleString()]
        return F.aggregate(
            column,
            F.lit(0).cast("bigint"),
            lambda acc, x: acc + F.coalesce(value_bytes(x, inner), F.lit(0).cast("bigint")),
        )
    if isinstance(kind, T.StructType):
        parts = [value_bytes(column.getField(f.name), f.dataType) for f in kind.fields]
        total = parts[0]
        for part in parts[1:]:
            total = total + part
        return total
    width = _WIDTHS.get(kind.simpleString(), 8)
    if isinstance(kind, T.DecimalType) and kind.precision > 18:
        width = 16
    return F.when(column.isNotNull(), F.lit(width).cast("bigint"))


def _length(field: Field, column: Column, kind: T.DataType) -> Column:
    """Elements of a vector or array, stored entries of a sparse vector."""
    if vt.is_sparse(field.type):
        return nnz(column)
    if field.is_vector:
        return observed_dimension(field, column)
    if isinstance(kind, T.ArrayType):
        return F.size(column)
    return F.lit(None).cast("int")


def storage_profile(df: DataFrame) -> DataFrame:
    """Per field: type, rows, nulls, bytes, and least and greatest length."""
    measures = []
    for struct in df.schema.fields:
        field, column = field_of(struct), F.col(f"`{struct.name}`")
        length = _length(field, column, struct.dataType)
        measures.append(
            F.struct(
                F.lit(field.name).alias("field"),
                F.lit(field.type).alias("type"),
                F.count(F.lit(1)).alias("docs"),
                F.count_if(column.isNull()).alias("nulls"),
                F.coalesce(F.sum(value_bytes(column, struct.dataType)), F.lit(0)).alias("bytes"),
                F.min(length).alias("min_length"),
                F.max(length).alias("max_length"),
            )
        )
    return df.agg(F.array(*measures).alias("m")).select(F.inline("m"))


def schema_report(df: DataFrame, schema: Schema) -> DataFrame:
    """Per declared field: its facts beside what one scan of the data shows."""
    rows = []
    for field in schema.fields:
        present = field.name in df.columns
        column = F.col(f"`{field.name}`") if present else F.lit(None).cast(vt.spark_type(field.type))
        kind = df.schema[field.name].dataType if present else vt.spark_type(field.type)
        length = _length(field, column, kind)
        violation = F.lit(False) if field.nullable else column.isNull()
        if field.is_vector and not vt.is_sparse(field.type):
            violation = violation | F.coalesce(length != field.dimension, F.lit(False))
        if vt.is_sparse(field.type):
            beyond = F.array_max(column.getField("indices")) >= field.dimension
            violation = violation | F.coalesce(beyond, F.lit(False))
        rows.append(
            F.struct(
                F.lit(field.name).alias("field"),
                F.lit(field.type).alias("declared_type"),
                F.lit(kind.simpleString() if present else None).cast("string").alias("actual_type"),
                F.lit("vector" if field.is_vector else "forward").alias("category"),
                F.lit(field.primary_key).alias("primary_key"),
                F.lit(field.nullable).alias("nullable"),
                F.lit(field.dimension).alias("dimension"),
                F.lit(field.index.type if field.index else None).cast("string").alias("index_type"),
                F.count_if(column.isNull()).alias("nulls"),
                F.min(length).alias("min_length"),
                F.max(length).alias("max_length"),
                F.count_if(violation).alias("violations"),
            )
        )
    return df.agg(F.array(*rows).alias("m")).select(F.inline("m"))

"""Plain records in and out, and their validation against a schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import types as vt
from ..functions.codec import pack, truncate_fp16, unpack
from ..functions.sparse import sparse_error
from ..schema import META, Field, Schema

PRESENT = "_present"


def _present(df: DataFrame, name: str) -> Column:
    """Whether the record carries the field at all.

    With a ``_present`` column (array of field names) an explicit null counts as
    present. Without it a null is all a table has to say "absent" with.
    """
    if name not in df.columns:
        return F.lit(False)
    if PRESENT in df.columns:
        return F.coalesce(F.array_contains(PRESENT, name), F.lit(False))
    return F.col(f"`{name}`").isNotNull()


def _same_type(actual: T.StructField, declared: Field) -> bool:
    meta = (actual.metadata or {}).get(META)
    if meta:
        return meta["type"] == declared.type
    return actual.dataType.simpleString() == vt.spark_type(declared.type).simpleString()


def _type_name(actual: T.StructField) -> str:
    meta = (actual.metadata or {}).get(META)
    return meta["type"] if meta else vt.declared_name(actual.dataType)


def observed_dimension(field: Field, column: Column) -> Column:
    """Elements per vector; null for sparse vectors."""
    if vt.is_sparse(field.type):
        return F.lit(None).cast("int")
    if vt.is_bits(field.type):
        return F.octet_length(column) * 8
    return F.size(column)


def _vector_error(field: Field, column: Column) -> Column:
    name = field.name
    if vt.is_sparse(field.type):
        last = F.array_max(column.getField("indices"))
        broken = sparse_error(column.getField("indices"), column.getField("values"))
        holes = F.when(
            F.exists(column.getField("indices"), lambda x: x.isNull()) | F.exists(column.getField("values"), lambda x: x.isNull()),
            F.lit(f"vector field '{name}' has a null element"),
        )
        high = F.when(
            last >= field.dimension,
            F.concat(
                F.lit(f"vector field '{name}' has index "),
                last.cast("string"),
                F.lit(f", expected below {field.dimension}"),
            ),
        )
        return F.when(column.isNotNull(), F.coalesce(holes, broken, high))
    actual = observed_dimension(field, column)
    expected = -(-field.dimension // 8) * 8 if vt.is_bits(field.type) else field.dimension
    wrong = F.when(
        column.isNotNull() & (actual != expected),
        F.concat(
            F.lit(f"vector field '{name}' has dimension "),
            actual.cast("string"),
            F.lit(f", expected {field.dimension}"),
        ),
    )
    if vt.is_bits(field.type):
        return wrong
    hole = F.when(
        F.exists(column, lambda x: x.isNull()), F.lit(f"vector field '{name}' has a null element")
    )
    return F.coalesce(wrong, hole)


def _range_error(field: Field, column: Column) -> Column | None:
    if field.type not in vt.RANGES:
        return None
    low, high = (F.lit(str(v)).cast("decimal(20,0)") for v in vt.RANGES[field.type])

    def outside(x: Column) -> Column:
        number = x.cast("decimal(20,0)")
        return (number < low) | (number > high)

    bad = outside(column) if field.type in vt.SCALARS else F.exists(column, outside)
    return F.when(bad, F.lit(f"field '{field.name}' is out of range for {field.type}"))


def error_column(df: DataFrame, schema: Schema) -> Column:
    """First violation of each record, or null. Unknown fields are accepted."""
    actual = {f.name: f for f in df.schema.fields}
    key = schema.pk
    checks: list[Column] = []
    no_key = F.col(f"`{key}`").isNull() if key in actual else F.lit(True)
    checks.append(F.when(no_key, F.lit("primary key must be set")))
    for field in schema.fields:
        if not field.nullable and not field.primary_key:
            checks.append(
                F.when(
                    ~_present(df, field.name), F.lit(f"required field '{field.name}' is missing")
                )
            )
    known = [f for f in schema.fields if f.name in actual]
    for field in known:
        if not _same_type(actual[field.name], field):
            got = _type_name(actual[field.name])
            checks.append(
                F.when(
                    F.col(f"`{field.name}`").isNotNull(),
                    F.lit(f"field '{field.name}' has type {got}, expected {field.type}"),
                )
            )
    for field in known:
        if not _same_type(actual[field.name], field):
            continue
        column = F.col(f"`{field.name}`")
        if field.is_vector:
            checks.append(_vector_error(field, column))
        ranged = _range_error(field, column)
        if ranged is not None:
            checks.append(ranged)
    return F.coalesce(*checks, F.lit(None).cast("string"))


def validate_records(df: DataFrame, schema: Schema, name: str = "error") -> DataFrame:
    """Add the first violation of every record as column ``name``."""
    return df.withColumn(name, error_column(df, schema))


def split_valid(df: DataFrame, schema: Schema) -> tuple[DataFrame, DataFrame]:
    """Records that pass, and the others with their ``error``."""
    checked = validate_records(df, schema)
    return checked.where("error is null").drop("error"), checked.where("error is not null")


def conform_column(field: Field, column: Column, source: T.DataType) -> Column:
    """``column`` (of type ``source``) as the declared type; null if it has no such form.

    Vectors may arrive as lists or in packed form, whichever the field stores.
    """
    kind = vt.spark_type(field.type)
    listed = isinstance(source, T.ArrayType)
    if vt.is_sparse(field.type):
        if not isinstance(source, T.StructType):
            return F.lit(None).cast(kind)
        parts = [
            _element_cast(column.getField(n), kind[n].dataType).alias(n) for n in ("indices", "values")
        ]
        if field.type == "sparse_vector_fp16":
            parts[1] = truncate_fp16(column.getField("values").try_cast(kind["values"].dataType)).alias("values")
        return F.when(column.isNotNull(), F.struct(*parts))
    if vt.is_bits(field.type) and listed:
        return pack(column, field.type.removeprefix("vector_"))
    if field.is_vector and isinstance(kind, T.ArrayType) and isinstance(source, T.BinaryType):
        return unpack(column, field.type.removeprefix("vector_"))
    if isinstance(kind, T.ArrayType):
        if not listed:
            return F.lit(None).cast(kind)
        column = _element_cast(column, kind)
        return truncate_fp16(column) if field.type == "vector_fp16" else column
    if isinstance(source, (T.ArrayType, T.StructType, T.MapType)):
        return F.lit(None).cast(kind)
    return column.try_cast(kind)


def _element_cast(column: Column, kind: T.ArrayType) -> Column:
    """Cast an array; one element that cannot be cast makes the whole array null."""
    cast = column.try_cast(kind)
    lost = F.exists(
        F.zip_with(column, cast, lambda old, new: old.isNotNull() & new.isNull()), lambda x: x
    )
    return F.when(~lost, cast)


def conform_records(
    df: DataFrame, schema: Schema, errors: str | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Cast plain records to the declared fields.

    Columns the schema does not know are dropped (but for ``carry``), missing ones
    become null. A value that cannot be cast becomes null and, with ``errors``, is
    named there.
    """
    out, problems = [], []
    for field in schema.fields:
        meta = field.to_struct_field().metadata
        if field.name not in df.columns:
            empty = F.lit(None).cast(vt.spark_type(field.type))
            out.append(empty.alias(field.name, metadata=meta))
            continue
        raw = F.col(f"`{field.name}`")
        value = conform_column(field, raw, df.schema[field.name].dataType)
        out.append(value.alias(field.name, metadata=meta))
        problems.append(
            F.when(
                raw.isNotNull() & value.isNull(),
                F.lit(f"field '{field.name}' cannot be read as {field.type}"),
            )
        )
    out += [F.col(c) for c in (PRESENT, *carry) if c in df.columns]
    if errors:
        out.append(F.coalesce(*problems, F.lit(None).cast("string")).alias(errors))
    return df.select(*out)


def export_records(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Plain columns without the declared facts."""
    names = fields or [c for c in df.columns if not c.startswith("_")]
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={}) for c in names])


def null_profile(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Rows ``(field, null_count)``: one aggregate pass, then one row per field."""
    names = fields or df.columns
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names])
    return wide.unpivot([], list(names), "field", "null_count")

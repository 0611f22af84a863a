"""Schema changes as projections over a collection's rows."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..functions.predicates import predicate
from ..schema import Field, field_of
from ..sources.records import conform_column
from ..types import spark_type


def add_column(df: DataFrame, field: Field, default: str | None = None) -> DataFrame:
    """Add a field; ``default`` is an expression over the existing scalar fields."""
    if field.name in df.columns:
        raise InvalidArgument(f"field '{field.name}' already exists")
    if default is None and not field.nullable:
        raise InvalidArgument(f"field '{field.name}' is not nullable and has no default")
    value = F.lit(None) if default is None else predicate(df, default)
    return df.withColumn(
        field.name, value.cast(spark_type(field.type))
    ).withMetadata(field.name, field.to_struct_field().metadata)


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Remove a field; no-op when it is absent. The key cannot be removed."""
    if name in df.columns and field_of(df.schema[name]).primary_key:
        raise InvalidArgument("the primary key cannot be dropped")
    return df.drop(name)


def rename_column(df: DataFrame, name: str, new_name: str) -> DataFrame:
    if name not in df.columns:
        raise InvalidArgument(f"unknown field '{name}'")
    if new_name in df.columns and new_name != name:
        raise InvalidArgument(f"field '{new_name}' already exists")
    field = replace(field_of(df.schema[name]), name=new_name)
    renamed = df.withColumnRenamed(name, new_name)
    if not df.schema[name].metadata:
        return renamed
    return renamed.withMetadata(new_name, field.to_struct_field().metadata)


def cast_column(df: DataFrame, field: Field) -> tuple[DataFrame, DataFrame]:
    """Give a field a new type: ``(rows, errors)``.

    A value that cannot be cast becomes null in the rows; ``errors`` holds those
    rows with their old value.
    """
    if field.name not in df.columns:
        raise InvalidArgument(f"unknown field '{field.name}'")
    if field_of(df.schema[field.name]).primary_key and field.type != "string":
        raise InvalidArgument("primary key field must be of type string")
    old = F.col(f"`{field.name}`")
    new = conform_column(field, old, df.schema[field.name].dataType)
    rows = df.withColumn(field.name, new).withMetadata(
        field.name, field.to_struct_field().metadata
    )
    return rows, df.where(old.isNotNull() & new.isNull())

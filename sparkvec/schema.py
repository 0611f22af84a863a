"""Collection schemas: declared fields, their rules, and their Spark form.

Facts Spark types cannot hold (primary key, dimension, declared nullability,
index options) travel as ``StructField.metadata``, which survives Parquet.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import types as vt
from .errors import InvalidArgument

META = "sparkvec"


@dataclass(frozen=True)
class Index:
    """Options of an index on one field; unset options take job defaults."""

    type: str
    metric: str | None = None
    quantize: str | None = None
    m: int | None = None
    ef_construction: int | None = None
    n_list: int | None = None
    n_iters: int | None = None
    use_soar: bool | None = None
    enable_range_opt: bool | None = None
    enable_wildcard: bool | None = None

    def to_dict(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if v is not None}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    primary_key: bool = False
    nullable: bool = False
    dimension: int = 0
    index: Index | None = None

    def __post_init__(self):
        if self.primary_key and self.nullable:
            object.__setattr__(self, "nullable", False)

    @property
    def is_vector(self) -> bool:
        return vt.is_vector(self.type)

    def to_struct_field(self) -> T.StructField:
        meta = {
            "type": self.type,
            "primary_key": self.primary_key,
            "nullable": self.nullable,
            "dimension": self.dimension,
        }
        if self.index is not None:
            meta["index"] = json.dumps(self.index.to_dict(), sort_keys=True)
        # Parquet reads every column back as nullable, so the table says so too.
        return T.StructField(self.name, vt.spark_type(self.type), True, {META: meta})


@dataclass(frozen=True)
class Schema:
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)
    max_doc_count_per_segment: int | None = None

    def add(self, name: str, type: str, *, index=None, **options) -> "Schema":
        if isinstance(index, str):
            index = Index(index)
        elif isinstance(index, dict):
            index = Index(**index)
        return replace(self, fields=(*self.fields, Field(name, type, index=index, **options)))

    def with_segment_size(self, n: int) -> "Schema":
        return replace(self, max_doc_count_per_segment=n)

    def __getitem__(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise InvalidArgument(f"unknown field '{name}'")

    def __contains__(self, name: str) -> bool:
        return any(f.name == name for f in self.fields)

    @property
    def pk(self) -> str:
        return next(f.name for f in self.fields if f.primary_key)

    def names(self, category: str = "all") -> list[str]:
        """Field names by category: all, forward, vector or indexed."""
        keep = {
            "all": lambda f: True,
            "forward": lambda f: not f.is_vector,
            "vector": lambda f: f.is_vector,
            "indexed": lambda f: f.index is not None,
        }
        if category not in keep:
            raise InvalidArgument(f"unknown field category '{category}'")
        return [f.name for f in self.fields if keep[category](f)]

    def to_struct(self) -> T.StructType:
        return T.StructType([f.to_struct_field() for f in self.fields])

    def validate(self) -> "Schema":
        problem = next(_problems(self), None)
        if problem:
            raise InvalidArgument(problem)
        return self


# The rules' texts, which callers match on, in the order in which they are reported.
RULES = {
    "name": "collection name must be a non-empty string",
    "fields": "schema must have at least one field",
    "one key": "schema must have exactly one primary key field",
    "string key": "primary key field must be of type string",
    "unique": "field names must be unique",
    "type": "unknown data type: {type}",
    "dimension": "vector field '{name}' must have dimension > 0",
    "index": "index type {index} is incompatible with data type {type} on field '{name}'",
    "segment": "max_doc_count_per_segment must be a positive integer",
}


def _problems(schema: Schema):
    """Yield rule violations; callers see the first one only."""
    if not isinstance(schema.name, str) or not schema.name:
        yield RULES["name"]
    if not schema.fields:
        yield RULES["fields"]
    keys = [f for f in schema.fields if f.primary_key]
    if len(keys) != 1:
        yield RULES["one key"]
    elif keys[0].type != "string":
        yield RULES["string key"]
    if len({f.name for f in schema.fields}) != len(schema.fields):
        yield RULES["unique"]
    for f in schema.fields:
        if f.type not in vt.ALL:
            yield RULES["type"].format(type=f.type)
    for f in schema.fields:
        if f.is_vector and f.dimension <= 0:
            yield RULES["dimension"].format(name=f.name)
    for f in schema.fields:
        if f.index is None:
            continue
        allowed = vt.VECTOR_INDEXES if f.is_vector else vt.SCALAR_INDEXES
        if f.index.type not in allowed:
            yield RULES["index"].format(index=f.index.type, type=f.type, name=f.name)
    size = schema.max_doc_count_per_segment
    if size is not None and (isinstance(size, bool) or not isinstance(size, int) or size <= 0):
        yield RULES["segment"]


def field_of(struct_field: T.StructField) -> Field:
    """Read the declared facts back; fall back to what the Spark type says."""
    meta = (struct_field.metadata or {}).get(META)
    if not meta:
        return Field(struct_field.name, vt.declared_name(struct_field.dataType), nullable=True)
    index = Index(**json.loads(meta["index"])) if meta.get("index") else None
    return Field(
        struct_field.name,
        meta["type"],
        primary_key=bool(meta["primary_key"]),
        nullable=bool(meta["nullable"]),
        dimension=int(meta["dimension"]),
        index=index,
    )


def schema_of(df: DataFrame, name: str = "collection") -> Schema:
    return Schema(name, tuple(field_of(f) for f in df.schema.fields if not f.name.startswith("_")))


def schema_to_json(schema: Schema) -> str:
    body = {
        "name": schema.name,
        "max_doc_count_per_segment": schema.max_doc_count_per_segment,
        "fields": schema.to_struct().jsonValue(),
    }
    return json.dumps(body, sort_keys=True)


def schema_from_json(text: str) -> Schema:
    body = json.loads(text)
    struct = T.StructType.fromJson(body["fields"])
    return Schema(
        body["name"],
        tuple(field_of(f) for f in struct.fields),
        body["max_doc_count_per_segment"],
    )


def stamp(df: DataFrame, schema: Schema) -> DataFrame:
    """Attach the declared metadata to matching columns (no data is touched)."""
    from pyspark.sql import functions as F

    known = {f.name: f for f in schema.fields}
    return df.select(
        *[
            F.col(f"`{c}`").alias(c, metadata=known[c].to_struct_field().metadata)
            if c in known
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )

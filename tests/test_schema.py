import pytest

from sparkvec import Field, Index, InvalidArgument, Schema
from sparkvec import types as vt
from sparkvec.schema import schema_from_json, schema_of, schema_to_json, stamp


def good():
    return Schema("c").add("id", "string", primary_key=True).add("v", "vector_fp32", dimension=4)


@pytest.mark.parametrize(
    "schema, message",
    [
        (Schema("", good().fields), "collection name must be a non-empty string"),
        (Schema(None, good().fields), "collection name must be a non-empty string"),
        (Schema("c"), "schema must have at least one field"),
        (Schema("c").add("a", "string"), "schema must have exactly one primary key field"),
        (good().add("b", "string", primary_key=True), "schema must have exactly one primary key field"),
        (Schema("c").add("id", "int64", primary_key=True), "primary key field must be of type string"),
        (good().add("v", "string"), "field names must be unique"),
        (good().add("x", "no_type"), "unknown data type: no_type"),
        (good().add("x", "vector_fp16"), "vector field 'x' must have dimension > 0"),
        (good().add("x", "sparse_vector_fp32"), "vector field 'x' must have dimension > 0"),
        (
            good().add("x", "string", index="hnsw"),
            "index type hnsw is incompatible with data type string on field 'x'",
        ),
        (
            good().add("x", "vector_fp32", dimension=2, index="invert"),
            "index type invert is incompatible with data type vector_fp32 on field 'x'",
        ),
        (good().with_segment_size(-1), "max_doc_count_per_segment must be a positive integer"),
    ],
)
def test_rules(schema, message):
    with pytest.raises(InvalidArgument, match=".*"):
        schema.validate()
    try:
        schema.validate()
    except InvalidArgument as problem:
        assert str(problem) == message


def test_all_types_accepted():
    schema = Schema("all").add("id", "string", primary_key=True)
    for name in vt.FORWARD:
        schema = schema.add(f"f_{name}", name)
    for name in vt.VECTORS:
        schema = schema.add(f"f_{name}", name, dimension=8)
    assert schema.validate() is schema
    assert len(vt.ALL) == 28


def test_primary_key_is_never_nullable():
    assert Field("id", "string", primary_key=True, nullable=True).nullable is False


def test_facts_survive_json_and_parquet(spark, tmp_path):
    schema = (
        good()
        .add("t", "string", nullable=True, index=Index("invert", enable_range_opt=True))
        .add("w", "vector_fp16", dimension=3, index={"type": "hnsw", "metric": "ip", "m": 16})
        .with_segment_size(10)
    )
    assert schema_from_json(schema_to_json(schema)) == schema
    df = spark.createDataFrame([("a", [1.0] * 4, "x", [0.5] * 3)], schema.to_struct())
    df.write.parquet(str(tmp_path / "t"))
    back = schema_of(spark.read.parquet(str(tmp_path / "t")), "c")
    assert back.fields == schema.fields
    assert stamp(df.toDF(*df.columns), schema).schema["w"].metadata == schema.to_struct()["w"].metadata


def test_field_categories():
    schema = good().add("t", "string", index="invert")
    assert schema.names("vector") == ["v"]
    assert schema.names("forward") == ["id", "t"]
    assert schema.names("indexed") == ["t"]
    with pytest.raises(InvalidArgument):
        schema.names("other")

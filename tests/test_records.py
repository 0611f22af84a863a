import pytest

from sparkvec import Schema
from sparkvec.operators.stats import index_completeness, schema_report, storage_profile
from sparkvec.schema import stamp
from sparkvec.sources.records import conform_records, export_records, split_valid, validate_records

SCHEMA = (
    Schema("docs")
    .add("id", "string", primary_key=True)
    .add("embedding", "vector_fp32", dimension=3)
    .add("title", "string")
    .add("score", "double")
    .add("tags", "array_string", nullable=True)
)
LAYOUT = "id string, embedding array<float>, title string, score double, tags array<string>"


def errors(spark, row, layout=LAYOUT, schema=SCHEMA):
    return validate_records(spark.createDataFrame([row], layout), schema).first()["error"]


@pytest.mark.parametrize(
    "row, message",
    [
        (("a", [1.0, 2.0, 3.0], "t", 1.0, ["x"]), None),
        (("a", [1.0, 2.0, 3.0], "t", 1.0, None), None),
        ((None, [1.0, 2.0, 3.0], "t", 1.0, None), "primary key must be set"),
        (("a", [1.0], "t", 1.0, None), "vector field 'embedding' has dimension 1, expected 3"),
        (("a", [1.0, None, 3.0], "t", 1.0, None), "vector field 'embedding' has a null element"),
        (("a", [1.0, 2.0, 3.0], None, 1.0, None), "required field 'title' is missing"),
        ((None, [1.0], None, None, None), "primary key must be set"),
    ],
)
def test_first_failure_wins(spark, row, message):
    assert errors(spark, row) == message


def test_wrong_type_and_unknown_field(spark):
    layout = LAYOUT.replace("score double", "score string") + ", extra int"
    got = errors(spark, ("a", [1.0, 2.0, 3.0], "t", "high", None, 1), layout)
    assert got == "field 'score' has type string, expected double"
    assert errors(spark, ("a", [1.0, 2.0, 3.0], "t"), "id string, embedding array<float>, title string") == (
        "required field 'score' is missing"
    )


def test_explicit_null_counts_as_present(spark):
    layout = LAYOUT + ", _present array<string>"
    present = ["id", "embedding", "title", "score"]
    assert errors(spark, ("a", [1.0, 2.0, 3.0], None, 1.0, None, present), layout) is None
    assert errors(spark, ("a", [1.0, 2.0, 3.0], None, 1.0, None, present[:2]), layout) == (
        "required field 'title' is missing"
    )


def test_unsigned_ranges_and_sparse_dimension(spark):
    schema = (
        Schema("u")
        .add("id", "string", primary_key=True)
        .add("big", "uint64", nullable=True)
        .add("small", "uint32", nullable=True)
        .add("s", "sparse_vector_fp32", dimension=10, nullable=True)
        .add("bits", "vector_binary32", dimension=12, nullable=True)
    )
    raw = spark.createDataFrame(
        [
            ("a", "18446744073709551615", 4294967295, ([0, 9], [1.0, 2.0]), b"ab"),
            ("b", "18446744073709551616", 0, None, None),
            ("c", "-1", 0, None, None),
            ("d", "0", 4294967296, None, None),
            ("e", "0", 0, ([10], [1.0]), None),
            ("f", "0", 0, None, b"a"),
        ],
        "id string, big string, small bigint, s struct<indices: array<int>, values: array<double>>, bits binary",
    )
    done = validate_records(conform_records(raw, schema), schema)
    got = {r["id"]: r["error"] for r in done.collect()}
    assert got == {
        "a": None,
        "b": "field 'big' is out of range for uint64",
        "c": "field 'big' is out of range for uint64",
        "d": "field 'small' is out of range for uint32",
        "e": "vector field 's' has index 10, expected below 10",
        "f": "vector field 'bits' has dimension 8, expected 12",
    }
    assert str(done.where("id = 'a'").first()["big"]) == "18446744073709551615"


def test_conform(spark):
    raw = spark.createDataFrame(
        [(1, ["1", "2", "x"], 5, "7.5", "?"), (2, ["1", "2", "3"], 6, "bad", "?")],
        "id int, embedding array<string>, title int, score string, other string",
    )
    done = conform_records(raw, SCHEMA, errors="problem")
    assert done.columns == ["id", "embedding", "title", "score", "tags", "problem"]
    first, second = done.orderBy("id").collect()
    assert (first["id"], first["embedding"], first["title"], first["score"]) == ("1", None, "5", 7.5)
    assert first["problem"] == "field 'embedding' cannot be read as vector_fp32"
    assert second["embedding"] == [1.0, 2.0, 3.0]
    assert second["problem"] == "field 'score' cannot be read as double"
    good, bad = split_valid(done.drop("problem"), SCHEMA)
    assert good.count() == 0 and bad.count() == 2


def test_fp16_fields_are_truncated(spark):
    schema = Schema("h").add("id", "string", primary_key=True).add("v", "vector_fp16", dimension=2)
    raw = spark.createDataFrame([("a", [1.0 + 2.0**-11, -65536.0])], "id string, v array<double>")
    assert conform_records(raw, schema).first()["v"] == [1.0, float("-inf")]


def test_vectors_arrive_packed_or_listed(spark):
    schema = (
        Schema("p")
        .add("id", "string", primary_key=True)
        .add("v", "vector_int8", dimension=2)
        .add("b", "vector_binary32", dimension=8)
        .add("w", "vector_fp32", dimension=1, nullable=True)
    )
    raw = spark.createDataFrame(
        [("a", bytes([1, 255]), [1, 0, 0, 0, 0, 0, 0, 1], "text")], "id string, v binary, b array<int>, w string"
    )
    done = conform_records(raw, schema, errors="problem").first()
    assert done["v"] == [1, -1] and bytes(done["b"]) == b"\x81"
    assert done["w"] is None and done["problem"] == "field 'w' cannot be read as vector_fp32"


def test_array_types_round_trip(spark):
    schema = Schema("arr").add("id", "string", primary_key=True)
    values = {
        "array_string": ["x", None],
        "array_int32": [1],
        "array_int64": [2**40],
        "array_uint32": [2**32 - 1],
        "array_uint64": [2**63],
        "array_float": [0.5],
        "array_double": [0.1],
        "array_bool": [True],
        "array_binary": [b"z"],
    }
    for name in values:
        schema = schema.add(name, name, nullable=True)
    struct = schema.to_struct()
    from decimal import Decimal

    row = ["a"] + [[Decimal(v) for v in x] if n == "array_uint64" else x for n, x in values.items()]
    df = conform_records(spark.createDataFrame([row], struct), schema)
    assert validate_records(df, schema).first()["error"] is None
    back = df.first()
    assert all(list(back[n]) == list(x) for n, x in values.items() if n != "array_uint64")


def test_export_drops_declared_facts(spark):
    df = stamp(spark.createDataFrame([("a", [1.0, 2.0, 3.0], "t", 1.0, None)], LAYOUT), SCHEMA)
    assert df.schema["embedding"].metadata
    assert not export_records(df).schema["embedding"].metadata


def test_reports(spark):
    df = stamp(spark.createDataFrame([("a", [1.0, 2.0], None, 1.0, ["é", None])], LAYOUT), SCHEMA)
    profile = {r["field"]: r for r in storage_profile(df).collect()}
    assert profile["embedding"]["type"] == "vector_fp32" and profile["embedding"]["bytes"] == 8
    assert profile["tags"]["bytes"] == 2 and profile["tags"]["max_length"] == 2
    assert profile["title"]["nulls"] == 1 and profile["title"]["bytes"] == 0
    report = {r["field"]: r for r in schema_report(df, SCHEMA).collect()}
    assert report["embedding"]["violations"] == 1 and report["title"]["violations"] == 1
    assert report["id"]["violations"] == 0 and report["tags"]["violations"] == 0
    empty = df.where("id = '?'")
    assert index_completeness(empty, empty, pk="id").first()[0] == 1.0

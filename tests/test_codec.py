import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkvec import InvalidArgument
from sparkvec.functions import codec, sparse
from sparkvec.functions.quantize import Quantizer


def one(spark, values, encoding):
    df = spark.createDataFrame([(values,)], "v array<double>")
    packed = df.select(codec.pack("v", encoding).alias("p"))
    return packed.first()[0], packed.select(codec.unpack("p", encoding)).first()[0]


@pytest.mark.parametrize(
    "encoding, values, expected",
    [
        ("fp32", [1.0, -2.5, 3.25], [1.0, -2.5, 3.25]),
        ("fp64", [0.1, -1e300], [0.1, -1e300]),
        ("int8", [-128.0, 0.0, 127.0], [-128, 0, 127]),
        ("int16", [-32768.0, 32767.0], [-32768, 32767]),
        ("int4", [1.0, 2.0, 3.0], [1, 2, 3, 0]),
        ("int4", [-1.0, 7.0], [15, 7]),
        ("binary32", [1.0, 0.0, 1.0], [1, 0, 1, 0, 0, 0, 0, 0]),
        ("binary64", [1.0] * 9, [1] * 9 + [0] * 7),
        ("fp32", [], []),
    ],
)
def test_round_trip(spark, encoding, values, expected):
    assert one(spark, values, encoding)[1] == expected


def test_layouts(spark):
    assert one(spark, [1.0, 2.0, 3.0], "int4")[0] == bytes([0x12, 0x30])
    assert one(spark, [1.0, 0.0, 1.0], "binary32")[0] == bytes([0b10100000])
    assert one(spark, [1.5], "fp32")[0] == struct.pack("<f", 1.5)
    assert one(spark, [300.0], "int8")[0] == bytes([300 & 255])


def test_nulls_and_torn_cells(spark):
    df = spark.createDataFrame([([1.0, None],), (None,), ([2.0],)], "v array<double>")
    assert [r[0] for r in df.select(codec.pack("v", "fp32")).collect()] == [None, None, struct.pack("<f", 2.0)]
    cells = spark.createDataFrame([(b"\0\0\0",), (None,), (struct.pack("<f", 2.0),)], "b binary")
    assert [r[0] for r in cells.select(codec.unpack("b", "fp32")).collect()] == [None, None, [2.0]]
    with pytest.raises(InvalidArgument):
        codec.pack("v", "fp8")


# Hand-computed half-precision patterns.
FP16 = [
    (0.0, 0x0000),
    (-0.0, 0x8000),
    (1.0, 0x3C00),
    (-2.0, 0xC000),
    (65504.0, 0x7BFF),
    (65535.0, 0x7BFF),  # truncation, rounding would overflow
    (65536.0, 0x7C00),
    (1e30, 0x7C00),
    (-1e30, 0xFC00),
    (2.0**-14, 0x0400),
    (2.0**-15, 0x0200),
    (2.0**-24, 0x0001),
    (2.0**-25, 0x0000),
    (1.0 + 2.0**-11, 0x3C00),  # a tie
    (1.0 + 3 * 2.0**-11, 0x3C01),
    (math.inf, 0x7C00),
]


def test_fp16_patterns():
    values = np.array([v for v, _ in FP16])
    assert codec.fp16_bits(values).tolist() == [b for _, b in FP16]
    assert math.isnan(codec.fp16_values(codec.fp16_bits(np.array([math.nan])))[0])


@settings(max_examples=200, deadline=None)
@given(st.floats(min_value=-60000, max_value=60000, width=32))
def test_fp16_never_grows_and_is_close(value):
    got = float(codec.fp16_values(codec.fp16_bits(np.array([value])))[0])
    assert abs(got) <= abs(value)
    assert abs(value) - abs(got) <= max(abs(value) * 2.0**-10, 2.0**-24)


def test_bit_metrics(spark):
    df = spark.createDataFrame([([1.0, -1.0, 1.0], [1.0, 1.0, -1.0])], "a array<double>, b array<double>")
    a, b = codec.sign_words("a", 3), codec.sign_words("b", 3)
    row = df.select(*[codec.bit_score(m, a, b) for m in ("l2", "ip", "cosine")]).first()
    assert row[0] == pytest.approx(math.sqrt(2)) and row[1] == 1 and row[2] == pytest.approx(0.5)


def test_packed_bit_search(spark):
    from sparkvec.operators.search import knn_bits

    rows = [("a", bytes([0xFF, 0x00])), ("b", bytes([0xF0, 0x00])), ("c", bytes([0x0F])), ("d", None)]
    df = spark.createDataFrame(rows, "id string, bits binary")
    hits = knn_bits(df, "bits", bytes([0xF0, 0x01]), pk="id", output_fields=["id"]).collect()
    assert [(r["id"], r["score"]) for r in hits] == [("b", 1.0), ("a", pytest.approx(math.sqrt(5)))]
    best = knn_bits(df, "bits", bytes([0xFF]), pk="id", metric="ip", output_fields=["id"]).first()
    assert (best["id"], best["score"]) == ("c", 4.0)


@pytest.mark.parametrize(
    "indices, values, message",
    [
        ([0, 5, 10, 100], [1.0, 2.5, -3.0, 0.5], None),
        ([], [], None),
        ([5, 3], [1.0, 2.0], sparse.UNSORTED),
        ([3, 3], [1.0, 2.0], sparse.REPEATED),
        ([-1, 3], [1.0, 2.0], sparse.NEGATIVE),
        ([1, 2], [1.0], sparse.LENGTHS),
    ],
)
def test_sparse_rules(spark, indices, values, message):
    df = spark.createDataFrame([(indices, values)], "i array<bigint>, v array<double>")
    assert df.select(sparse.sparse_error("i", "v")).first()[0] == message


def test_sparse_fractional_index(spark):
    df = spark.createDataFrame([([1.5, 2.0], [1.0, 1.0])], "i array<double>, v array<double>")
    assert df.select(sparse.sparse_error("i", "v")).first()[0] == sparse.NOT_WHOLE


def test_sparse_build_flags_repeats(spark):
    rows = [("a", 3, 1.0), ("a", 1, 2.0), ("b", 1, 1.0), ("b", 1, 5.0), ("c", -1, 1.0)]
    built = sparse.build_sparse(
        spark.createDataFrame(rows, "k string, i int, x double"), key="k", index="i", value="x"
    )
    got = {r["k"]: r for r in built.collect()}
    assert got["a"]["vector"]["indices"] == [1, 3] and got["a"]["vector"]["values"] == [2.0, 1.0]
    assert got["b"]["vector"] is None and got["b"]["error"] == sparse.REPEATED
    assert got["c"]["error"] == sparse.NEGATIVE
    back = sparse.explode_sparse(built.where("error is null"), "vector", keep=["k"])
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1, 2.0), ("a", 3, 1.0)]


def test_quantizer_bounds_the_error(spark):
    rng = np.random.default_rng(1)
    block = rng.normal(size=(200, 5))
    df = spark.createDataFrame([(r.tolist(),) for r in block] + [(None,), ([1.0],)], "v array<double>")
    for kind, steps in (("int8", 255), ("int4", 15)):
        q = Quantizer.train(df, "v", kind, 5)
        coded = df.select("v", q.encode("v").alias("c")).select("v", "c", q.decode("c").alias("d")).collect()
        half_step = (q.hi - q.lo) / steps / 2 + 1e-12
        for r in coded[:200]:
            assert (np.abs(np.array(r["v"]) - np.array(r["d"])) <= half_step).all()
        assert coded[200]["c"] is None and coded[201]["c"] is None


def test_constant_dimension_quantizes(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 3.0],)], "v array<double>")
    q = Quantizer.train(df, "v", "int8", 2)
    assert [r[0] for r in df.select(q.decode(q.encode("v"))).collect()] == [[1.0, 2.0], [1.0, 3.0]]

"""Encodings, quantization, bit vectors and sparse vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import codec, sparse
from ..functions.quantize import Quantizer, quantizer_ranges
from ..operators.hamming import hamming_join
from ..operators.quantized import knn_quantized, knn_quantized_refined, quantize_table
from ..operators.search import knn_bits
from ..schema import Schema
from ..session import scratch_path
from ..sources.collection import Collection
from ..sources.records import observed_dimension
from . import shared
from .registry import Tables, query
from .shared import DIMENSION, QUERY, rounded, vectors

# One row per element of every embedding.
_ELEMENTS = "x AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)"


def _exploded(df, column: str, name: str, kind: str = "double"):
    return df.select("vec_id", F.posexplode(column).alias("pos", name)).withColumn(name, F.col(name).cast(kind))


@query(
    "vector_dimension",
    "SELECT vec_id, len(embedding)::INTEGER AS dimension FROM embeddings",
)
def vector_dimension(spark, folder):
    field = shared.EMBEDDING_SCHEMA["embedding"]
    return Tables(spark, folder).embeddings.select(
        "vec_id", observed_dimension(field, F.col("embedding")).alias("dimension")
    )


# IEEE-754 bits by arithmetic: sign, exponent from log2, mantissa from the rest.
_FP32_HEX = """
f AS (SELECT *, abs(x::DOUBLE) AS a, floor(log2(nullif(abs(x::DOUBLE), 0))) AS p FROM x),
b AS (SELECT *, (CASE WHEN x < 0 THEN 2147483648 ELSE 0 END) + (CASE WHEN a = 0 THEN 0 ELSE
      ((p + 127)::BIGINT * 8388608) + ((a / pow(2, p) - 1) * 8388608)::BIGINT END) AS bits FROM f)
"""
_BYTE = "printf('%02X', (({v}) >> {shift}) & 255)"


def _hex_le(value: str, size: int) -> str:
    return " || ".join(_BYTE.format(v=value, shift=8 * i) for i in range(size))


@query(
    "reencode_dense",
    f"""WITH {_ELEMENTS}, {_FP32_HEX},
    c AS (SELECT *, round(x::DOUBLE * 1000)::BIGINT AS w FROM b)
    SELECT vec_id, string_agg({_hex_le('bits::BIGINT', 4)}, '' ORDER BY i) AS fp32,
           string_agg({_hex_le('w', 2)}, '' ORDER BY i) AS int16,
           string_agg({_hex_le('w', 1)}, '' ORDER BY i) AS int8
    FROM c GROUP BY vec_id""",
)
def reencode_dense(spark, folder):
    whole = F.transform("embedding", lambda x: F.round(x.cast("double") * 1000).cast("int"))
    # The one-byte form wraps, as the packed form of an out-of-range integer does.
    return Tables(spark, folder).embeddings.select(
        "vec_id",
        F.hex(codec.pack("embedding", "fp32")).alias("fp32"),
        F.hex(codec.pack(whole, "int16")).alias("int16"),
        F.hex(codec.pack(whole, "int8")).alias("int8"),
    )


@query(
    "reencode_round_trip",
    f"WITH {_ELEMENTS} SELECT vec_id, i::INTEGER AS pos, x::DOUBLE AS value FROM x",
)
def reencode_round_trip(spark, folder):
    df = Tables(spark, folder).embeddings.select("vec_id", codec.pack("embedding", "fp64").alias("packed"))
    return _exploded(df.select("vec_id", codec.unpack("packed", "fp64").alias("v")), "v", "value")


@query(
    "reencode_int4",
    f"""WITH {_ELEMENTS}, w AS (
      SELECT vec_id, i, round(x::DOUBLE * 20)::BIGINT & 15 AS n FROM x
      UNION ALL SELECT vec_id, len(embedding), label & 15 FROM embeddings
      UNION ALL SELECT vec_id, len(embedding) + 1, 0 FROM embeddings)
    SELECT vec_id, string_agg(printf('%X', n), '' ORDER BY i) AS packed FROM w GROUP BY vec_id""",
)
def reencode_int4(spark, folder):
    # An odd number of elements: the embedding and its label.
    small = F.transform("embedding", lambda x: F.round(x.cast("double") * 20).cast("int"))
    return Tables(spark, folder).embeddings.select(
        "vec_id", F.hex(codec.pack(F.concat(small, F.array("label")), "int4")).alias("packed")
    )


@query(
    "binarize_vectors",
    f"""WITH {_ELEMENTS}, b AS (
      SELECT vec_id, i // 8 AS byte, sum(CASE WHEN x > 0 THEN 1 << (7 - i % 8)::INTEGER ELSE 0 END)::BIGINT AS v
      FROM x GROUP BY ALL)
    SELECT vec_id, string_agg(printf('%02X', v), '' ORDER BY byte) AS bits FROM b GROUP BY vec_id""",
)
def binarize_vectors(spark, folder):
    return Tables(spark, folder).embeddings.select("vec_id", F.hex(codec.sign_bits("embedding")).alias("bits"))


def _bits_sql(score: str, direction: str) -> str:
    return f"""WITH {_ELEMENTS}, s AS (
      SELECT vec_id, label, {score} AS s
      FROM x JOIN (SELECT i, ((i * 37) % 101)::DOUBLE / 50 - 1 > 0 AS on_ FROM range(64) r(i)) USING (i)
      GROUP BY vec_id, label)
    SELECT vec_id, label, round(s, 6) AS score FROM s ORDER BY s {direction}, vec_id LIMIT 10"""


# The signs of the fixed query vector, packed.
_QUERY_BITS = np.packbits(np.array(QUERY) > 0).tobytes()


def _knn_bits(spark, folder, metric):
    df = Tables(spark, folder).embeddings.select("vec_id", "label", codec.sign_bits("embedding").alias("bits"))
    hits = knn_bits(df, "bits", _QUERY_BITS, pk="vec_id", metric=metric, output_fields=["label"])
    return rounded(hits)


@query("knn_binary_hamming", _bits_sql("sqrt(count(*) FILTER (WHERE (x > 0) != on_))", "ASC"))
def knn_binary_hamming(spark, folder):
    return _knn_bits(spark, folder, "l2")


@query("knn_binary_ip", _bits_sql("(count(*) FILTER (WHERE x > 0 AND on_))::DOUBLE", "DESC"))
def knn_binary_ip(spark, folder):
    return _knn_bits(spark, folder, "ip")


@query("knn_binary_words", _bits_sql("sqrt(count(*) FILTER (WHERE (x > 0) != on_))", "ASC"))
def knn_binary_words(spark, folder):
    """The same search with the words built by plain expressions, nothing stored."""
    query_words = codec.sign_words(F.array(*[F.lit(v) for v in QUERY]), DIMENSION)
    words = codec.sign_words("embedding", DIMENSION)
    df = Tables(spark, folder).embeddings.select(
        "vec_id", "label", codec.bit_score("l2", words, query_words).alias("score")
    )
    return rounded(df.orderBy("score", "vec_id").limit(10))


def _bit_join_sql(where: str = "true", key: str = "vec_id") -> str:
    return f"""WITH b AS (
      SELECT {key} AS vec_id, label, CAST(array_to_string([CASE WHEN x > 0 THEN '1' ELSE '0' END for x in embedding], '') AS BIT) AS b FROM embeddings),
    s AS (SELECT a.vec_id AS qid, m.vec_id AS pk, bit_count(xor(a.b, m.b)) AS d FROM b a, b m WHERE {where}),
    r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY d, pk) AS n FROM s)
    SELECT qid, n::INTEGER AS rank, pk, round(sqrt(d), 6) AS score FROM r WHERE n <= 10"""


@query("knn_join_binary", _bit_join_sql())
def knn_join_binary(spark, folder):
    """The ten nearest sign vectors of each, by chunks of their bits."""
    df = Tables(spark, folder).embeddings.select("vec_id", codec.sign_bits("embedding").alias("bits"))
    return rounded(hamming_join(df, df, qid="vec_id", pk="vec_id", field="bits"))


_BITS_SCHEMA = (
    Schema("bits").add("vec_id", "string", primary_key=True).add("label", "int32", nullable=True).add("bits", "vector_binary64", dimension=DIMENSION)
)


@query("collection_search_binary", _bit_join_sql("m.label = 3", "vec_id::VARCHAR"))
def collection_search_binary(spark, folder):
    """The same from a stored collection, under a filter."""
    df = Tables(spark, folder).embeddings.select(F.col("vec_id").cast("string"), "label", codec.sign_bits("embedding").alias("bits"))
    made = Collection.create(spark, scratch_path(spark, "bits"), _BITS_SCHEMA, df)
    return rounded(made.search_many(made.scan(), "bits", qid="vec_id", filter="label = 3", k=10))


@query(
    "quantize_fp16",
    f"""WITH {_ELEMENTS}, f AS (
      SELECT vec_id, i, x::DOUBLE AS x, greatest(floor(log2(nullif(abs(x::DOUBLE), 0))), -14) AS p FROM x)
    SELECT vec_id, i::INTEGER AS pos,
           CASE WHEN x = 0 THEN 0.0 ELSE sign(x) * floor(abs(x) * pow(2, 10 - p)) / pow(2, 10 - p) + 0.0 END AS value
    FROM f""",
)
def quantize_fp16(spark, folder):
    df = Tables(spark, folder).embeddings.select("vec_id", codec.truncate_fp16("embedding").alias("v"))
    # Minus zero and zero are one value for the comparison.
    return _exploded(df, "v", "value").withColumn("value", F.col("value") + F.lit(0.0))


@query(
    "quantizer_ranges",
    f"WITH {_ELEMENTS} SELECT i::INTEGER AS dim, min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM x GROUP BY i",
)
def ranges(spark, folder):
    return quantizer_ranges(Tables(spark, folder).embeddings, "embedding", DIMENSION)


def _codes_sql(steps: int, least: int) -> str:
    return f"""WITH {_ELEMENTS}, r AS (SELECT i, min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi FROM x GROUP BY i)
    SELECT vec_id, i::INTEGER AS pos,
           (floor((x::DOUBLE - lo) / (hi - lo) * {steps} + 0.5) + {least})::INTEGER AS code
    FROM x JOIN r USING (i)"""


def _codes(spark, folder, kind):
    df = Tables(spark, folder).embeddings
    quantizer = Quantizer.train(df, "embedding", kind, DIMENSION)
    return _exploded(quantize_table(df, "embedding", quantizer, keep=["vec_id"]), "codes", "code", "int")


@query("quantize_int8", _codes_sql(255, -128))
def quantize_int8(spark, folder):
    return _codes(spark, folder, "int8")


@query("quantize_int4", _codes_sql(15, 0))
def quantize_int4(spark, folder):
    return _codes(spark, folder, "int4")


# Decoded int4 codes of the stretched vectors, scored against the query vector.
_ESTIMATE = f"""{shared.VECTORS_SQL}, {shared.QUERY_SQL},
 x AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
 r AS (SELECT i, min(x) AS lo, max(x) AS hi FROM x GROUP BY i),
 c AS (SELECT vec_id, i, lo + floor((x - lo) / (hi - lo) * 15 + 0.5) * (hi - lo) / 15 AS y FROM x JOIN r USING (i)),
 d AS (SELECT vec_id, list(y ORDER BY i) AS y FROM c GROUP BY vec_id),
 s AS (SELECT vec_id, list_distance(y, q) AS s FROM d, q)"""


@query(
    "knn_quantized",
    f"WITH {_ESTIMATE} SELECT vec_id, round(s, 6) AS score FROM s ORDER BY s, vec_id LIMIT 10",
)
def knn_quantized_query(spark, folder):
    df = vectors(Tables(spark, folder))
    quantizer = Quantizer.train(df, "e", "int4", DIMENSION)
    return rounded(knn_quantized(quantize_table(df, "e", quantizer, keep=["vec_id"]), quantizer, QUERY, pk="vec_id"))


@query(
    "knn_quantized_refined",
    f"""WITH {_ESTIMATE}, top AS (SELECT vec_id FROM s ORDER BY s, vec_id LIMIT 30)
    SELECT vec_id, round(list_distance(e, q), 6) AS score, label FROM v JOIN top USING (vec_id), q
    ORDER BY list_distance(e, q), vec_id LIMIT 10""",
)
def knn_quantized_refined_query(spark, folder):
    df = vectors(Tables(spark, folder))
    quantizer = Quantizer.train(df, "e", "int4", DIMENSION)
    codes = quantize_table(df, "e", quantizer, keep=["vec_id"])
    hits = knn_quantized_refined(
        codes, df, quantizer, QUERY, pk="vec_id", field="e", k=10, scale_factor=3.0, metric="l2"
    )
    return rounded(hits)


# -- sparse --------------------------------------------------------------------

_KEPT = f"{_ELEMENTS}, k AS (SELECT vec_id, i, x FROM x WHERE abs(x) > 0.1::FLOAT)"


def _large(x):
    return F.abs(x) > F.lit(0.1).cast("float")


def _sparse(t: Tables):
    return t.embeddings.select("vec_id", sparse.from_dense("embedding", _large).alias("vector"))


@query(
    "sparse_build",
    f"""WITH {_KEPT} SELECT vec_id, count(*)::INTEGER AS nnz, string_agg(i::VARCHAR, ',' ORDER BY i) AS indices,
    round(sum(x::DOUBLE ORDER BY i), 6) AS total, NULL::VARCHAR AS error FROM k GROUP BY vec_id""",
)
def sparse_build(spark, folder):
    t = Tables(spark, folder)
    entries = t.embeddings.select("vec_id", F.posexplode("embedding").alias("i", "x")).where(_large(F.col("x")))
    built = sparse.build_sparse(entries, key="vec_id", index="i", value="x")
    total = F.aggregate("vector.values", F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return built.select(
        "vec_id",
        sparse.nnz("vector").alias("nnz"),
        F.array_join("vector.indices", ",").alias("indices"),
        F.round(total, 6).alias("total"),
        "error",
    )


@query(
    "sparse_nnz",
    "SELECT vec_id, len([x for x in embedding if abs(x) > 0.1::FLOAT])::INTEGER AS nnz FROM embeddings",
)
def sparse_nnz(spark, folder):
    return _sparse(Tables(spark, folder)).select("vec_id", sparse.nnz("vector").alias("nnz"))


@query("sparse_explode", f'WITH {_KEPT} SELECT vec_id, i::BIGINT AS "index", x::DOUBLE AS value FROM k')
def sparse_explode(spark, folder):
    rows = sparse.explode_sparse(_sparse(Tables(spark, folder)), "vector", keep=["vec_id"])
    return rows.withColumn("value", F.col("value").cast("double"))


# Index triples read off each embedding break every rule on some rows.
@query(
    "sparse_validate",
    f"""WITH t AS (SELECT vec_id, floor(embedding[1]::DOUBLE * 20)::BIGINT + 3 AS a,
      floor(embedding[2]::DOUBLE * 20)::BIGINT + 4 AS b, floor(embedding[3]::DOUBLE * 20)::BIGINT + 5 AS c,
      label FROM embeddings)
    SELECT vec_id, CASE WHEN label = 0 THEN '{sparse.LENGTHS}' WHEN a < 0 THEN '{sparse.NEGATIVE}'
      WHEN a > b THEN '{sparse.UNSORTED}' WHEN a = b THEN '{sparse.REPEATED}'
      WHEN b > c THEN '{sparse.UNSORTED}' WHEN b = c THEN '{sparse.REPEATED}' END AS error FROM t""",
)
def sparse_validate(spark, folder):
    def index(i):
        return F.floor(F.get("embedding", F.lit(i)).cast("double") * 20).cast("bigint") + 3 + i

    indices = F.array(index(0), index(1), index(2))
    values = F.when(F.col("label") == 0, F.array(F.lit(1.0))).otherwise(F.array(*[F.lit(1.0)] * 3))
    return Tables(spark, folder).embeddings.select(
        "vec_id", sparse.sparse_error(indices, values).alias("error")
    )

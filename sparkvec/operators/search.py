"""Nearest-neighbour search for one query vector.

The plan is filter -> score -> top-k: the filter and the column list reach the
Parquet scan, scoring is one vectorised pass, and ``orderBy().limit()`` keeps k
rows per task before the final merge, so nothing but k rows per task moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..functions import metrics
from ..functions.codec import bit_score, bit_words
from ..functions.predicates import where
from ..schema import schema_of

DOC_ID = "_doc_id"


def scalar_columns(df: DataFrame) -> list[str]:
    """Public columns that are neither vectors nor raw arrays of numbers."""
    return [
        f.name
        for f, s in zip(schema_of(df).fields, [c for c in df.schema.fields if not c.name.startswith("_")])
        if not f.is_vector and not _looks_like_vector(s)
    ]


def _looks_like_vector(struct_field) -> bool:
    # A bare array of floats with no declared type is taken for a vector.
    declared = (struct_field.metadata or {}).get("sparkvec")
    return declared is None and struct_field.dataType.simpleString() in ("array<float>", "array<double>")


def max_norm(df: DataFrame, field: str, dimension: int) -> Column:
    """Largest vector norm of the collection, as a scalar subquery."""
    return df.select(metrics.largest_norm(field, dimension).alias("m")).scalar()


def scored(
    df: DataFrame,
    field: str,
    vector: Sequence[float],
    *,
    metric: str = "l2",
    collection: DataFrame | None = None,
    engine: str = "arrow",
    name: str = "score",
) -> DataFrame:
    """Add the score of every row against ``vector``; undefined scores are dropped."""
    metrics.check_metric(metric)
    if not len(vector):
        raise InvalidArgument("query vector must be set")
    query = metrics.literal_vector(vector)
    whole = collection if collection is not None else df
    top = max_norm(whole, field, len(vector)) if metric == "mipsl2" else None
    if engine == "sql":
        score = metrics.score(metric, field, query, top)
    elif engine == "arrow":
        score = metrics.score_against(metric, vector)(F.col(field))
        if metric == "mipsl2":
            score = metrics.defined(metrics.mips_l2(score, metrics.squared_norm(query), top))
    else:
        raise InvalidArgument(f"unknown scoring engine '{engine}'")
    return df.withColumn(name, score).where(F.col(name).isNotNull())


def knn(
    df: DataFrame,
    field: str,
    vector: Sequence[float],
    *,
    pk: str,
    k: int = 10,
    metric: str = "l2",
    filter: str | Column | None = None,
    radius: float | None = None,
    output_fields: Sequence[str] = (),
    include_vector: bool = False,
    include_doc_id: bool = False,
    engine: str = "arrow",
) -> DataFrame:
    """Exact k nearest rows to ``vector``, closest first, ties by key.

    ``output_fields`` empty means every scalar field. ``radius`` keeps hits at or
    within that distance (at or above that value for inner product).
    """
    candidates, fields = _candidates(df, field, pk, k, filter, output_fields, include_vector, include_doc_id)
    hits = scored(candidates, field, vector, metric=metric, collection=df, engine=engine)
    return _closest(hits, [pk, "score", *fields], pk, k, metric, radius)


def knn_bits(
    df: DataFrame,
    field: str,
    bits: bytes,
    *,
    pk: str,
    k: int = 10,
    metric: str = "l2",
    filter: str | Column | None = None,
    radius: float | None = None,
    output_fields: Sequence[str] = (),
    include_vector: bool = False,
    include_doc_id: bool = False,
) -> DataFrame:
    """The same search over a packed bit-vector field (a binary column)."""
    metrics.check_metric(metric)
    if not bits:
        raise InvalidArgument("query vector must be set")
    padded = bytes(bits).ljust(-(-len(bits) // 8) * 8, b"\0")
    query = F.array(
        *[F.lit(int.from_bytes(padded[i : i + 8], "big", signed=True)) for i in range(0, len(padded), 8)]
    ).cast("array<bigint>")
    candidates, fields = _candidates(df, field, pk, k, filter, output_fields, include_vector, include_doc_id)
    same = candidates.where(F.octet_length(field) == len(bits)).withColumn("_words", bit_words(F.col(field)))
    hits = same.withColumn("score", bit_score(metric, F.col("_words"), query)).where("score is not null")
    return _closest(hits, [pk, "score", *fields], pk, k, metric, radius)


def _candidates(df, field, pk, k, filter, output_fields, include_vector, include_doc_id):
    """Filtered rows with the needed columns only, and the fields to return."""
    if isinstance(k, bool) or not isinstance(k, int) or k <= 0:
        raise InvalidArgument("top_k must be a positive integer")
    fields = [c for c in (output_fields or scalar_columns(df)) if c != pk]
    unknown = [c for c in [pk, field, *fields] if c not in df.columns]
    if unknown:
        raise InvalidArgument(f"unknown field '{unknown[0]}'")
    if include_vector and field not in fields:
        fields.append(field)
    if include_doc_id:
        if DOC_ID not in df.columns:
            raise InvalidArgument("the collection carries no document ids")
        fields.append(DOC_ID)
    return where(df, filter).select(*dict.fromkeys([pk, field, *fields])), fields


def _closest(hits: DataFrame, columns: Sequence[str], pk: str, k: int, metric: str, radius: float | None) -> DataFrame:
    if radius is not None:
        hits = hits.where(F.col("score") >= radius if metric == "ip" else F.col("score") <= radius)
    order = metrics.closest_first(metric, F.col("score"))
    return hits.select(*columns).orderBy(order, F.col(pk).asc()).limit(k)


def select_fields(df: DataFrame, category: str) -> DataFrame:
    """Project a collection on its forward, vector, indexed or all fields."""
    return df.select(*schema_of(df).names(category))

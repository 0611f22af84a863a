"""Search over quantized codes, refined with the original vectors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..functions import metrics
from ..functions.predicates import where
from ..functions.quantize import Quantizer
from .search import knn, scored


def quantize_table(df: DataFrame, field: str, quantizer: Quantizer, *, keep: Sequence[str]) -> DataFrame:
    """Narrow table ``(keep…, codes)``: the part of a collection a first pass reads."""
    return df.select(*keep, quantizer.encode(F.col(field)).alias("codes")).where("codes is not null")


def knn_quantized(
    codes: DataFrame,
    quantizer: Quantizer,
    vector: Sequence[float],
    *,
    pk: str,
    k: int = 10,
    metric: str = "l2",
    filter: str | Column | None = None,
) -> DataFrame:
    """Top-k by the decoded codes; the score is an estimate."""
    rows = where(codes, filter).select(pk, quantizer.decode("codes").alias("vector"))
    hits = scored(rows, "vector", vector, metric=metric)
    order = metrics.closest_first(metric, F.col("score"))
    return hits.select(pk, "score").orderBy(order, F.col(pk).asc()).limit(k)


def knn_quantized_refined(
    codes: DataFrame,
    originals: DataFrame,
    quantizer: Quantizer,
    vector: Sequence[float],
    *,
    pk: str,
    field: str,
    k: int = 10,
    scale_factor: float = 1.0,
    metric: str = "l2",
    filter: str | Column | None = None,
    **options,
) -> DataFrame:
    """Top ``k * scale_factor`` by codes, then exact top-k among those."""
    if scale_factor < 1.0:
        raise InvalidArgument("scale_factor must be at least 1")
    wide = math.ceil(k * scale_factor)
    candidates = knn_quantized(codes, quantizer, vector, pk=pk, k=wide, metric=metric, filter=filter)
    # The limit above is the size bound that makes this side safe to broadcast.
    kept = originals.join(F.broadcast(candidates.select(pk)), pk, "left_semi")
    return knn(kept, field, vector, pk=pk, k=k, metric=metric, **options)

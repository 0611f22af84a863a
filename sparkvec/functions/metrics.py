"""Distance and similarity columns.

Two forms of each metric give the same numbers: a Catalyst expression over two
array columns (:func:`score`), and an Arrow UDF that scores a column against one
fixed vector (:func:`score_against`). Both add in index order, in double.

A null vector, a null element, a wrong dimension, a NaN and, for cosine, a zero
vector all give a null score, and null scores never enter a result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import InvalidArgument
from ..types import METRICS
from .arrow import dense_block, scatter


def check_metric(metric: str) -> str:
    if metric not in METRICS:
        raise InvalidArgument(f"unknown metric '{metric}'")
    return metric


def closest_first(metric: str, score: Column) -> Column:
    """Sort key that puts the closest hit first."""
    return score.desc_nulls_last() if metric == "ip" else score.asc_nulls_last()


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _total(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def inner_product(a: Column | str, b: Column | str) -> Column:
    a, b = _col(a), _col(b)
    product = _total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    return F.when(F.size(a) == F.size(b), product)


def squared_l2(a: Column | str, b: Column | str) -> Column:
    a, b = _col(a), _col(b)

    def term(x, y):
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.when(F.size(a) == F.size(b), _total(F.zip_with(a, b, term)))


def squared_norm(a: Column | str) -> Column:
    return _total(F.transform(_col(a), lambda x: x.cast("double") * x.cast("double")))


def norm(a: Column | str) -> Column:
    return F.sqrt(squared_norm(a))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    scale = norm(a) * norm(b)
    return F.lit(1.0) - F.try_divide(inner_product(a, b), scale)


def mips_l2(ip: Column, query_sq_norm: Column, max_norm: Column) -> Column:
    """Distance after appending sqrt(M^2 - |x|^2); orders like inner product."""
    rest = max_norm * max_norm + query_sq_norm - ip * 2.0
    # Not greatest(): it would turn an undefined product into a perfect hit.
    return F.sqrt(F.when(rest < 0, F.lit(0.0)).otherwise(rest))


def defined(score: Column) -> Column:
    return F.when(~F.isnan(score), score)


def score(metric: str, a: Column | str, q: Column | str, max_norm: Column | None = None) -> Column:
    """Catalyst score of two array columns."""
    check_metric(metric)
    if metric == "l2":
        raw = F.sqrt(squared_l2(a, q))
    elif metric == "ip":
        raw = inner_product(a, q)
    elif metric == "cosine":
        raw = cosine_distance(a, q)
    else:
        if max_norm is None:
            raise InvalidArgument("mipsl2 needs the maximum norm of the collection")
        raw = mips_l2(inner_product(a, q), squared_norm(q), max_norm)
    return defined(raw)


def largest_norm(field: str, dimension: int | None = None) -> Column:
    """Aggregate: maximum norm of the finite vectors (of one dimension), 0 if none."""

    @F.arrow_udf("double")
    def norms(column: pa.Array) -> pa.Array:
        rows, block = dense_block(column, dimension)
        with np.errstate(all="ignore"):
            size = np.sqrt(running_sum(np.ascontiguousarray(block.T) ** 2))
        size[~np.isfinite(size)] = np.nan
        return scatter(rows, size, len(column))

    return F.coalesce(F.max(norms(F.col(field))), F.lit(0.0))


def running_sum(columns: np.ndarray) -> np.ndarray:
    """Sum rows of a (dimension, n) array one dimension at a time, in order."""
    total = np.zeros(columns.shape[1])
    for line in columns:
        total += line
    return total


def score_against(metric: str, query: Sequence[float]):
    """Arrow UDF: score of a vector column against one fixed query vector.

    For mipsl2 the UDF returns the inner product; the caller finishes it with
    :func:`mips_l2`, because the maximum norm is only known inside the query.
    """
    check_metric(metric)
    q = np.asarray(query, dtype=np.float64)

    def block_scores(block: np.ndarray) -> np.ndarray:
        x = np.ascontiguousarray(block.T)
        if metric == "l2":
            return np.sqrt(running_sum((x - q[:, None]) ** 2))
        ip = running_sum(x * q[:, None])
        if metric != "cosine":
            return ip
        scale = np.sqrt(running_sum(x * x)) * np.sqrt(running_sum((q * q)[:, None]))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(scale == 0, np.nan, 1.0 - ip / scale)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        rows, block = dense_block(column, len(q))
        with np.errstate(invalid="ignore", over="ignore"):
            return scatter(rows, block_scores(block), len(column))

    # Kept out of rewrites that would evaluate it once per mention.
    return scored.asNondeterministic()


def literal_vector(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])

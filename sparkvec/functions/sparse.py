"""Sparse vectors held as struct<indices: array<bigint>, values: array<float>>."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Messages of the index rules.
NEGATIVE = "sparse indices must be non-negative and sorted in ascending order"
UNSORTED = "sparse indices must be sorted in ascending order"
REPEATED = "sparse indices must not contain duplicate values"
NOT_WHOLE = "sparse indices must be integers"
LENGTHS = "indices and values must have the same length"


def sparse_error(indices: Column | str, values: Column | str) -> Column:
    """First violation of a pair of arrays, or null when it is a sparse vector."""
    idx = F.col(indices) if isinstance(indices, str) else indices
    val = F.col(values) if isinstance(values, str) else values
    later = F.slice(idx, 2, F.greatest(F.size(idx) - 1, F.lit(0)))
    earlier = F.slice(idx, 1, F.greatest(F.size(idx) - 1, F.lit(0)))
    steps = F.zip_with(
        earlier, later, lambda a, b: F.when(a > b, F.lit(UNSORTED)).when(a == b, F.lit(REPEATED))
    )
    # Index types other than integers are judged by value.
    fraction = F.exists(idx, lambda x: x != F.floor(x))
    return (
        F.when(F.size(idx) != F.size(val), F.lit(LENGTHS))
        .when(fraction, F.lit(NOT_WHOLE))
        .when(F.get(idx, F.lit(0)) < 0, F.lit(NEGATIVE))
        .otherwise(F.get(F.filter(steps, lambda m: m.isNotNull()), F.lit(0)))
    )


def nnz(column: Column | str) -> Column:
    """Stored entries; explicit zeros count."""
    column = F.col(column) if isinstance(column, str) else column
    return F.size(column.getField("indices"))


def from_dense(column: Column | str, keep) -> Column:
    """Keep the elements for which ``keep(x)`` holds, by position. No shuffle."""
    column = F.col(column) if isinstance(column, str) else column
    pairs = F.filter(
        F.transform(column, lambda x, i: F.struct(i.cast("bigint").alias("i"), x.alias("v"))),
        lambda p: keep(p["v"]),
    )
    return F.struct(
        F.transform(pairs, lambda p: p["i"]).alias("indices"),
        F.transform(pairs, lambda p: p["v"].cast("float")).alias("values"),
    )


def build_sparse(entries: DataFrame, *, key: str, index: str, value: str) -> DataFrame:
    """Group ``(key, index, value)`` rows to ``(key, vector, error)``.

    Entries are first combined per (key, index), before and after the shuffle, so
    a list is never longer than the number of distinct indices of one vector. A
    key with a repeated or negative index gets an error and no vector.
    """
    cells = entries.groupBy(key, index).agg(
        F.first(value).alias("_v"), F.count(F.lit(1)).alias("_n")
    )
    grouped = cells.groupBy(key).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col(index).alias("i"), F.col("_v").alias("v")))
        ).alias("_p"),
        F.max("_n").alias("_most"),
        F.min(index).alias("_least"),
    )
    error = F.when(F.col("_least") < 0, F.lit(NEGATIVE)).when(F.col("_most") > 1, F.lit(REPEATED))
    vector = F.struct(
        F.transform("_p", lambda p: p["i"].cast("bigint")).alias("indices"),
        F.transform("_p", lambda p: p["v"].cast("float")).alias("values"),
    )
    return grouped.select(key, F.when(error.isNull(), vector).alias("vector"), error.alias("error"))


def explode_sparse(df: DataFrame, column: str, *, keep: list[str]) -> DataFrame:
    """One row ``(keep…, index, value)`` per stored entry."""
    pairs = F.arrays_zip(F.col(f"{column}.indices"), F.col(f"{column}.values"))
    return df.select(*keep, F.inline(pairs).alias("index", "value"))

"""Key lookups as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fetch(df: DataFrame, keys: DataFrame, *, pk: str, position: str = "pos") -> DataFrame:
    """Rows for a list of keys in request order; missing keys are skipped.

    ``keys`` holds ``(position, pk)``. A key asked for twice comes back twice.
    Spark broadcasts the key list only when its measured size allows it.
    """
    return keys.select(position, pk).join(df, pk, "inner").orderBy(position)


def missing_keys(df: DataFrame, keys: DataFrame, *, pk: str) -> DataFrame:
    """Requested keys the collection does not hold."""
    return keys.join(df.select(pk), pk, "left_anti")

"""Scalar indexes as data layout: order and bloom filters inside Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the sample that fixes the buckets of interleaved fields, and bits of a bucket.
SAMPLE, BITS = 10_000, 6


def arranged(df: DataFrame, sort_by: Sequence[str], *, pk: str, files: int | None = None, interleave: bool = False) -> DataFrame:
    """Rows ranged and sorted by the given fields, so file statistics prune.

    The key is the last range column: a value held by very many rows is spread
    over as many partitions as it needs. With ``interleave`` all fields count alike, and
    a filter on any one of them skips files.
    """
    if interleave:
        columns = df.columns
        keyed = df.withColumn("_z", interleaved_key(df, sort_by))
        return arranged(keyed, ["_z", *sort_by], pk=pk, files=files).select(*columns)
    keys = [*sort_by, pk]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def interleaved_key(df: DataFrame, fields: Sequence[str], bits: int = BITS, sample: int = SAMPLE) -> Column:
    """A space-filling key: the bits of the fields' buckets in turn, the highest first.

    Rows near each other in the key are near in every field, so the files of a table in
    that order have narrow ranges of each. A field's buckets are the quantiles of about
    ``sample`` rows, which fixes the order only: no row depends on being in the sample.
    Fields may be of any type that can be ordered; nulls come first. At most 62 bits in all.
    """
    bits = max(1, min(bits, 62 // max(1, len(fields))))
    share = min(1.0, 2.0 * sample / max(1, df.count()))
    rows = df.select(*[F.col(f"`{c}`").alias(c) for c in fields]).where(F.rand(7) < share).limit(2 * sample)
    ends = {}
    for c, values in rows.agg(*(F.array_sort(F.collect_list(f"`{c}`")).alias(c) for c in fields)).first().asDict().items():
        cuts = [values[len(values) * i >> bits] for i in range(1, 1 << bits)] if values else []
        ends[c] = list(dict.fromkeys(cuts))

    def bucket(c: str) -> Column:
        cuts = F.lit(ends[c]).cast(f"array<{df.schema[c].dataType.simpleString()}>")
        return F.coalesce(F.size(F.filter(cuts, lambda x: x <= F.col(f"`{c}`"))), F.lit(0))

    buckets = {c: bucket(c) if ends[c] else F.lit(0) for c in fields}
    key = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for c in fields:
            key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(buckets[c], bit).bitwiseAND(F.lit(1)).cast("long"))
    return key


def write_arranged(
    df: DataFrame,
    path: str,
    *,
    sort_by: Sequence[str],
    pk: str,
    bloom: Sequence[str] = (),
    max_records: int | None = None,
    files: int | None = None,
    interleave: bool = False,
) -> None:
    """Write with range statistics on ``sort_by`` and bloom filters on ``bloom``."""
    writer = arranged(df, sort_by, pk=pk, files=files, interleave=interleave).write.mode("errorifexists")
    for field in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{field}", "true")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)

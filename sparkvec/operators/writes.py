"""Writes as pure functions: (base, batch) -> (new snapshot, result rows).

Every batch row gets one result row ``(pk, op, code, message)``. A lakehouse
``MERGE`` can replace the snapshot half without touching the result half.

``order`` names the columns that give the batch its sequence; without it the row
order of the input is used. Where the outcome hangs on that order (a repeated key
in an insert or a delete) the batch is first written to the shared folder. Base keys are unique, so joins on the key are only
ever skewed on the batch side, and the batch is reduced per key before it meets
the base.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions.predicates import predicate
from ..session import settle
from ..sources.records import PRESENT

_POS = "_pos"
_NO_KEY = "primary key must be set"


@dataclass
class WriteResult:
    snapshot: DataFrame
    results: DataFrame


def sequenced(batch: DataFrame, order: Sequence[str] | None) -> DataFrame:
    """Add the position of every row; a batch that carries one keeps it."""
    if _POS in batch.columns:
        return batch
    # The row number within the input settles rows that share an order value.
    place = F.monotonically_increasing_id()
    return batch.withColumn(_POS, F.struct(*[F.col(c) for c in order or ()], place.alias("_row")))


def _fixed(batch: DataFrame, order: Sequence[str] | None) -> DataFrame:
    """Sequenced batch whose positions are the same however often it is read.

    Row numbers depend on how Spark happened to partition the input, so they are
    written down once; snapshot and result rows then agree on which row was first.
    """
    return batch if _POS in batch.columns else settle(sequenced(batch, order))


def _one_per_key(batch: DataFrame, pk: str, last: bool) -> DataFrame:
    # Spark runs this as a group limit of one row per key before the shuffle, so
    # a key with very many copies costs one row per task.
    order = F.col(_POS).desc() if last else F.col(_POS).asc()
    place = F.row_number().over(Window.partitionBy(pk).orderBy(order))
    return batch.withColumn("_n", place).where(F.col("_n") == 1).drop("_n")


def dedupe_first(batch: DataFrame, *, pk: str, order: Sequence[str] | None = None) -> DataFrame:
    """First row of every key."""
    return _one_per_key(sequenced(batch, order), pk, last=False).drop(_POS)


def dedupe_last(batch: DataFrame, *, pk: str, order: Sequence[str] | None = None) -> DataFrame:
    """Last row of every key."""
    return _one_per_key(sequenced(batch, order), pk, last=True).drop(_POS)


def _key_facts(batch: DataFrame, base: DataFrame, pk: str) -> DataFrame:
    """Per batch key: position of its first row, and whether the base holds it."""
    firsts = batch.where(F.col(pk).isNotNull()).groupBy(pk).agg(F.min(_POS).alias("_first"))
    held = base.select(pk).withColumn("_held", F.lit(True))
    return firsts.join(held, pk, "left").withColumn("_held", F.coalesce("_held", F.lit(False)))


def _classified(batch, base, pk, code: Column, message: Column, op: str) -> DataFrame:
    facts = _key_facts(batch, base, pk)
    keyed = batch.where(F.col(pk).isNotNull()).join(facts, pk, "left")
    keyed = keyed.withColumn("op", F.lit(op)).withColumn("code", code).withColumn("message", message).drop("_first", "_held")
    # Rows without a key meet nothing: however many there are, they are not shuffled to one task.
    keyless = batch.where(F.col(pk).isNull()).withColumn("op", F.lit(op))
    return keyed.unionByName(keyless.withColumn("code", F.lit("invalid_argument")).withColumn("message", F.lit(_NO_KEY)))


def _results(classified: DataFrame, pk: str) -> DataFrame:
    return classified.select(F.col(pk).alias("pk"), "op", "code", "message")


def _is_repeat() -> Column:
    return F.col(_POS) > F.col("_first")


def classify_insert(base: DataFrame, batch: DataFrame, *, pk: str, order=None) -> DataFrame:
    """Batch rows with op, code and message; a key inserts once and only if new."""
    code = F.when(F.col("_held") | _is_repeat(), F.lit("already_exists")).otherwise(F.lit("ok"))
    message = (
        F.when(F.col("_held"), F.lit("document already exists"))
        .when(_is_repeat(), F.lit("document repeated in batch"))
        .otherwise(F.lit(""))
    )
    return _classified(_fixed(batch, order), base, pk, code, message, "insert")


def insert(base: DataFrame, batch: DataFrame, *, pk: str, order=None) -> WriteResult:
    """Add new documents; an existing or repeated key is that document's error."""
    done = classify_insert(base, batch, pk=pk, order=order)
    new = _like(done.where("code = 'ok'"), base)
    return WriteResult(base.unionByName(new), _results(done, pk))


def classify_update(base: DataFrame, batch: DataFrame, *, pk: str, order=None) -> DataFrame:
    code = F.when(F.col("_held"), F.lit("ok")).otherwise(F.lit("not_found"))
    message = F.when(F.col("_held"), F.lit("")).otherwise(F.lit("document not found"))
    return _classified(sequenced(batch, order), base, pk, code, message, "update")


def _patches(batch: DataFrame, pk: str, fields: Sequence[str]) -> DataFrame:
    """One row per key: for each field, a struct of its last provided value."""

    def provided(c: str) -> Column:
        if PRESENT not in batch.columns:
            return F.col(_POS)
        return F.when(F.array_contains(PRESENT, c), F.col(_POS))

    wrapped = [F.max_by(F.struct(F.col(f"`{c}`").alias("v")), provided(c)).alias(c) for c in fields]
    return batch.groupBy(pk).agg(F.lit(True).alias("_hit"), *wrapped)


def patched(base: DataFrame, batch: DataFrame, pk: str) -> DataFrame:
    """Base with the fields of a sequenced batch laid over it."""
    fields = [c for c in base.columns if c in batch.columns and c != pk]
    new = _patches(batch.where(F.col(pk).isNotNull()), pk, fields)
    old = base.alias("b")
    joined = old.join(new.alias("n"), pk, "left")
    columns = []
    for c in base.columns:
        if c in fields:
            value = F.when(F.col(f"n.`{c}`").isNotNull(), F.col(f"n.`{c}`.v")).otherwise(
                F.col(f"b.`{c}`")
            )
            columns.append(value.cast(base.schema[c].dataType).alias(c, metadata=base.schema[c].metadata))
        else:
            columns.append(F.col(f"`{c}`") if c == pk else F.col(f"b.`{c}`"))
    return joined.select(*columns)


def update(base: DataFrame, batch: DataFrame, *, pk: str, order=None) -> WriteResult:
    """Patch existing documents: provided fields overwrite, the others stay."""
    sequence = sequenced(batch, order)
    done = classify_update(base, batch, pk=pk, order=order)
    return WriteResult(patched(base, sequence, pk), _results(done, pk))


def classify_upsert(base: DataFrame, batch: DataFrame, *, pk: str, order=None) -> DataFrame:
    return (
        sequenced(batch, order)
        .withColumn("op", F.lit("upsert"))
        .withColumn("code", F.when(F.col(pk).isNull(), F.lit("invalid_argument")).otherwise(F.lit("ok")))
        .withColumn("message", F.when(F.col(pk).isNull(), F.lit(_NO_KEY)).otherwise(F.lit("")))
    )


def upsert(base: DataFrame, batch: DataFrame, *, pk: str, order=None) -> WriteResult:
    """Insert or overwrite whole documents; the last row of a key wins."""
    done = classify_upsert(base, batch, pk=pk, order=order)
    new = _one_per_key(done.where("code = 'ok'"), pk, last=True)
    kept = base.join(new.select(pk), pk, "left_anti")
    return WriteResult(kept.unionByName(_like(new, base)), _results(done, pk))


def classify_delete(base: DataFrame, keys: DataFrame, *, pk: str, order=None) -> DataFrame:
    gone = F.col("_held") & ~_is_repeat()
    code = F.when(gone, F.lit("ok")).otherwise(F.lit("not_found"))
    message = F.when(gone, F.lit("")).otherwise(F.lit("document not found"))
    return _classified(_fixed(keys, order), base, pk, code, message, "delete")


def delete(base: DataFrame, keys: DataFrame, *, pk: str, order=None) -> WriteResult:
    """Remove documents by key; a missing key is reported as not found."""
    done = classify_delete(base, keys, pk=pk, order=order)
    return WriteResult(base.join(keys.select(pk), pk, "left_anti"), _results(done, pk))


def delete_by_filter(base: DataFrame, condition: str | Column) -> DataFrame:
    """Remove every document the filter holds for; unknown keeps the document."""
    hit = predicate(base, condition)
    if hit is None:
        raise InvalidArgument("filter must be set")
    return base.where(~F.coalesce(hit, F.lit(False)))


def merge_records(first: DataFrame, second: DataFrame, *, pk: str) -> DataFrame:
    """Field-wise merge of two record sets, one row per key on each side.

    A field the second record carries wins, an explicit null included; the
    ``_present`` arrays say which fields a record carries (all, if there is none).
    A column has one type, so fields whose types clash come out as text.
    """
    fields = list(dict.fromkeys([c for c in first.columns + second.columns if c not in (pk, PRESENT)]))

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        names = [c for c in df.columns if c not in (pk, PRESENT)]
        every = F.array(*[F.lit(c) for c in names]).cast("array<string>")
        carried = F.col(PRESENT) if PRESENT in df.columns else every
        return df.select(
            pk, carried.alias(f"_{tag}"), *[F.col(f"`{c}`").alias(f"_{tag}_{c}") for c in names]
        )

    both = tagged(first, "a").join(tagged(second, "b"), pk, "full_outer")
    columns = []
    for c in fields:
        has_b = F.coalesce(F.array_contains("_b", c), F.lit(False))
        has_a = F.coalesce(F.array_contains("_a", c), F.lit(False))
        value = None
        clash = _clash(first, second, c)
        if c in second.columns:
            new = F.col(f"_b_{c}")
            value = F.when(has_b, new.cast("string") if clash else new)
        if c in first.columns:
            old = F.col(f"_a_{c}").cast("string") if clash else F.col(f"_a_{c}")
            value = F.when(has_a, old) if value is None else value.when(has_a, old)
        columns.append(value.alias(c))
    present = F.array_distinct(
        F.concat(
            F.coalesce("_a", F.array().cast("array<string>")),
            F.coalesce("_b", F.array().cast("array<string>")),
        )
    )
    return both.select(pk, *columns, F.sort_array(present).alias(PRESENT))


def _clash(first: DataFrame, second: DataFrame, name: str) -> bool:
    """Whether the two sides give a field types only text can hold together."""
    if name not in first.columns or name not in second.columns:
        return False
    kinds = [df.schema[name].dataType for df in (first, second)]
    return kinds[0] != kinds[1] and not all(isinstance(k, T.NumericType) for k in kinds)


def write_summary(results: DataFrame) -> DataFrame:
    """One row: how many documents succeeded and how many did not."""
    ok = F.col("code") == "ok"
    return results.agg(F.count_if(ok).alias("success"), F.count_if(~ok).alias("errors"))


def _like(rows: DataFrame, base: DataFrame) -> DataFrame:
    """Rows in the column layout of the base; columns not provided are null."""
    out = []
    for field in base.schema.fields:
        source = F.col(f"`{field.name}`") if field.name in rows.columns else F.lit(None)
        out.append(source.cast(field.dataType).alias(field.name, metadata=field.metadata))
    return rows.select(*out)


def key_group(pk: str, digits: int) -> Column:
    """Hash group of a key: the first hex digits of its MD5."""
    return F.substring(F.md5(F.col(pk).cast("string").cast("binary")), 1, digits)


def assign_doc_ids(df: DataFrame, *, pk: str, start: int = 0, digits: int = 3, name: str = "_doc_id") -> DataFrame:
    """Dense document ids in order of the key's hash group, then of the key.

    The keys alone are sorted by ranges and numbered within their partition; the sizes of
    the partitions before it shift a partition's numbers. No group of rows has to fit a
    task, and whole rows move once, to their number. Keys are unique, as in a collection;
    rows without a key are left out.
    """
    keys = df.where(F.col(pk).isNotNull()).select(pk, key_group(pk, digits).alias("_g"))
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    # Written once: numbers must not change when a partition is computed again.
    placed = settle(keys.repartitionByRange("_g", pk).sortWithinPartitions("_g", pk).select(pk, part.alias("_p"), place.alias("_n")))
    sizes = sorted((r["_p"], r["n"]) for r in placed.groupBy("_p").agg(F.count("*").alias("n")).collect())  # one row per partition
    shifts, at = [], start
    for number, n in sizes:
        shifts.append((number, at))
        at += n
    table = df.sparkSession.createDataFrame(shifts, "_p int, _shift long")
    numbered = placed.join(F.broadcast(table), "_p").select(pk, (F.col("_shift") + F.col("_n")).alias(name))
    return df.join(numbered, pk).select(*df.columns, name)

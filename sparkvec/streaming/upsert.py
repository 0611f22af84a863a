"""Streaming upserts into a collection, safe to replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.writes import dedupe_last
from ..sources.collection import Collection


def latest_per_key(df: DataFrame, *, pk: str, order: Sequence[str]) -> DataFrame:
    """Newest row of every key by the ``order`` columns."""
    return dedupe_last(df, pk=pk, order=order)


def apply_batch(
    collection: Collection, batch: DataFrame, batch_id: int, *, name: str, order: Sequence[str]
) -> bool:
    """Upsert one micro-batch unless the collection already holds it.

    ``name`` names one run of numbered batches: a stream with a new checkpoint counts
    from 0 again and needs a name of its own, as :func:`streaming_upsert` gives it.
    The batch number is part of the same commit as the rows, so a batch replayed
    after a failure is either wholly there (and skipped) or not there at all.
    """
    snap = collection.snapshot()
    if snap.applied.get(name, -1) >= batch_id:
        return False
    newest = all(c in snap.schema for c in order)
    collection.upsert(batch, order=order, newest=newest, applied={name: batch_id})
    return True


def streaming_upsert(
    stream: DataFrame,
    collection: Collection,
    *,
    name: str,
    order: Sequence[str],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the stream: the last row of a key by ``order`` wins.

    That holds across batches too, late ones included, when the collection stores
    the ``order`` fields; otherwise batches count in the order they arrive.
    """

    run: list[str] = []

    def sink(batch: DataFrame, batch_id: int) -> None:
        if not run:
            # The id lives as long as the checkpoint, and batch numbers with it.
            facts = collection.spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata")
            run.append(facts.first()["id"])
        apply_batch(collection, batch, batch_id, name=f"{name}@{run[0]}", order=order)

    return (
        stream.writeStream.queryName(name)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )

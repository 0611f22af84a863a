"""Distributed scoring of queries against the cells they chose, in tiles of bounded size.

Small cells share a block of members, a cell too large for one task is cut into several
by hash, and so are the queries: no task ever holds more than one block of each, however
many rows one cell has. A query is copied once for each block that holds a cell of its
choice, with the choice as bits, not once for each cell. A tile returns k hits per query,
never its pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import metrics
from ..functions.arrow import dense_block
from ..functions.topk import Hits, Scorer, best_once

BLOCK_BYTES = 64 << 20
SPREAD_QUERIES = 256
#: Rows of a block that are not cut for the sake of more tasks, and tiles for each core.
LEAST_ROWS, TILES = 4096, 8


def block_rows(dimension: int, block_bytes: int = BLOCK_BYTES) -> int:
    return max(1, block_bytes // (8 * max(1, dimension)))


def hit_schema(qid_type: T.DataType, pk_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("qid", qid_type),
            T.StructField("pk", pk_type),
            T.StructField("score", T.DoubleType()),
        ]
    )


def keys_of(column) -> np.ndarray:
    """Key column as an array numpy can order (objects for strings)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def hits_table(hits: Hits, qids: pa.Array, schema: pa.Schema) -> pa.Table:
    """Hits whose ``query`` is a position in ``qids`` as an Arrow table."""
    if not len(hits):
        return schema.empty_table()
    return pa.Table.from_arrays(
        [
            qids.take(pa.array(hits.query)).cast(schema.field("qid").type),
            _key_column(hits.key, schema.field("pk").type),
            pa.array(hits.score),
        ],
        schema=schema,
    )


def _key_column(keys: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(keys).cast(kind) if keys.dtype.kind in "iu" else pa.array(list(keys), type=kind)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def rank_hits(hits: DataFrame, k: int, metric: str, repeats: bool = False) -> DataFrame:
    """Best k hits per query as ``(qid, rank, pk, score)``.

    Spark turns ``rank <= k`` into a group limit before and after the shuffle.
    With ``repeats`` the same member may arrive from two cells.
    """
    order = Window.partitionBy("qid").orderBy(
        metrics.closest_first(metric, F.col("score")), F.col("pk").asc()
    )
    if repeats:
        # A repeated member has the same score and key, hence the same place.
        ranked = hits.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
        ranked = ranked.dropDuplicates(["qid", "pk"])
    else:
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("qid", "rank", "pk", "score")


class Blocks:
    """Blocks of members: each holds a run of cells, or a part of one that is larger than a block."""

    def __init__(self, count: np.ndarray, rows: int):
        self.first, self.parts = np.zeros(len(count), np.int64), np.zeros(len(count), np.int64)
        self.low, self.high, held = [], [], 0
        for cell in np.flatnonzero(count).tolist():
            n = int(count[cell])
            if held and held + n <= rows:
                self.high[-1], held = cell + 1, held + n
            else:
                parts = -(-n // rows)
                self.low += [cell] * parts
                self.high += [cell + 1] * parts
                held = n if parts == 1 else 0
            self.parts[cell] = 1 if held else -(-n // rows)
            self.first[cell] = len(self.low) - self.parts[cell]

    def __len__(self) -> int:
        return len(self.low)

    def table(self, spark: SparkSession) -> DataFrame:
        cells = [(c, int(self.first[c]), int(self.parts[c])) for c in np.flatnonzero(self.parts).tolist()]
        return spark.createDataFrame(cells, "cell int, first int, parts int")


def tile_topk(
    members: DataFrame,
    queries: DataFrame,
    n_queries: int,
    count: np.ndarray,
    choose,
    *,
    k: int,
    metric: str,
    dimension: int,
    max_norm: float | None = None,
    block_bytes: int = BLOCK_BYTES,
    read=dense_block,
    repeats: bool = False,
) -> DataFrame:
    """Hits ``(qid, pk, score)``: up to k per query and tile.

    ``members`` is ``(pk, vector, cell)`` with one row per key and cell, and ``count`` the
    number of rows of each cell. ``queries`` is ``(qid, vector, ...)`` with ``n_queries``
    rows of distinct ids; ``choose(block, batch)`` gives the mask of the cells that each
    query of a batch meets. A column ``bound`` of the queries is a score that their k-th
    hit is known to reach. ``read(column, dimension)`` gives the positions and the block of
    the members' vectors, which may be codes. With ``repeats`` a member may be in two cells.
    """
    most, tiles = block_rows(dimension, block_bytes), TILES * members.sparkSession.sparkContext.defaultParallelism
    side = math.ceil(math.sqrt(tiles))

    def rows(n: int) -> int:
        return max(1, min(most, max(LEAST_ROWS, -(-n // side))))

    blocks, of_queries = Blocks(count, rows(int(count.sum()))), -(-n_queries // rows(n_queries))
    schema = hit_schema(queries.schema["qid"].dataType, members.schema["pk"].dataType)
    out = arrow_schema(schema)
    if not len(blocks) or not of_queries:
        return members.sparkSession.createDataFrame([], schema)
    bounded = "bound" in queries.columns
    sent = [queries.schema[c] for c in ("qid", "vector", *(["bound"] if bounded else []))]
    spec = T.StructType([*sent, T.StructField("cells", T.BinaryType()), T.StructField("mb", T.IntegerType())])
    low, high = blocks.low, blocks.high

    def send(batches):
        for batch in batches:
            at, block = dense_block(batch["vector"], dimension)
            kept = batch.take(pa.array(at))
            mask = choose(block, kept)
            kept = kept.select([f.name for f in sent])
            for mb in range(len(low)):
                part = mask[:, low[mb] : high[mb]]
                asked = np.flatnonzero(part.any(axis=1))
                # Bounded output batches: a query may visit many blocks.
                if len(asked):
                    bits = np.packbits(part[asked], axis=1)
                    width = bits.shape[1]
                    packed = pa.array([bits.data.tobytes()[i : i + width] for i in range(0, bits.size, width)], pa.binary())
                    numbers = pa.array(np.full(len(asked), mb, np.int32))
                    yield pa.RecordBatch.from_arrays([*kept.take(pa.array(asked)).columns, packed, numbers], schema=arrow_schema(spec))

    def dealt(key: str, n: int):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    right = queries.mapInArrow(send, spec).withColumn("qb", dealt("qid", of_queries))
    placed = members.join(F.broadcast(blocks.table(members.sparkSession)), "cell")
    left = placed.select(
        "cell", "pk", "vector",
        (F.col("first") + F.pmod(F.xxhash64("pk"), F.col("parts"))).cast("int").alias("mb"),
        F.explode(F.sequence(F.lit(0), F.lit(of_queries - 1))).alias("qb"),
    )

    def tile(m: pa.Table, q: pa.Table) -> pa.Table:
        if not m.num_rows or not q.num_rows:
            return out.empty_table()
        mb = m["mb"][0].as_py()
        qrows, asked = dense_block(q["vector"], dimension)
        mrows, block = read(m["vector"], dimension)
        qids = q["qid"].combine_chunks().take(pa.array(qrows))
        bits = np.frombuffer(b"".join(q["cells"].to_pylist()), np.uint8).reshape(q.num_rows, -1)[qrows]
        mask = np.unpackbits(bits, axis=1, count=high[mb] - low[mb]).astype(bool)
        cells = m["cell"].to_numpy()[mrows].astype(np.int64) - low[mb]
        bound = q["bound"].to_numpy(zero_copy_only=False).astype(np.float64)[qrows] if bounded else None
        hits = Scorer(metric, asked, 2 * k if repeats else k, max_norm, bound).top(block, keys_of(m["pk"])[mrows], cells=cells, mask=mask)
        hits = best_once(hits, k, metric == "ip") if repeats else hits
        return hits_table(hits, qids, out)

    key = ["mb", "qb"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(tile, schema)


def scan_topk(
    members: DataFrame,
    qids: pa.Array,
    queries: np.ndarray,
    *,
    k: int,
    metric: str,
    max_norm: float | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Hits of a bounded block of queries over one pass of ``members``.

    Every task keeps a running best k per query over all its batches, so the
    shuffle carries k rows per query and task. ``tasks`` merges small scan splits
    (without a shuffle) to keep that number down.
    """
    dimension = queries.shape[1]
    schema = hit_schema(_spark_type(qids.type), members.schema["pk"].dataType)
    out = arrow_schema(schema)

    def scan(batches):
        scorer, hits = Scorer(metric, queries, k, max_norm), Hits.empty()
        for batch in batches:
            rows, block = dense_block(batch["vector"], dimension)
            hits = scorer.top(block, keys_of(batch["pk"])[rows], hits)
        yield from hits_table(hits, qids, out).to_batches()

    scanned = members.select("pk", "vector")
    if tasks:
        # Many queries over few input files: scoring outweighs moving the vectors.
        spread = len(queries) >= SPREAD_QUERIES and len(members.inputFiles()) < tasks // 4
        scanned = scanned.repartition(tasks // 4) if spread else scanned.coalesce(tasks)
    return scanned.mapInArrow(scan, schema)


def probe_scan(
    members: DataFrame,
    qids: pa.Array,
    queries: np.ndarray,
    mask: np.ndarray,
    *,
    k: int,
    metric: str,
    max_norm: float | None = None,
    read=dense_block,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Hits of a bounded block of queries, each in its own cells; no member is shuffled.

    ``mask`` says which queries (rows) probe which cells; only probed cells are scanned.
    ``members`` is ``(pk, vector, cell)``. A task gathers members by cell up to the block
    bound, scores them against the queries of their cells and keeps the best k per query.
    ``read(column, dimension)`` gives the positions and the block of a column of vectors.
    """
    dimension, most = queries.shape[1], block_rows(queries.shape[1], block_bytes)
    probed = np.flatnonzero(mask.any(axis=0)).tolist()
    schema = hit_schema(_spark_type(qids.type), members.schema["pk"].dataType)
    out = arrow_schema(schema)

    def scan(batches):
        scorer, held, gathered, n = Scorer(metric, queries, k, max_norm), Hits.empty(), [], 0

        def scored() -> Hits:
            if not gathered:
                return held
            block, keys, cells = (np.concatenate(x) for x in zip(*gathered, strict=True))
            return scorer.top(block, keys, held, cells=cells, mask=mask)

        for batch in batches:
            rows, block = read(batch["vector"], dimension)
            gathered.append((block, keys_of(batch["pk"])[rows], batch["cell"].to_numpy(zero_copy_only=False)[rows].astype(np.int64)))
            n += len(rows)
            if n >= most:
                held, gathered, n = scored(), [], 0
        yield from hits_table(scored(), qids, out).to_batches()

    inside = members.where(F.col("cell").isin(probed)) if probed else members.limit(0)
    return inside.select("pk", "vector", "cell").mapInArrow(scan, schema)


def _spark_type(kind: pa.DataType) -> T.DataType:
    from pyspark.sql.pandas.types import from_arrow_type

    return from_arrow_type(kind)

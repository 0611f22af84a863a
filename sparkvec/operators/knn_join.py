"""k nearest neighbours for a whole table of queries, exactly.

Two plans, chosen by the measured size of the query side:

* ``scan`` - the queries fit the broadcast bound: one pass over the collection,
  a running best k per task, one small merge. Asked for beyond the bound, blocks of
  queries meet blocks of members, each pair once.
* ``pivot`` - any number of queries: members are assigned to pivots, a first
  round over the nearest cells gives every query an upper bound on its k-th
  distance, and a second round visits only the cells the triangle inequality and
  the bisector bound cannot rule out (Lu et al. 2012). The result is the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions import metrics, spaces
from ..functions.arrow import dense_block
from ..functions.predicates import where
from ..schema import field_of
from ..session import settle
from .tiles import BLOCK_BYTES, arrow_schema, block_rows, rank_hits, scan_topk, tile_topk

PIVOTS = 256
FIRST_FETCH = 2048
_ROUNDING = 1e-6


def vector_dimension(df: DataFrame, field: str) -> int:
    """Declared dimension, else the size that most vectors have (the smaller of two)."""
    declared = field_of(df.schema[field]).dimension
    if declared:
        return declared
    sizes = df.where(F.col(field).isNotNull()).groupBy(F.size(field).alias("n")).agg(F.count("*").alias("rows"))
    row = sizes.orderBy(F.desc("rows"), "n").first()
    return row["n"] if row else 0


def largest_norm(df: DataFrame, field: str, dimension: int) -> float:
    """Maximum vector norm: one double, found by a map-side combined aggregate."""
    return df.select(metrics.largest_norm(field, dimension).alias("m")).first()["m"]


def bounded_block(queries: DataFrame, dimension: int, block_bytes: int = BLOCK_BYTES):
    """``(qids, vectors)`` on the driver, or None when over the size bound.

    A first fetch of at most ``FIRST_FETCH`` rows settles small query sides in
    one job; ``limit(bound + 1)`` keeps the second one bounded as well.
    """

    def take(n: int) -> pa.Table:
        return queries.select("qid", "vector").limit(n).toArrow()

    table = take(FIRST_FETCH + 1)
    bound = block_rows(dimension, block_bytes)
    if table.num_rows > FIRST_FETCH and bound > FIRST_FETCH:
        table = take(bound + 1)
    if table.num_rows > bound:
        return None
    table = table.filter(table["qid"].is_valid())
    rows, block = dense_block(table["vector"], dimension)
    return _one_per_id(table["qid"].combine_chunks().take(pa.array(rows)), block)


REPEATED = "a query id is repeated with different vectors"


def _one_per_id(qids: pa.Array, block: np.ndarray):
    """A query id may be repeated with the same vector only, as in ``fold_queries``."""
    _, first, group = np.unique(qids.to_numpy(zero_copy_only=False), return_index=True, return_inverse=True)
    if len(first) < len(block):
        same = (block == block[first[group]]) | (np.isnan(block) & np.isnan(block[first[group]]))
        if not same.all():
            raise InvalidArgument(REPEATED)
        keep = np.sort(first)
        qids, block = qids.take(pa.array(keep)), block[keep]
    return qids, block


def fold_queries(queries: DataFrame, dimension: int) -> DataFrame:
    """One row per id among the well-formed vectors; two different ones are an error."""
    sound = (F.size("vector") == dimension) & ~F.exists("vector", lambda x: x.isNull())
    folded = queries.where(F.col("qid").isNotNull() & sound).groupBy("qid").agg(F.min("vector").alias("low"), F.max("vector").alias("high"))
    one = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.raise_error(F.lit(REPEATED)))
    return folded.select("qid", one.alias("vector"))


def knn_join(
    queries: DataFrame,
    df: DataFrame,
    *,
    qid: str,
    pk: str,
    field: str,
    query_field: str | None = None,
    k: int = 10,
    metric: str = "l2",
    filter: str | Column | None = None,
    strategy: str = "auto",
    max_norm: float | None = None,
    pivots: int = PIVOTS,
    block_bytes: int | None = None,
) -> DataFrame:
    """Rows ``(qid, rank, pk, score)``: the k nearest of ``df`` for each query.

    ``max_norm`` fixes the norm mipsl2 refers to when ``df`` is part of a whole. The bound
    counts distinct well-formed queries; a ``block_bytes`` of the caller's is one that a
    scan must not pass.
    """
    metrics.check_metric(metric)
    if k <= 0:
        raise InvalidArgument("top_k must be a positive integer")
    asked = queries.select(F.col(qid).alias("qid"), F.col(query_field or field).alias("vector"))
    members = where(df, filter).select(F.col(pk).alias("pk"), F.col(field).alias("vector"))
    dimension = vector_dimension(df, field)
    if strategy not in ("auto", "scan", "pivot"):
        raise InvalidArgument(f"unknown strategy '{strategy}'")
    bound = BLOCK_BYTES if block_bytes is None else block_bytes

    block = None if strategy == "pivot" else bounded_block(asked, dimension, bound)
    if block is None:
        asked = settle(fold_queries(asked, dimension))
        # Repeated and malformed rows may have been what was too much.
        block = None if strategy == "pivot" else bounded_block(asked, dimension, bound)
    if block is not None or strategy == "scan":
        top = max_norm
        if metric == "mipsl2" and top is None:
            top = largest_norm(df, field, dimension)
        if block is not None:
            tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
            hits = scan_topk(members, *block, k=k, metric=metric, max_norm=top, tasks=tasks)
        elif block_bytes is not None:
            raise InvalidArgument("the query side is over the broadcast bound")
        else:
            hits = _all_pairs(asked, members, k=k, metric=metric, dimension=dimension, max_norm=top)
        return rank_hits(hits, k, metric)
    top = largest_norm(df, field, dimension) if metric in ("ip", "mipsl2") else None
    if metric != "mipsl2" or max_norm is None:
        return _pivot_join(asked, members, k, metric, dimension, top, pivots, bound)
    # Same order as ip; the score refers to the norm that was asked for.
    ranked = _pivot_join(asked, members, k, "ip", dimension, top, pivots, bound)
    return as_mips(ranked, asked, max_norm)


def _all_pairs(queries, members, **tiles) -> DataFrame:
    """Hits of each block of queries with each block of members."""

    def choose(block, _):
        return np.ones((len(block), 1), bool)

    one = members.withColumn("cell", F.lit(0))
    return tile_topk(one, queries, queries.count(), np.array([members.count()]), choose, **tiles)


def as_mips(ranked: DataFrame, asked: DataFrame, max_norm: float) -> DataFrame:
    """Hits ranked by inner product with their mipsl2 score for one norm."""
    sizes = asked.select("qid", metrics.squared_norm("vector").alias("q_sq"))
    score = metrics.mips_l2(F.col("score"), F.col("q_sq"), F.lit(max_norm))
    return ranked.join(sizes, "qid").select("qid", "rank", "pk", score.alias("score"))


# -- exact join by pivots ---------------------------------------------------


def _pivot_join(queries, members, k, metric, dimension, top, pivots, block_bytes) -> DataFrame:
    """``queries`` are folded and settled."""
    points = pivot_points(members, metric, dimension, top, pivots)
    # Used by both rounds and by the cell statistics: written once.
    assigned = settle(assign_cells(members, points, metric, dimension, top))
    stats, n = CellStats.measure(assigned, points), queries.count()
    tiles = dict(k=k, metric=metric, dimension=dimension, max_norm=top, block_bytes=block_bytes)

    def nearest(block, _):
        return stats.first_cells(spaces.lift_queries(metric, block), k)

    def others(block, batch):
        lifted = spaces.lift_queries(metric, block)
        reach = batch["reach"].to_numpy(zero_copy_only=False).astype(np.float64)
        reach = np.where(np.isnan(reach), np.inf, reach)
        return stats.reachable(lifted, reach) & ~stats.first_cells(lifted, k)

    cells = assigned.select("pk", "vector", "cell")
    first = settle(tile_topk(cells, queries, n, stats.count, nearest, **tiles))
    bound = (
        rank_hits(first, k, metric)
        .join(queries.select("qid", metrics.squared_norm("vector").alias("q_sq")), "qid")
        .withColumn("d", spaces.lifted_distance(metric, F.col("score"), F.col("q_sq"), top))
        .groupBy("qid")
        .agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d"), (F.min if metric == "ip" else F.max)("score").alias("worst"))
    )
    full = F.col("n") >= k
    bounded = queries.join(bound, "qid", "left").select(
        "qid", "vector", F.when(full, F.col("d")).alias("reach"), F.when(full, F.col("worst")).alias("bound")
    )
    rest = tile_topk(cells, bounded, n, stats.count, others, **tiles)
    return rank_hits(first.unionByName(rest), k, metric)


def pivot_points(members, metric, dimension, top, pivots) -> np.ndarray:
    """A bounded set of lifted member vectors, picked by key hash."""
    picked = (
        members.where(F.size("vector") == dimension)
        .orderBy(F.xxhash64("pk"), "pk")
        .limit(pivots)
        .select("vector")
        .toArrow()
    )
    _, block = dense_block(picked["vector"], dimension)
    lifted = spaces.lift_members(metric, block, top)
    return np.unique(lifted[np.isfinite(lifted).all(axis=1)], axis=0)


def assign_cells(members, points, metric, dimension, top) -> DataFrame:
    """Add the nearest point's number and its distance.

    Rows that cannot be placed (overflowing values) go to one extra cell that
    every query visits; rows without a usable vector are left out.
    """
    schema = T.StructType(
        [
            *members.select("pk", "vector").schema.fields,
            T.StructField("cell", T.IntegerType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    out = arrow_schema(schema)

    def assign(batches):
        nearest = spaces.Nearest(points)
        for batch in batches:
            rows, block = dense_block(batch["vector"], dimension)
            lifted = spaces.lift_members(metric, block, top)
            placed = ~np.isnan(lifted).any(axis=1)
            rows, lifted = rows[placed], lifted[placed]
            cell, dist = nearest.find(lifted)
            kept = batch.select(["pk", "vector"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(cell), pa.array(dist)], schema=out
            )

    return members.select("pk", "vector").mapInArrow(assign, schema)


class CellStats:
    """Bounded summary of the cells: points, row counts and radii."""

    def __init__(self, points: np.ndarray, count: np.ndarray, radius: np.ndarray):
        self.points, self.count, self.radius = points, count, radius
        self.between = spaces.distances(points, points) if len(points) else np.zeros((0, 0))
        self.scale = float(np.sqrt((points**2).sum(axis=1)).max(initial=1.0)) + float(
            radius[np.isfinite(radius)].max(initial=0.0)
        )

    @classmethod
    def measure(cls, assigned: DataFrame, points: np.ndarray) -> "CellStats":
        count, radius = np.zeros(len(points) + 1, np.int64), np.zeros(len(points) + 1)
        rows = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("r"))
        for row in rows.collect():  # one row per pivot
            count[row["cell"]], radius[row["cell"]] = row["n"], row["r"]
        return cls(points, count, radius)

    def first_cells(self, lifted: np.ndarray, k: int) -> np.ndarray:
        """Mask: nearest cells, in order, until they hold k members."""
        gap = np.column_stack([spaces.distances(lifted, self.points), np.zeros(len(lifted))])
        gap = np.where(np.isfinite(gap), gap, np.inf)
        gap[:, self.count == 0] = np.inf
        order = np.argsort(gap, axis=1, kind="stable")
        filled = np.cumsum(self.count[order], axis=1)
        before = np.column_stack([np.zeros(len(lifted), np.int64), filled[:, :-1]])
        mask = np.zeros(gap.shape, dtype=bool)
        np.put_along_axis(mask, order, before < k, axis=1)
        mask[:, self.count == 0] = False
        return mask

    def reachable(self, lifted: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Mask of the cells that may hold a member within ``reach``."""
        with np.errstate(all="ignore"):
            gap = spaces.distances(lifted, self.points)
            ball = gap - self.radius[None, :-1]
            home = gap.argmin(axis=1) if gap.shape[1] else np.zeros(len(gap), np.int64)
            home_gap = gap[np.arange(len(gap)), home][:, None] if gap.shape[1] else gap
            bisector = (gap**2 - home_gap**2) / (2.0 * self.between[home]) if gap.shape[1] else gap
            bisector = np.where(np.isfinite(bisector), bisector, -np.inf)
            least = np.maximum(ball, bisector)
            size = self.scale + np.sqrt(np.einsum("ij,ij->i", lifted, lifted))
            open_ = ~(least > (reach + _ROUNDING * size)[:, None])
        mask = np.column_stack([open_, np.ones(len(lifted), dtype=bool)])
        mask[:, self.count == 0] = False
        return mask

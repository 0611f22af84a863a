"""Nearest neighbours by counting collisions of single projections.

Each vector has its values on ``PROJECTIONS`` random lines. Inside a block the values of
each line are sorted once; a query opens a window around its own value on every line and
counts how often a vector falls inside. Virtual rehashing: the windows grow with a
radius, and only the newly opened parts are counted. A vector at the radius or nearer
falls into a window with a known chance, so one that reaches the count which nearly all
such vectors reach is verified by its true distance. A query is done when its k-th best
verified distance is within the radius: every nearer vector has been verified, but for
the chance of the count. The radius grows until the windows hold everything, so small
blocks and far queries end exactly.

The stated queries meet all rows in blocks: rows are dealt to row blocks and queries to
query blocks of bounded size, and each pair of blocks is a task of its own. What moves
is each row once per query block and each query once per row block; a pair of blocks
gives k rows per query. Blocks are dealt by a hash of the row, not of its id or value.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .text import mix
from .vectors import matrix, selected, usable

PROJECTIONS = 48
#: Half width of a window per unit of radius; a vector at the radius is inside with erf(WIDTH / sqrt 2).
WIDTH = 1.0
#: How many standard deviations below its mean the count of a vector at the radius may stay.
SLACK = 2.5
GROWTH = 1.3
ROWS, QUERIES = 2048, 2048


def lines(dim: int, projections: int = PROJECTIONS) -> np.ndarray:
    """Fixed Gaussian directions, one per row."""
    seed = mix(np.arange(2 * projections * dim, dtype=np.uint64) + np.uint64(1 << 40))
    u = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    return (np.sqrt(-2 * np.log(u[: projections * dim])) * np.cos(2 * np.pi * u[projections * dim :])).reshape(projections, dim)


def threshold(projections: int = PROJECTIONS) -> int:
    p = math.erf(WIDTH / math.sqrt(2))
    return max(1, math.floor(projections * p - SLACK * math.sqrt(projections * p * (1 - p))))


class Block:
    """Sorted projections of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS):
        self.ids, self.vectors = ids, vectors
        self.lines = lines(vectors.shape[1], projections)
        values = vectors @ self.lines.T
        self.order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T)
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)
        self.least = threshold(projections)

    def _distances(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(np.square(self.vectors[rows] - query).sum(axis=1))

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the best found, nearest first, then smaller id."""
        n = len(self.ids)
        allowed = self.ids != query_id
        values = self.lines @ query
        few = np.flatnonzero(allowed[: max(64, 2 * k)])
        guess = np.sort(self._distances(query, few))[:k]
        radius = max(float(guess[-1]) / GROWTH if len(guess) else 1.0, 1e-12)
        counts, seen = np.zeros(n, np.int64), np.zeros(n, bool)
        seen[~allowed] = True
        middle = np.array([np.searchsorted(s, v) for s, v in zip(self.sorted, values, strict=True)])
        lo, hi = middle.copy(), middle.copy()
        rows, far = np.zeros(0, np.int64), np.zeros(0)
        while True:
            half = WIDTH * radius
            new = []
            for line, (s, v) in enumerate(zip(self.sorted, values, strict=True)):
                a, b = np.searchsorted(s, v - half), np.searchsorted(s, v + half, side="right")
                new += (self.order[line, a : lo[line]], self.order[line, hi[line] : b])
                lo[line], hi[line] = min(a, lo[line]), max(b, hi[line])
            counts += np.bincount(np.concatenate(new), minlength=n)
            fresh = np.flatnonzero((counts >= self.least) & ~seen)
            if len(fresh):
                seen[fresh] = True
                rows, far = np.append(rows, fresh), np.append(far, self._distances(query, fresh))
                best = np.lexsort((self.ids[rows], far))[:k]
                rows, far = rows[best], far[best]
            if seen.all() or (len(rows) >= k and far[-1] <= radius):
                return self.ids[rows], far
            radius *= GROWTH


def _searcher(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if rows.num_rows and queries.num_rows:
            block = Block(rows["id"].to_numpy(), matrix(rows["vector"]))
            for query_id, query in zip(queries["id"].to_pylist(), matrix(queries["vector"]), strict=True):
                ids, far = block.nearest(query_id, query, k)
                out[0] += [query_id] * len(ids)
                out[1] += ids.tolist()
                out[2] += far.tolist()
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("query_id", "vec_id", "score"), out, kinds, strict=True)})

    return run


def _dealt(df: DataFrame, blocks: int, name: str) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))


def search(
    df: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row that ``queries`` selects.

    ``queries`` is a condition on ``id``. Candidates are all rows but those with the
    query's own id; score is the Euclidean distance in double precision, rank counts
    from 1, ties go to the smaller id. Vectors that are null, zero or hold a null or
    non-finite component, and rows without an id, take no part; vectors of different
    length do not meet. Rows that repeat an id are candidates of their own; a repeated
    query is answered once, from its smallest vector. Other columns are not looked at.
    """
    vectors = selected(df, id_col, vector_col).where(usable("vector") & F.col("id").isNotNull()).withColumn("dim", F.size("vector"))
    vectors = settle(vectors)
    asked = settle(vectors.where(queries).groupBy("id").agg(F.min(F.struct("vector", "dim")).alias("v")).select("id", "v.vector", "v.dim"))
    row_blocks, query_blocks = (max(1, -(-t.count() // n)) for t, n in ((vectors, ROWS), (asked, QUERIES)))
    key = ["dim", "rows", "asks"]
    left = _dealt(vectors, row_blocks, "rows").withColumn("asks", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = _dealt(asked, query_blocks, "asks").withColumn("rows", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    found = left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(_searcher(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)

"""Lift every metric to plain L2 so that one routing rule serves all four.

cosine: unit vectors. ip and mipsl2: append sqrt(M^2 - |x|^2) to members and 0 to
queries (Bachrach et al. 2014). Rows with no place in the space come back as NaN.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import metrics
from .arrow import dense_block, list_column_at


def _unit(block: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", block, block))[:, None]
    with np.errstate(all="ignore"):
        return np.where(size == 0, np.nan, block / size)


def lift_members(metric: str, block: np.ndarray, max_norm: float | None) -> np.ndarray:
    if metric == "l2":
        return block
    if metric == "cosine":
        return _unit(block)
    with np.errstate(all="ignore"):
        rest = np.sqrt(np.maximum(0.0, max_norm**2 - np.einsum("ij,ij->i", block, block)))
    return np.column_stack([block, rest])


def lift_queries(metric: str, block: np.ndarray) -> np.ndarray:
    if metric == "l2":
        return block
    if metric == "cosine":
        return _unit(block)
    return np.column_stack([block, np.zeros(len(block))])


def lifted_column(metric: str, field: str, dimension: int, max_norm: float | None) -> Column:
    """The lifted vectors as a column, for training centroids; null without a place."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def lifted(vectors: pa.Array) -> pa.Array:
        rows, block = dense_block(vectors, dimension)
        block = lift_members(metric, block, max_norm)
        sound = np.isfinite(block).all(axis=1)
        return list_column_at(rows[sound], block[sound], len(vectors), pa.float64())

    return lifted(F.col(field))


def lifted_distance(metric: str, score: Column, query_sq_norm: Column, max_norm: float | None) -> Column:
    """Turn a metric score back into the distance of the lifted space."""
    if metric in ("l2", "mipsl2"):
        return score
    if metric == "cosine":
        return F.sqrt(F.greatest(F.lit(0.0), score * 2.0))
    return metrics.mips_l2(score, query_sq_norm, F.lit(max_norm))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of every row of ``a`` to every row of ``b`` (a bounded set)."""
    with np.errstate(all="ignore"):
        sq = (
            np.einsum("ij,ij->i", a, a)[:, None]
            + np.einsum("ij,ij->i", b, b)[None, :]
            - 2.0 * (a @ b.T)
        )
        return np.sqrt(np.maximum(sq, 0.0))


#: Beyond so many points a nearest one is looked up by way of a coarse level.
FLAT = 1024


class Nearest:
    """The nearest of a bounded set of points, for blocks of lifted vectors.

    Many points get two levels: coarse points around which the others lie within known
    radii. A vector looks into its nearest coarse group first and then into those that
    the triangle inequality leaves open, so the answer is that of a look at all points.
    """

    def __init__(self, points: np.ndarray, flat: int = FLAT):
        self.points = points
        self.coarse = None
        if len(points) > flat:
            self._group(max(2, int(np.sqrt(len(points)))))

    def _group(self, n: int) -> None:
        points = self.points
        coarse = points[:: max(1, len(points) // n)][:n].copy()
        for _ in range(4):
            home = distances(points, coarse).argmin(axis=1)
            sums = np.zeros_like(coarse)
            np.add.at(sums, home, points)
            held = np.bincount(home, minlength=len(coarse))
            coarse = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], coarse)
        gap = distances(points, coarse)
        home = gap.argmin(axis=1)
        self.coarse = coarse
        self.members = [np.flatnonzero(home == g) for g in range(len(coarse))]
        # A little wider, so that rounding never closes a group.
        self.radius = np.array([gap[m, g].max(initial=-np.inf) for g, m in enumerate(self.members)]) * (1 + 1e-9) + 1e-9

    def find(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and distance of the nearest point; ``len(points)`` and infinity if there is none."""
        if not len(self.points):
            return np.zeros(len(block), np.int32), np.full(len(block), np.inf)
        if self.coarse is None:
            gap = distances(block, self.points)
            gap[~np.isfinite(gap)] = np.inf
            cell = gap.argmin(axis=1).astype(np.int32)
            dist = gap[np.arange(len(gap)), cell]
        else:
            cell, dist = self._by_groups(block)
        cell[np.isinf(dist)] = len(self.points)
        return cell, dist

    def _by_groups(self, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = distances(block, self.coarse)
        far[~np.isfinite(far)] = np.inf
        cell, dist = np.full(len(block), len(self.points), np.int32), np.full(len(block), np.inf)
        # Empty groups, and rows without a place, are never visited.
        least = np.where(np.isfinite(far) & np.isfinite(self.radius)[None, :], far - self.radius, np.inf)
        home = np.where(np.isfinite(self.radius)[None, :], far, np.inf).argmin(axis=1)
        slack = 1e-9 * (1 + np.sqrt(np.einsum("ij,ij->i", block, block)))

        def look(rows: np.ndarray, group: int) -> None:
            members = self.members[group]
            gap = distances(block[rows], self.points[members])
            at = gap.argmin(axis=1)
            near, number = gap[np.arange(len(rows)), at], members[at]
            better = (near < dist[rows]) | ((near == dist[rows]) & (number < cell[rows]))
            dist[rows[better]], cell[rows[better]] = near[better], number[better]

        for group in np.unique(home):
            rows = np.flatnonzero((home == group) & np.isfinite(least[:, group]))
            if len(rows):
                look(rows, int(group))
        for group in range(len(self.coarse)):
            rows = np.flatnonzero((least[:, group] <= dist + slack) & np.isfinite(least[:, group]) & (home != group))
            if len(rows):
                look(rows, group)
        return cell, dist

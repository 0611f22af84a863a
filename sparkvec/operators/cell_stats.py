"""Statistics of an index's cells, kept beside the index so that a search reads no members to plan.

Two tables are written with the index. ``sketches`` has a row for each cell: its members,
its radius, and for each scalar column the least and the greatest value and, if there are
few, all values with their counts. ``counts`` has a row for each cell and group of keys,
where keys are grouped: a write that rewrites groups leaves out their rows.

Under a filter the sketches give each cell an upper bound on its members that pass, often
the exact number. Cells whose bound is zero are never read, and only cells that a search
would otherwise rely on are counted, see :meth:`CellCounts.settled`.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import blanked, names_in
from .knn_join import CellStats

#: A value sketch is complete below this number of values; the counting keeps a few times as many.
VALUES, TRACKED = 256, 1024
#: Longer strings are not kept.
LONGEST = 64
_SKETCHED = (T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
_OWN = ("cell", "distance", "spill", "codes", "rows", "radius")


def scalar_columns(index: DataFrame) -> list[str]:
    return [f.name for f in index.schema.fields if f.name not in _OWN and isinstance(f.dataType, _SKETCHED)]


def _sketch(field: T.StructField) -> Column:
    name = f"`{field.name}`"
    values = F.expr(f"approx_top_k({name}, {VALUES}, {TRACKED})")
    held = F.struct(F.min(name).alias("low"), F.max(name).alias("high"), F.when(F.size(values) < VALUES, values).alias("values"))
    if isinstance(field.dataType, T.StringType):
        held = F.when(F.coalesce(F.max(F.length(name)), F.lit(0)) <= LONGEST, held)
    return held.alias(field.name)


@dataclass(frozen=True)
class StoredStats:
    """The tables of an index; ``without`` are groups of keys that no longer count.

    With ``loose``, members may be gone that the tables do not know of, and all counts are
    bounds.
    """

    sketches: DataFrame
    counts: DataFrame | None = None
    without: tuple[str, ...] = ()
    loose: bool = False

    @classmethod
    def of(cls, index: DataFrame, group: Column | None = None, columns: Sequence[str] | None = None) -> "StoredStats":
        """Measure an index table; no vector is read."""
        columns = [c for c in scalar_columns(index) if columns is None or c in columns]
        facts = [F.count("*").alias("rows"), F.max("distance").alias("radius")]
        sketches = index.groupBy("cell").agg(*facts, *(_sketch(index.schema[c]) for c in columns))
        counts = None if group is None else index.withColumn("_group", group).groupBy("cell", "_group").agg(*facts)
        return cls(sketches, counts)

    def write(self, path: str) -> None:
        self.sketches.coalesce(1).write.mode("errorifexists").parquet(f"{path}/sketches")
        if self.counts is not None:
            self.counts.coalesce(1).write.mode("errorifexists").parquet(f"{path}/counts")

    @classmethod
    def read(cls, spark: SparkSession, path: str, grouped: bool = False) -> "StoredStats":
        return cls(spark.read.parquet(f"{path}/sketches"), spark.read.parquet(f"{path}/counts") if grouped else None)

    def lacking(self, groups: Sequence[str], loose: bool = False) -> "StoredStats":
        return replace(self, without=tuple(groups), loose=loose)

    def load(self, points: np.ndarray, filter: str | Column | None = None, columns: Sequence[str] = ()) -> "CellCounts":
        """What a search needs: one row per cell comes to the driver.

        ``columns`` are those of the index, over which the filter is a plain condition.
        """
        cells = self.sketches.select("cell", "rows", "radius")
        if self.without:
            kept = self.counts.where(~F.col("_group").isin(list(self.without)))
            cells = kept.groupBy("cell").agg(F.sum("rows").alias("rows"), F.max("radius").alias("radius"))
        bounds = None if filter is None or isinstance(filter, Column) else self._bounds(filter, {c.lower() for c in columns})
        if bounds is None:
            cells = cells.withColumn("bound", F.col("rows")).withColumn("exact", F.lit(filter is None))
        else:
            cells = cells.join(F.broadcast(bounds), "cell", "left")  # one row per cell
        count, radius = np.zeros(len(points) + 1, np.int64), np.zeros(len(points) + 1)
        known = np.ones(len(points) + 1, bool)
        for row in cells.collect():
            bound = row["rows"] if row["bound"] is None else min(row["bound"], row["rows"])
            count[row["cell"]], radius[row["cell"]] = bound, row["radius"]
            known[row["cell"]] = bound == 0 or (bool(row["exact"]) and not self.loose and not (self.without and filter is not None))
        return CellCounts(CellStats(points, count, radius), known)

    def _bounds(self, filter: str, columns: set[str]) -> DataFrame | None:
        """``(cell, bound, exact)`` under a filter, from the sketches alone."""
        parts = conjuncts(filter)
        bounds = [b for b in (self._bound(part, columns) for part in parts) if b is not None]
        if not bounds:
            return None
        joined = bounds[0].withColumn("exact", F.col("exact") & F.lit(len(parts) == 1))
        for other in bounds[1:]:
            both = joined.join(other.toDF("cell", "other", "_"), "cell", "full")
            joined = both.select("cell", F.least("bound", "other").alias("bound"), F.lit(False).alias("exact"))
        return joined

    def _bound(self, part: str, columns: set[str]) -> DataFrame | None:
        """The bound of a condition on one sketched column, else None."""
        used = names_in(part) & columns
        held = [c for c in self.sketches.columns if c not in ("cell", "rows", "radius") and used == {c.lower()}]
        if len(held) != 1:
            return None
        name = held[0]
        sketch = self.sketches.select("cell", "rows", F.col(f"`{name}`").alias("s"))
        kind = sketch.schema["s"].dataType["low"].dataType
        values = sketch.where("s.values is not null").select("cell", F.explode("s.values").alias("v")).select(
            "cell", F.col("v.item").cast(kind).alias(name), F.col("v.count").alias("_n")
        )
        passing = values.groupBy("cell").agg(F.coalesce(F.sum(F.when(F.expr(part), F.col("_n"))), F.lit(0)).alias("bound"))
        open_ = sketch.where("s is not null and s.values is null")
        between = within(part, name, "s.low", "s.high", isinstance(kind, T.StringType))
        rest = F.col("rows") if between is None else F.when(F.expr(between), F.col("rows")).otherwise(0)
        return passing.select("cell", "bound", F.lit(True).alias("exact")).unionByName(
            open_.select("cell", rest.alias("bound"), F.lit(False).alias("exact"))
        )


class CellCounts:
    """Cell statistics whose counts are exact where ``known``, else upper bounds."""

    def __init__(self, stats: CellStats, known: np.ndarray):
        self.stats, self.known = stats, known

    def settled(self, passing: DataFrame, picked: Callable[[CellStats], np.ndarray]) -> CellStats:
        """Statistics in which every count that ``picked`` relies on is exact.

        ``picked(stats)`` gives a mask of cells by query that grows as counts shrink. Cells
        in it that are bounds only are counted, with as many of the next ones in each
        round, until none is left: few cells are counted for few queries.
        """
        stats, known, ahead = self.stats, self.known.copy(), 1
        while True:
            mask = picked(stats)
            used = np.atleast_2d(mask).any(axis=0)
            if not (used & ~known).any():
                return stats
            # The next cells in the order of the queries that still need some.
            spare = replace_counts(stats, np.where(known, stats.count, np.minimum(stats.count, 1 + stats.count // (1 << min(ahead, 40)))))
            wanted = np.flatnonzero((used | np.atleast_2d(picked(spare)).any(axis=0)) & ~known)
            found = passing.where(F.col("cell").isin([int(c) for c in wanted])).groupBy("cell").agg(F.count("*").alias("n")).collect()
            count = stats.count.copy()
            count[wanted] = 0
            for row in found:
                count[row["cell"]] = row["n"]
            known[wanted] = True
            stats, ahead = replace_counts(stats, count), 2 * ahead


def replace_counts(stats: CellStats, count: np.ndarray) -> CellStats:
    stats = copy.copy(stats)
    stats.count = count
    return stats


# -- conditions, as text that the guard of predicates has passed ----------------


def conjuncts(text: str) -> list[str]:
    """The parts that top-level ANDs join; the whole text if it is not that plain."""
    plain, depth, between, cuts = blanked(text), 0, False, [0]
    for token in re.finditer(r"[()\[\]]|[^\W\d]\w*", plain):
        word = token.group().lower()
        if word in ("(", "[", "case"):
            depth += 1
        elif word in (")", "]", "end"):
            depth -= 1
        elif depth == 0 and word == "or":
            return [text]
        elif depth == 0 and word == "between":
            between = True
        elif depth == 0 and word == "and":
            if between:
                between = False
            else:
                cuts += [token.start(), token.end()]
    if depth:
        return [text]
    return [text[a:b].strip() for a, b in zip([0, *cuts[2::2]], [*cuts[1::2], len(text)], strict=True)]


_NUMBER, _STRING = r"-?\d+(?:\.\d+)?", r"'[^'\\]*'"
_FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<=", "=": "=", "==": "=="}


def within(part: str, name: str, low: str, high: str, text: bool) -> str | None:
    """A condition on a column's least and greatest value that holds if ``part`` may hold between them.

    A column of text is compared with text only: as numbers its values have another order.
    """
    column, literal = rf"(?:`{re.escape(name)}`|{re.escape(name)})", f"({_STRING})" if text else f"({_NUMBER}|{_STRING})"
    if found := re.fullmatch(rf"\s*{column}\s+between\s+{literal}\s+and\s+{literal}\s*", part, re.I):
        return f"{low} <= {found[2]} and {high} >= {found[1]}"
    if found := re.fullmatch(rf"\s*{column}\s*(<=|>=|==|=|<|>)\s*{literal}\s*", part, re.I):
        op, value = found[1], found[2]
    elif found := re.fullmatch(rf"\s*{literal}\s*(<=|>=|==|=|<|>)\s*{column}\s*", part, re.I):
        op, value = _FLIPPED[found[2]], found[1]
    else:
        return None
    if op in ("=", "=="):
        return f"{low} <= {value} and {high} >= {value}"
    return f"{low} {op} {value}" if op in ("<", "<=") else f"{high} {op} {value}"

"""Connected components by alternating star contractions on a table of edges.

Each round turns a node's neighbours towards the smallest one: first from every
node to its larger neighbours, then from every node to its smaller ones. A group
ends as one star around its smallest id after about log(size) rounds. A round is a
partial aggregate and a join, so a hub with a third of the edges is reduced before
the shuffle and split by the skew handling of the join; nothing reaches the driver
but an edge count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle

MAX_ROUNDS = 60


def _nearest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = _nearest(both).select("u", F.least("u", "m").alias("m"))
    return both.join(near, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    turned = edges.join(_nearest(edges), "u")
    return turned.select(
        F.explode(
            F.array(
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            )
        ).alias("e")
    ).select("e.u", "e.v").where("u > v")


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for each id in ``edges(a, b)`` that has a smaller id in its group.

    Ids that are alone, or the smallest of their group, have no row. Edges with a
    null end or two equal ends are no edges; repeated edges count once.
    """
    edges = settle(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    mark = _mark(edges)
    for _ in range(MAX_ROUNDS):
        if not mark[0]:
            break
        edges = settle(_small(_large(edges).distinct()).distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))

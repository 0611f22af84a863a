"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations.

A table turns a vector with three rounds of random signs and a Walsh-Hadamard transform
and takes the axis it points along most, sign included; two such turns make a bucket.
Multiprobe: a vector also enters the buckets of the second best axis of either turn.
Two vectors with cosine 0.95 share a bucket of one table with a chance near 0.7, so ten
tables miss about one such pair in a hundred thousand.

Equal vectors form one class; only the smallest id of a class is hashed, with the
class's size. Inside a bucket pairs are verified in double precision, in blocks of
bounded size: a bucket with more rows is dealt to several tiles, and each pair of tiles
is a block. A pair that shares several buckets counts in the first of them. No pairs
leave a block: each vector brings home how many vectors it links with and the smallest
id of its group in the block, at most one row per vector and bucket, so a group of near
copies costs its rows in traffic however many links it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .components import components
from .text import mix
from .vectors import matrix, selected, units, usable

TABLES, TURNS = 10, 2
PROBES = 1 + TURNS
COSINE = 0.95
#: Rows of a tile, and of the buckets that are looked at together.
TILE, TOGETHER = 512, 4096


def _signs(table: int, turn: int, step: int, width: int) -> np.ndarray:
    seed = np.arange(width, dtype=np.uint64) + np.uint64(((table * 16 + turn) * 16 + step + 1) << 20)
    return np.where(mix(seed) & np.uint64(1), 1.0, -1.0)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of rows whose width is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, -1, 2, half)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        half *= 2
        x = x.reshape(n, width)
    return x


def buckets(vectors: np.ndarray, tables: int = TABLES) -> np.ndarray:
    """Bucket numbers: rows x tables x probes; the first probe is the vector's own."""
    n, dim = vectors.shape
    width = 1 << max(1, (dim - 1).bit_length())
    x = np.zeros((n, width))
    x[:, :dim] = units(vectors)
    out = np.zeros((n, tables, PROBES), np.int64)
    for table in range(tables):
        axes = []
        for turn in range(TURNS):
            y = x
            for step in range(3):
                y = hadamard(y * _signs(table, turn, step, width))
            size = np.abs(y)
            order = np.argpartition(-size, 1, axis=1)[:, :2]
            swap = np.take_along_axis(size, order[:, :1], 1) < np.take_along_axis(size, order[:, 1:], 1)
            order = np.where(swap, order[:, ::-1], order)
            axes.append(order * 2 + (np.take_along_axis(y, order, 1) > 0))
        best = [a[:, 0] for a in axes]
        for probe in range(PROBES):
            picked = [a[:, 1] if probe == turn + 1 else best[turn] for turn, a in enumerate(axes)]
            out[:, table, probe] = picked[0] * 2 * width + picked[1]
    # Numbers beyond 31 bits are hashed; buckets that meet by that cost time, no links.
    return out if 4 * width * width < 1 << 31 else (mix(out.astype(np.uint64)) >> np.uint64(33)).astype(np.int64)


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.diff(batch.column("vector").offsets.to_numpy())
        for dim in np.unique(sizes):
            rows = pa.array(np.flatnonzero(sizes == dim))
            vectors = batch.column("vector").take(rows)
            keys = buckets(matrix(vectors)).reshape(len(rows), -1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(rows),
                    batch.column("size").take(rows),
                    vectors,
                    pa.array([int(dim)] * len(rows), pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * keys.shape[1], pa.int32()), pa.array(keys.reshape(-1), pa.int32())),
                ],
                names=["id", "size", "vector", "dim", "keys"],
            )


def _pairs_within(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) of rows of the same range."""
    sizes = stops - starts
    row = np.concatenate([np.arange(a, b) for a, b in zip(starts, stops, strict=True)])
    later = np.repeat(stops, sizes) - row - 1
    i = np.repeat(row, later)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(later) - later, later)
    return i, j


def _shared_first(keys_i: np.ndarray, keys_j: np.ndarray, table: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether this bucket is the first one that the two vectors of each pair share."""
    same = (keys_i[:, :, :, None] == keys_j[:, :, None, :]).any(axis=3)
    any_ = same.any(axis=2)
    rows = np.arange(len(table))
    first = any_.argmax(axis=1)
    smallest = np.where(same[rows, table], keys_i[rows, table], np.iinfo(keys_i.dtype).max).min(axis=1)
    return (first == table) & (smallest == bucket)


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row reachable from each row."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _linker(cosine: float):
    def linked(t: pa.Table) -> pa.RecordBatch:
        """Links of whole blocks that lie one after the other, rows ordered by block, then id."""
        ids, sizes, table, bucket, tile = (t[c].to_numpy() for c in ("id", "size", "tbl", "bucket", "tile"))
        block = np.stack([t[c].to_numpy() for c in ("dim", "tbl", "bucket", "i", "j")])
        edges = np.flatnonzero(np.append(True, (block[:, 1:] != block[:, :-1]).any(axis=0)))
        stops = np.append(edges[1:], len(ids))
        keys = matrix(t["keys"]).astype(np.int32).reshape(len(ids), -1, PROBES)
        links, near = np.zeros(len(ids), np.int64), np.arange(len(ids))
        dims = t["dim"].to_numpy()[edges]
        for dim in np.unique(dims):
            a, b = edges[dims == dim], stops[dims == dim]
            rows = np.concatenate([np.arange(x, y) for x, y in zip(a, b, strict=True)])
            vectors = np.zeros((len(ids), int(dim)))
            vectors[rows] = matrix(t["vector"].combine_chunks().take(pa.array(rows)))
            vectors[rows] = units(vectors[rows])
            i, j = _close(vectors, a, b, cosine)
            keep = (t["i"].to_numpy()[i] == t["j"].to_numpy()[i]) | (tile[i] != tile[j])
            i, j = i[keep], j[keep]
            first = [_shared_first(keys[i[x : x + 50_000]], keys[j[x : x + 50_000]], table[i[x : x + 50_000]], bucket[i[x : x + 50_000]]) for x in range(0, len(i), 50_000)]
            keep = np.concatenate(first) if first else np.zeros(0, bool)
            i, j = i[keep], j[keep]
            links += np.bincount(i, sizes[j], len(ids)).astype(np.int64) + np.bincount(j, sizes[i], len(ids)).astype(np.int64)
            near = np.minimum(near, local_components(len(ids), i, j))
        found = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(links[found]), pa.array(ids[near[found]])], names=["id", "links", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows < TOGETHER:
                continue
            whole = pa.concat_tables(held).combine_chunks()
            # The last block may go on in the next batch.
            tail = np.ones(whole.num_rows, bool)
            for c in ("dim", "tbl", "bucket", "i", "j"):
                tail &= whole[c].to_numpy() == whole[c][-1].as_py()
            cut = int(np.flatnonzero(~tail)[-1]) + 1 if not tail.all() else 0
            if cut:
                for at in _starts(whole.slice(0, cut)):
                    yield linked(at)
                held = [whole.slice(cut)]
                rows = whole.num_rows - cut
        if rows:
            for at in _starts(pa.concat_tables(held).combine_chunks()):
                yield linked(at)

    return run


def _starts(t: pa.Table) -> Iterator[pa.Table]:
    """Parts of about ``TOGETHER`` rows that end with a block."""
    block = np.stack([t[c].to_numpy() for c in ("dim", "tbl", "bucket", "i", "j")])
    ends = np.append(np.flatnonzero((block[:, 1:] != block[:, :-1]).any(axis=0)) + 1, t.num_rows)
    at = 0
    while at < t.num_rows:
        stop = int(ends[np.searchsorted(ends, min(at + TOGETHER, t.num_rows))])
        yield t.slice(at, stop - at).combine_chunks()
        at = stop


def _close(vectors: np.ndarray, starts: np.ndarray, stops: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of one block with at least the cosine."""
    large = stops - starts > 48
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for a, b in zip(starts[large], stops[large], strict=True):
        i, j = np.nonzero(np.triu(vectors[a:b] @ vectors[a:b].T >= cosine, 1))
        found.append((i + a, j + a))
    if (~large).any():
        i, j = _pairs_within(starts[~large], stops[~large])
        for x in range(0, len(i), 50_000):
            p, q = i[x : x + 50_000], j[x : x + 50_000]
            hit = np.einsum("ij,ij->i", vectors[p], vectors[q]) >= cosine
            found.append((p[hit], q[hit]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: one row for each row of ``df``.

    Vectors that are null, zero or hold a null or non-finite component link with nothing,
    and vectors of different length never link. Rows that repeat an id are one node for
    components. A row without an id has no component and is not kept. Other columns of
    ``df`` are not looked at.
    """
    vectors = selected(df, id_col, vector_col)
    prints = (F.xxhash64("vector").alias("f1"), F.xxhash64(F.lit(1), "vector").alias("f2"))
    good = vectors.where(usable("vector") & F.col("id").isNotNull())
    classes = good.groupBy(*prints).agg(F.min("id").alias("id"), F.count("*").alias("size"), F.any_value("vector").alias("vector"))
    classes = settle(classes)
    spec = f"id long, size long, vector {dict(vectors.dtypes)['vector']}, dim int, keys array<int>"
    hashed = settle(classes.select("id", "size", "vector").mapInArrow(_hasher, spec))
    entries = hashed.select("id", "dim", F.posexplode("keys").alias("at", "bucket")).select(
        "id", "dim", F.floor(F.col("at") / PROBES).cast("int").alias("tbl"), "bucket"
    )
    place = ["dim", "tbl", "bucket"]
    tiles = entries.groupBy(place).agg(F.count("*").alias("n")).where("n > 1").select(*place, F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    tile = F.pmod(F.xxhash64("id"), "tiles").cast("int")
    dealt = entries.join(tiles, place).select("*", tile.alias("tile")).select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    dealt = dealt.select("id", "tbl", "bucket", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    blocks = dealt.join(hashed, "id").select("dim", "tbl", "bucket", "i", "j", "tile", "id", "size", "vector", "keys")
    order = ["dim", "tbl", "bucket", "i", "j"]
    met = blocks.repartition(*order).sortWithinPartitions(*order, "id")
    links = settle(met.mapInArrow(_linker(cosine), "id long, links long, near long"))
    totals = links.groupBy("id").agg(F.sum("links").alias("links"))
    found = components(links.select(F.col("id").alias("a"), F.col("near").alias("b")))
    labels = (
        classes.select("f1", "f2", "id", "size")
        .join(totals, "id", "left")
        .join(found, "id", "left")
        .select("f1", "f2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("label"))
    )
    marked = vectors.select("id", *(F.when(usable("vector") & F.col("id").isNotNull(), p).alias(n) for p, n in zip(prints, ("f1", "f2"), strict=True)))
    alone = marked.where("f1 is null").select("id", F.lit(0).cast("long").alias("links"), F.col("id").alias("label"))
    linked = marked.where("f1 is not null").join(labels, ["f1", "f2"], "left").select("id", "links", "label")
    return linked.unionByName(alone).select(
        F.col("id").alias("vec_id"),
        F.col("links").alias("n_links"),
        F.col("label").alias("component_id"),
        F.coalesce(F.col("id") == F.col("label"), F.lit(False)).alias("kept"),
    )

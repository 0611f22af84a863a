"""Partitioned (IVF) index tables and approximate search over them.

An index is a plain table: the key, the vector, any scalar columns wanted for
filters, and the number of the cell each row belongs to. Written partitioned by
cell, a static probe list prunes directories and a probe join prunes at run time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidArgument
from ..functions import metrics, spaces
from ..functions.arrow import dense_block, list_column
from ..functions.predicates import predicate, where
from ..session import settle
from .cell_stats import CellCounts, StoredStats
from .knn_join import CellStats, as_mips, bounded_block, fold_queries, knn_join, largest_norm, vector_dimension
from .search import knn
from .tiles import BLOCK_BYTES, arrow_schema, probe_scan, rank_hits, tile_topk

N_LIST, N_ITERS = 128, 10
#: Rows of the training sample for each cell.
PER_CELL = 256
SOAR_WEIGHT = 1.0
#: Folder of the statistics inside an index; Spark's readers of the index pass it over.
STATS = "_stats"
#: Queries times cells that the driver plans; more are planned in tasks.
PLANNED = 1 << 24


@dataclass(frozen=True)
class Centroids:
    """Trained cells: ``n_list`` points of the lifted space, a bounded array."""

    points: np.ndarray
    metric: str
    dimension: int
    max_norm: float | None = None

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, [float(v) for v in p]) for i, p in enumerate(self.points)]
        return spark.createDataFrame(rows, "cell int, centroid array<double>")

    def lift(self, block: np.ndarray) -> np.ndarray:
        return spaces.lift_members(self.metric, block, self.max_norm)

    def lift_queries(self, block: np.ndarray) -> np.ndarray:
        return spaces.lift_queries(self.metric, block)


def train_centroids(
    df: DataFrame,
    field: str,
    *,
    n_list: int = N_LIST,
    n_iters: int = N_ITERS,
    metric: str = "l2",
    seed: int = 17,
    per_cell: int = PER_CELL,
) -> Centroids:
    """k-means over a sample of about ``per_cell`` rows for each cell.

    The sample fits the points only: :func:`assign` places every row. It is lifted and
    written once in single precision; a round is one pass in which each task returns a
    sum for each cell, so a round moves tasks times cells rows whatever the sample's size.
    A cell that loses all members starts again at a row far from its own cell.
    """
    metrics.check_metric(metric)
    dimension = vector_dimension(df, field)
    top = largest_norm(df, field, dimension) if metric in ("ip", "mipsl2") else None
    rows = df.select(field)
    share = per_cell * n_list / max(1, df.count())
    if share < 1:
        rows = rows.where(F.rand(seed) < share)

    def lifted(batches):
        for batch in batches:
            _, block = dense_block(batch[field], dimension)
            with np.errstate(all="ignore"):
                block = spaces.lift_members(metric, block, top).astype(np.float32)
            block = block[np.isfinite(block).all(axis=1)]
            yield pa.RecordBatch.from_arrays([list_column(block, pa.float32())], names=["v"])

    sample = settle(rows.mapInArrow(lifted, "v array<float>"))
    width = dimension if metric in ("l2", "cosine") else dimension + 1
    # Rows by their hash are a draw that does not depend on the table's order.
    first = sample.distinct().orderBy(F.xxhash64(F.lit(seed), "v"), "v").limit(n_list).toArrow()
    points = dense_block(first["v"], width)[1]
    for _ in range(n_iters if len(points) else 0):
        moved = _round(sample, points, width)
        if np.allclose(moved, points, rtol=1e-4, atol=1e-6):
            points = moved
            break
        points = moved
    return Centroids(np.unique(points, axis=0) if len(points) else np.zeros((0, width)), metric, dimension, top)


_SUMS = pa.schema([("cell", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64())), ("gap", pa.float64()), ("far", pa.list_(pa.float32()))])


def _round(sample: DataFrame, points: np.ndarray, width: int) -> np.ndarray:
    """The mean of each point's rows in the sample."""
    single = points.astype(np.float32)

    def sums(batches):
        nearest = spaces.Nearest(single)
        total, n = np.zeros((len(single), width)), np.zeros(len(single), np.int64)
        gap, far = np.full(len(single), -1.0), np.zeros((len(single), width), np.float32)
        for batch in batches:
            block = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if not len(block):
                continue
            cell, dist = nearest.find(block)
            order = np.argsort(cell, kind="stable")
            starts = np.flatnonzero(np.append(True, np.diff(cell[order]) > 0))
            own = cell[order][starts]
            total[own] += np.add.reduceat(block[order], starts, axis=0, dtype=np.float64)
            n[own] += np.diff(np.append(starts, len(block)))
            by_gap = np.lexsort((dist, cell))
            last = by_gap[np.append(starts[1:], len(block)) - 1]
            wider = dist[last] > gap[own]
            gap[own[wider]], far[own[wider]] = dist[last][wider], block[last[wider]]
        held = np.flatnonzero(n)
        columns = [pa.array(held, pa.int32()), pa.array(n[held]), list_column(total[held], pa.float64()), pa.array(gap[held]), list_column(far[held], pa.float32())]
        yield pa.RecordBatch.from_arrays(columns, schema=_SUMS)

    def folded(t: pa.Table) -> pa.Table:
        widest = int(np.argmax(t["gap"].to_numpy()))
        total = dense_block(t["total"], width)[1].sum(axis=0, keepdims=True)
        columns = [t["cell"].slice(0, 1), pa.array([t["n"].to_numpy().sum()]), list_column(total, pa.float64()), t["gap"].slice(widest, 1), t["far"].slice(widest, 1)]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], schema=_SUMS)

    spec = "cell int, n long, total array<double>, gap double, far array<float>"
    found = sample.mapInArrow(sums, spec).groupBy("cell").applyInArrow(folded, spec).toArrow()  # one row per cell
    moved = points.copy()
    cell = found["cell"].to_numpy()
    moved[cell] = dense_block(found["total"], width)[1] / found["n"].to_numpy()[:, None]
    empty = np.setdiff1d(np.arange(len(points)), cell)
    widest = np.argsort(-found["gap"].to_numpy(), kind="stable")[: len(empty)]
    moved[empty[: len(widest)]] = dense_block(found["far"], width)[1][widest]
    return moved


def assign(df: DataFrame, field: str, cells: Centroids, *, soar: bool = False, weight: float = SOAR_WEIGHT) -> DataFrame:
    """Add ``cell`` and ``distance``; rows without a usable vector are left out.

    With ``soar`` every row appears a second time in the cell that minimises
    |r'|^2 + weight * (r . r' / |r|)^2, where r and r' are its residuals (Sun et
    al. 2023), marked by ``spill``.
    """
    fields = [
        *df.schema.fields,
        T.StructField("cell", T.IntegerType()),
        T.StructField("distance", T.DoubleType()),
    ]
    if soar:
        fields.append(T.StructField("spill", T.BooleanType()))
    schema = T.StructType(fields)
    out = arrow_schema(schema)

    def place(batches):
        nearest = spaces.Nearest(cells.points)
        for batch in batches:
            rows, block = dense_block(batch[field], cells.dimension)
            lifted = cells.lift(block)
            sound = ~np.isnan(lifted).any(axis=1)
            rows, lifted = rows[sound], lifted[sound]
            cell, gap = nearest.find(lifted)
            yield emit(batch, rows, cell, gap, False)
            if soar and len(cells.points) > 1:
                inside = cell < len(cells.points)
                second, far = second_cell(lifted[inside], cell[inside], cells.points, weight)
                yield emit(batch, rows[inside], second, far, True)

    def emit(batch, rows, cell, gap, spill):
        kept = batch.take(pa.array(rows))
        extra = [pa.array(cell, type=pa.int32()), pa.array(gap)]
        if soar:
            extra.append(pa.array(np.full(len(rows), spill)))
        return pa.RecordBatch.from_arrays([*kept.columns, *extra], schema=out)

    return df.mapInArrow(place, schema)


def second_cell(lifted: np.ndarray, cell: np.ndarray, points: np.ndarray, weight: float):
    residual = lifted - points[cell]
    size = np.sqrt(np.einsum("ij,ij->i", residual, residual))[:, None]
    gap = spaces.distances(lifted, points)
    along = np.einsum("ij,ij->i", lifted, residual)[:, None] - residual @ points.T
    with np.errstate(all="ignore"):
        shared = np.where(size > 0, along / size, 0.0)
    cost = gap**2 + weight * shared**2
    cost[np.arange(len(cost)), cell] = np.inf
    second = cost.argmin(axis=1).astype(np.int32)
    return second, gap[np.arange(len(gap)), second]


def default_probes(cells: Centroids) -> int:
    return max(1, len(cells.points) // 10)


def nearest_cells(cells: Centroids, lifted: np.ndarray, n_probe: int) -> np.ndarray:
    """Mask of the ``n_probe`` nearest cells, plus the cell of unplaceable rows."""
    gap = spaces.distances(lifted, cells.points)
    gap = np.where(np.isfinite(gap), gap, np.inf)
    order = np.argsort(gap, axis=1, kind="stable")[:, :n_probe]
    mask = np.zeros((len(lifted), len(cells.points) + 1), dtype=bool)
    np.put_along_axis(mask, order, True, axis=1)
    mask[:, -1] = True
    return mask


def _counted(index: DataFrame, cells: Centroids, filter, stats: StoredStats | None) -> CellCounts:
    """Counts of the members that pass: from stored statistics, else by a pass over the index."""
    if stats is not None:
        return stats.load(cells.points, filter, index.columns)
    return CellCounts(CellStats.measure(where(index, filter), cells.points), np.ones(len(cells.points) + 1, bool))


def _probe_join(queries, index, cells: Centroids, choose, *, qid, pk, field, query_field, k, filter, radius, max_norm, block_bytes, stats, read=dense_block):
    """Search the cells that ``choose(lifted, stats)`` picks, and more until they hold k.

    The statistics count the members that pass the filter, so a query has k hits
    wherever k members pass. Query tables under the block bound are planned here and go
    to the tasks that read their cells; larger ones meet the members in tiles. mipsl2
    ranks by the product and gets its score last.
    """
    repeats = "spill" in index.columns
    passing = where(index, filter)
    counts = _counted(index, cells, filter, stats)
    # A row is in two cells at most.
    need = 2 * k if repeats else k
    metric = "ip" if cells.metric == "mipsl2" else cells.metric
    raw = queries.select(F.col(qid).alias("qid"), F.col(query_field or field).alias("vector"))
    members = passing.select(F.col(pk).alias("pk"), F.col(field).alias("vector"), "cell", *(["spill"] if repeats else []))

    def picked(lifted, known):
        mask = choose(lifted, known) | known.first_cells(lifted, need)
        mask[:, known.count == 0] = False
        return mask

    block = bounded_block(raw, cells.dimension, block_bytes)
    if block is not None and len(block[1]) * len(cells.points) <= PLANNED:
        lifted = cells.lift_queries(block[1])
        known = counts.settled(passing, lambda known: picked(lifted, known))
        mask = picked(lifted, known)
        if repeats and (mask | (known.count == 0)).all():
            # Every cell is visited: the second place of a row adds nothing.
            members = members.where(~F.col("spill"))
        hits = probe_scan(members, *block, mask, k=need, metric=metric, read=read, block_bytes=block_bytes)
        asked = fold_queries(raw, cells.dimension)
    else:
        known = counts.settled(passing, lambda known: known.count > 0)
        asked, count = settle(fold_queries(raw, cells.dimension)), known.count
        if repeats:
            # Rows in their second place are cells of their own, which a query of all cells does without.
            members = members.withColumn("cell", (F.col("cell") * 2 + F.col("spill").cast("int")).cast("int"))
            count = np.zeros(2 * len(known.count), np.int64)
            for row in members.groupBy("cell").agg(F.count("*").alias("n")).collect():  # two rows per cell
                count[row["cell"]] = row["n"]

        def chosen(vectors, _):
            mask = picked(cells.lift_queries(vectors), known)
            if repeats:
                whole = (mask | (known.count == 0)).all(axis=1)
                mask = np.repeat(mask, 2, axis=1)
                mask[whole, 1::2] = False
            return mask

        shape = dict(k=k, metric=metric, dimension=cells.dimension, block_bytes=block_bytes, read=read, repeats=repeats)
        hits = tile_topk(members, asked, asked.count(), count, chosen, **shape)
    ranked = rank_hits(hits, k, metric, repeats)
    if cells.metric == "mipsl2":
        ranked = as_mips(ranked, asked, cells.max_norm if max_norm is None else max_norm)
    if radius is not None:
        ranked = ranked.where(F.col("score") >= radius if cells.metric == "ip" else F.col("score") <= radius)
    return ranked


def ivf_knn(
    queries: DataFrame,
    index: DataFrame,
    cells: Centroids,
    *,
    qid: str,
    pk: str,
    field: str,
    query_field: str | None = None,
    k: int = 10,
    n_probe: int | None = None,
    filter: str | Column | None = None,
    radius: float | None = None,
    max_norm: float | None = None,
    block_bytes: int = BLOCK_BYTES,
    stats: StoredStats | None = None,
    read=dense_block,
) -> DataFrame:
    """Rows ``(qid, rank, pk, score)`` from the ``n_probe`` nearest cells.

    Cells are added until they hold k members that pass the filter. ``max_norm`` is
    the norm that mipsl2 scores refer to, if the collection has grown since training.
    With the index's ``stats`` no pass over the index precedes the search. ``read`` gives
    the positions and values of a column of members, which may hold codes.
    """
    n = default_probes(cells) if n_probe is None else n_probe
    if n <= 0:
        raise InvalidArgument("n_probe must be positive")
    return _probe_join(
        queries, index, cells, lambda lifted, _: nearest_cells(cells, lifted, n),
        qid=qid, pk=pk, field=field, query_field=query_field, k=k, filter=filter,
        radius=radius, max_norm=max_norm, block_bytes=block_bytes, stats=stats, read=read,
    )


def ann_knn(
    queries: DataFrame,
    index: DataFrame,
    cells: Centroids,
    *,
    qid: str,
    pk: str,
    field: str,
    query_field: str | None = None,
    k: int = 10,
    ef: int = 64,
    filter: str | Column | None = None,
    radius: float | None = None,
    max_norm: float | None = None,
    block_bytes: int = BLOCK_BYTES,
    stats: StoredStats | None = None,
    read=dense_block,
) -> DataFrame:
    """Search with a recall dial: nearest cells until they hold ``ef`` members.

    A larger ``ef`` visits more; one at the collection's size is exact. Members are
    those that pass the filter.
    """
    if ef <= 0:
        raise InvalidArgument("ef must be positive")
    return _probe_join(
        queries, index, cells, lambda lifted, stats: stats.first_cells(lifted, ef),
        qid=qid, pk=pk, field=field, query_field=query_field, k=k, filter=filter,
        radius=radius, max_norm=max_norm, block_bytes=block_bytes, stats=stats, read=read,
    )


def quantized(index: DataFrame, field: str, quantizer) -> DataFrame:
    """Index table that holds ``codes`` in place of the vectors."""
    return index.withColumn("codes", quantizer.encode(F.col(field))).drop(field)


def ivf_knn_refined(
    queries: DataFrame,
    codes: DataFrame,
    originals: DataFrame,
    cells: Centroids,
    quantizer,
    *,
    qid: str,
    pk: str,
    field: str,
    query_field: str | None = None,
    k: int = 10,
    scale_factor: float = 1.0,
    n_probe: int | None = None,
    ef: int | None = None,
    filter: str | Column | None = None,
    radius: float | None = None,
    max_norm: float | None = None,
    block_bytes: int = BLOCK_BYTES,
    stats: StoredStats | None = None,
) -> DataFrame:
    """Search an index of codes for ``k * scale_factor`` hits per query, then rank
    those by the original vectors."""
    if scale_factor < 1.0:
        raise InvalidArgument("scale_factor must be at least 1")
    shape = dict(
        qid=qid, pk=pk, k=math.ceil(k * scale_factor), filter=filter, block_bytes=block_bytes,
    )
    # Codes are decoded where they are scored; no shuffle moves their values.
    shape |= dict(field="codes", query_field=query_field or field, read=quantizer.read, stats=stats)
    if ef is not None:
        wide = ann_knn(queries, codes, cells, ef=ef, **shape)
    else:
        wide = ivf_knn(queries, codes, cells, n_probe=n_probe, **shape)
    asked = fold_queries(
        queries.select(F.col(qid).alias("qid"), F.col(query_field or field).alias("vector")), cells.dimension
    )
    members = originals.select(F.col(pk).alias("pk"), F.col(field).alias("member"))
    pairs = wide.select("qid", "pk").join(members, "pk").join(asked, "qid")
    metric = "ip" if cells.metric == "mipsl2" else cells.metric
    hits = pairs.select("qid", "pk", metrics.score(metric, "member", "vector").alias("score")).where("score is not null")
    ranked = rank_hits(hits, k, metric)
    if cells.metric == "mipsl2":
        ranked = as_mips(ranked, asked, cells.max_norm if max_norm is None else max_norm)
    if radius is not None:
        ranked = ranked.where(F.col("score") >= radius if cells.metric == "ip" else F.col("score") <= radius)
    return ranked


def ivf_knn_one(
    index: DataFrame,
    cells: Centroids,
    vector: Sequence[float],
    *,
    pk: str,
    field: str,
    k: int = 10,
    n_probe: int | None = None,
    filter: str | Column | None = None,
    linear: bool = False,
    exact: bool = False,
    max_norm: float | None = None,
    stats: StoredStats | None = None,
    **options,
) -> DataFrame:
    """One query vector: the probe list is a filter on the partition column.

    Cells are added until they hold k members that pass the filter. With ``exact`` the
    k-th distance found there bounds the cells of a second look, and the answer is that
    of a full scan.
    """
    repeats = "spill" in index.columns
    table = where(index, filter)
    metric = "ip" if cells.metric == "mipsl2" else cells.metric
    search = dict(pk=pk, metric=metric, k=k)
    if linear:
        table = table.where(~F.col("spill")) if repeats else table
    else:
        lifted, need = cells.lift_queries(np.asarray([vector], dtype=np.float64)), 2 * k if repeats else k
        known = _counted(index, cells, filter, stats).settled(table, lambda known: known.first_cells(lifted, need))
        mask = known.first_cells(lifted, need)
        if not exact:
            mask |= nearest_cells(cells, lifted, default_probes(cells) if n_probe is None else n_probe)
        mask[:, known.count == 0] = False
        if exact:
            first = knn(_in_cells(table, mask, pk, k if repeats else 0, field, vector, metric), field, vector, **search)
            reach = _reach(first.select("score").collect(), k, cells, vector)  # k scores
            mask |= known.reachable(lifted, reach)
        table = _in_cells(table, mask, pk, k if repeats else 0, field, vector, metric)
    keep = [c for c in table.columns if c not in ("cell", "distance", "spill")]
    if cells.metric != "mipsl2":
        return knn(table.select(*keep), field, vector, **search, **options)
    # Ranked by the product; the score and the radius refer to the norm asked for.
    radius = options.pop("radius", None)
    found = knn(table.select(*keep), field, vector, **search, **options)
    q_sq = float(np.dot(vector, vector))
    top = cells.max_norm if max_norm is None else max_norm
    found = found.withColumn("score", metrics.mips_l2(F.col("score"), F.lit(q_sq), F.lit(top)))
    return found if radius is None else found.where(F.col("score") <= radius)


def _in_cells(table: DataFrame, mask: np.ndarray, pk: str, repeated: int, field: str, vector, metric: str) -> DataFrame:
    """The rows of the masked cells; of rows that are in two, the best ``repeated`` once each."""
    table = table.where(F.col("cell").isin([int(c) for c in np.flatnonzero(mask[0])]))
    if not repeated:
        return table
    # The two places of a row have one score, so twice as many rows hold the best k.
    score = metrics.score_against(metric, vector)(F.col(field))
    scored = table.withColumn("_score", metrics.defined(score)).where("_score is not null")
    best = scored.orderBy(metrics.closest_first(metric, F.col("_score")), F.col(pk).asc()).limit(2 * repeated)
    return best.dropDuplicates([pk]).drop("_score")


def _reach(found: list, k: int, cells: Centroids, vector) -> np.ndarray:
    """Lifted distance of the k-th hit; without bound if there are fewer."""
    if len(found) < k:
        return np.array([np.inf])
    worst = found[-1]["score"]
    if cells.metric == "l2":
        return np.array([worst])
    if cells.metric == "cosine":
        return np.array([math.sqrt(max(0.0, 2.0 * worst))])
    return np.array([math.sqrt(max(0.0, cells.max_norm**2 + float(np.dot(vector, vector)) - 2.0 * worst))])


def knn_adaptive(
    df: DataFrame,
    index: DataFrame,
    cells: Centroids,
    vector: Sequence[float],
    *,
    pk: str,
    field: str,
    filter: str | Column,
    ratio: float = 0.1,
    stats: StoredStats | None = None,
    **options,
) -> DataFrame:
    """A scan when few rows pass the filter, else the index; the answer is the same.

    Both numbers come from the index's ``stats`` where these know them, else one pass
    counts them; the index branch visits every cell that could hold a hit.
    """
    hit = predicate(df, filter)
    few = None
    if stats is not None and "spill" not in index.columns:
        rows, bound = stats.load(cells.points), stats.load(cells.points, filter, index.columns)
        if bound.stats.count.sum() <= ratio * rows.stats.count.sum() or bound.known.all():
            few = bound.stats.count.sum() <= ratio * rows.stats.count.sum()
    if few is None:
        counts = df.agg(F.count("*").alias("rows"), F.count_if(hit).alias("passing")).first()
        few = counts["passing"] <= ratio * counts["rows"]
    if few:
        return knn(df, field, vector, pk=pk, metric=cells.metric, filter=filter, **options)
    return ivf_knn_one(index, cells, vector, pk=pk, field=field, filter=filter, exact=True, stats=stats, **options)


def recall_at_k(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact hits that were found, over all queries."""
    hit = found.select("qid", "pk").withColumn("_hit", F.lit(1.0))
    return (
        exact.select("qid", "pk")
        .join(hit, ["qid", "pk"], "left")
        .agg(
            F.countDistinct("qid").alias("queries"),
            F.count(F.lit(1)).alias("expected"),
            F.avg(F.coalesce("_hit", F.lit(0.0))).alias("recall"),
        )
    )


def recall_curve(queries, df, index, cells, n_probes: Sequence[int], *, qid, pk, field, k=10, stats: StoredStats | None = None) -> DataFrame:
    """Recall per probe setting against exact search."""
    exact = settle(knn_join(queries, df, qid=qid, pk=pk, field=field, k=k, metric=cells.metric))
    curve = None
    for n in n_probes:
        found = ivf_knn(queries, index, cells, qid=qid, pk=pk, field=field, k=k, n_probe=n, stats=stats)
        row = recall_at_k(found, exact).select(F.lit(n).alias("n_probe"), "queries", "expected", "recall")
        curve = row if curve is None else curve.unionByName(row)
    return curve


def write_index(index: DataFrame, path: str, *, group: Column | None = None, columns: Sequence[str] | None = None) -> None:
    """Write an index table by cell, and beside it the statistics of its cells.

    A large cell is split over several files. ``group`` is the group of a row's key, if
    writes are to leave groups out later; ``columns`` are the scalar columns to sketch.
    """
    index.hint("rebalance", F.col("cell")).write.mode("errorifexists").partitionBy("cell").parquet(path)
    stored = index.sparkSession.read.parquet(path)
    StoredStats.of(stored, group, columns).write(f"{path}/{STATS}")


def read_index(spark: SparkSession, path: str, *, grouped: bool = False) -> tuple[DataFrame, StoredStats]:
    """An index table that :func:`write_index` wrote, and its statistics."""
    return spark.read.parquet(path), StoredStats.read(spark, f"{path}/{STATS}", grouped)

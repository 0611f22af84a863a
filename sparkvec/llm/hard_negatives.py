"""Hard negatives by threshold joins with an inverted index (after L2AP).

An anchor asks for its best rows of the same label (positives) and then, for each of
them, for the best rows of other labels whose score lies in a window below the
positive's. Scores are inner products of vectors whose components became integers.

Both searches are joins with a threshold for each anchor that starts high and is lowered,
in a fixed number of rounds, for those anchors alone that have not found enough; the last
round's threshold admits every row that may count, so results are exact.

Anchors and rows meet in tiles of bounded size, cut by hash, so a label with a third of
all rows is many tiles. In a tile the rows form an inverted index, dimension by
dimension, the most energetic first. A row is not indexed from the dimension on where the
norm of its remaining components, times the anchors', stays below every threshold.
Partial scores are accumulated over runs of dimensions; after each a pair goes whose
score plus the product of the remaining norms misses its threshold, and a row without
pairs leaves the index. The pairs that stay are verified in whole numbers. A tile returns
the few best of each anchor or window, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .vectors import matrix

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A window in percent of the positive's score.
LOW, HIGH = 50, 95
TILE, SMALL_TILE = 32_768, 2_048
#: Thresholds of the rounds: shares of the largest possible score; then everything.
REACH = (0.8, 0.5, 0.3, 0.15, None)
#: The same for windows: shares of the way from the low end up; 0 is all of it.
OPENED = (0.9, 0.6, 0)
#: Dimensions that are accumulated between two looks at the bounds; pairs at a time.
RUN, PAIRS = 16, 1 << 22
_EXACT = 2.0**53
_LONG = (1 << 63) - 1


def whole(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, exact; what a long cannot hold is cut to its ends."""
    if not a.size:
        return np.zeros(len(a), np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < _EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    sums = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)]
    return np.array([max(-_LONG - 1, min(_LONG, s)) for s in sums], np.int64)


def _tails(x: np.ndarray) -> np.ndarray:
    """Norms of the components from each dimension on; one more column of zeros."""
    squares = np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.column_stack([squares, np.zeros(len(x))]))


def pairs_above(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(anchor, row, score)`` of all pairs with at least the anchor's threshold."""
    step = max(1, PAIRS // max(1, len(rows)))
    with np.errstate(all="ignore"):
        order = np.argsort(-np.einsum("ij,ij->j", rows, rows), kind="stable")
        x, tails = rows[:, order], _tails(rows[:, order])
        for at in range(0, len(anchors), step):
            part = slice(at, at + step)
            a, t = anchors[part][:, order], least[part]
            p, r = _candidates(a, _tails(a), x, tails, t)
            for lo in range(0, len(p), PAIRS // 8):
                i, j = p[lo : lo + PAIRS // 8], r[lo : lo + PAIRS // 8]
                score = products(a[i], x[j])
                good = score >= t[i]
                yield i[good] + at, j[good], score[good]


def _candidates(a: np.ndarray, a_tails: np.ndarray, x: np.ndarray, x_tails: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, width = x.shape
    if not np.isfinite(a_tails[:, 0]).all() or not np.isfinite(x_tails[:, 0]).all():
        return np.divmod(np.arange(len(a) * n), n)
    # Rounding of sums and norms never costs a pair.
    least = least - 1e-9 * (np.abs(least) + a_tails[:, 0] * x_tails[:, 0].max(initial=0.0)) - 1e-6
    # A row is indexed up to the dimension from which on no anchor can reach its threshold.
    needed = np.where(a_tails > 0, least[:, None] / np.where(a_tails > 0, a_tails, 1.0), np.where(least > 0, np.inf, -np.inf)[:, None])
    cut = (x_tails >= needed.min(axis=0, initial=np.inf)).sum(axis=1)
    live = np.argsort(-cut, kind="stable")
    live = live[cut[live] > 0]
    partial = np.zeros((len(a), len(live)))
    for begin in range(0, width, RUN):
        end = min(begin + RUN, width)
        listed = int(np.searchsorted(-cut[live], -begin))  # rows are in order of their cut
        posted = np.where(np.arange(begin, end) < cut[live[:listed], None], x[live[:listed], begin:end], 0.0)
        partial[:, :listed] += a[:, begin:end] @ posted.T
        left = np.minimum(cut[live], end)
        bound = partial + a_tails[:, left] * x_tails[live, left]
        kept = np.flatnonzero((bound >= least[:, None]).any(axis=0))
        if len(kept) < len(live):
            live, partial = live[kept], partial[:, kept]
    left = np.minimum(cut[live], width)
    p, r = np.nonzero(partial + a_tails[:, left] * x_tails[live, left] >= least[:, None])
    return p, live[r]


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group, larger scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    starts = np.flatnonzero(np.append(True, g[1:] != g[:-1])[: len(g)])
    place = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    return order[place < k]


class _Best:
    """The first k hits of each group so far, each id once."""

    def __init__(self, k: int):
        self.k = k
        self.held = np.zeros((3, 0), np.int64)

    def add(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        held = np.concatenate([self.held, np.stack([group, score, ids]).astype(np.int64)], axis=1)
        held = held[:, np.lexsort((held[2], held[1], held[0]))]
        again = np.append(False, (held[:, 1:] == held[:, :-1]).all(axis=0))[: held.shape[1]]
        held = held[:, ~again]
        self.held = held[:, _first(held[0], held[1], held[2], self.k)]


_NEAR = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "positive_score")])
_FAR = pa.schema([(c, pa.int64()) for c in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")])


def _columns(t: pa.Table, *names: str) -> list[np.ndarray]:
    return [t[n].to_numpy() for n in names]


def _positives_of(k: int):
    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _NEAR.empty_table()
        (ids,), (own, least) = _columns(rows, "id"), _columns(anchors, "id", "least")
        best = _Best(k)
        for i, j, score in pairs_above(_block(anchors), _block(rows), least):
            other = ids[j] != own[i]
            best.add(i[other], score[other], ids[j][other])
        i, score, found = best.held
        return pa.Table.from_arrays([pa.array(own[i]), pa.array(found), pa.array(score)], schema=_NEAR)

    return tile


def _negatives_of(k: int):
    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if not rows.num_rows or not anchors.num_rows:
            return _FAR.empty_table()
        (ids, labels), (own, label) = _columns(rows, "id", "label"), _columns(anchors, "id", "label")
        # Windows of all anchors, one after the other.
        sizes = np.diff(anchors["windows"].combine_chunks().offsets.to_numpy())
        windows = anchors["windows"].combine_chunks().flatten()
        positive, value, low, high = (windows.field(c).to_numpy() for c in ("positive_id", "positive_score", "low", "high"))
        first = np.append(0, np.cumsum(sizes))
        least = np.minimum.reduceat(low, first[:-1])  # an anchor without windows is not sent
        best = _Best(k)
        for i, j, score in pairs_above(_block(anchors), _block(rows), least):
            other = labels[j] != label[i]
            i, j, score = i[other], j[other], score[other]
            for lo in range(0, len(i), PAIRS // 8):
                p, q, s = i[lo : lo + PAIRS // 8], j[lo : lo + PAIRS // 8], score[lo : lo + PAIRS // 8]
                w = first[p].repeat(sizes[p]) + _counted(sizes[p])
                q, s = q.repeat(sizes[p]), s.repeat(sizes[p])
                inside = (low[w] <= s) & (s <= high[w])
                best.add(w[inside], s[inside], ids[q[inside]])
        w, score, found = best.held
        anchor = own[np.searchsorted(first, w, side="right") - 1]
        return pa.Table.from_arrays([pa.array(c) for c in (anchor, positive[w], found, value[w], score)], schema=_FAR)

    return tile


def _counted(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _block(t: pa.Table) -> np.ndarray:
    return whole(matrix(t["vector"])).reshape(t.num_rows, -1)


def _in_tiles(rows: DataFrame, anchors: DataFrame, by: list[str], tile, schema: str) -> DataFrame:
    """``tile`` over all pairs of a block of rows and a block of anchors that agree in ``by``."""
    spread = 2 * rows.sparkSession.sparkContext.defaultParallelism
    n, m = (side.groupBy(*by).agg(F.count("*").alias("n")) for side in (rows, anchors))
    cuts = n.withColumnRenamed("n", "n_rows").join(m, by).select(
        *by,
        F.greatest(F.ceil(F.col("n_rows") / TILE), F.least(F.lit(spread), F.ceil(F.col("n_rows") / SMALL_TILE))).cast("int").alias("of_rows"),
        F.ceil(F.col("n") / TILE).cast("int").alias("of_anchors"),
    )

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        # Few rows, one for each length and label: Spark broadcasts it if it is small.
        placed = side.join(cuts, by)
        return placed.select(
            *by, *(c for c in side.columns if c not in by), F.pmod(F.xxhash64("id"), f"of_{own}").cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(f"of_{other}") - 1)).alias(other),
        )

    key = [*by, "rows", "anchors"]
    left, right = dealt(rows, "rows", "anchors"), dealt(anchors, "anchors", "rows").toDF(*(f"a_{c}" for c in dealt(anchors, "anchors", "rows").columns))
    back = right.columns

    def named(t: pa.Table) -> pa.Table:
        return t.rename_columns([c[2:] for c in back])

    return left.groupBy(*key).cogroup(right.groupBy(*(f"a_{c}" for c in key))).applyInArrow(lambda l, r: tile(l, named(r)), schema)


def mine(
    df: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label: str | Column = "label",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``is_anchor`` is a condition on ``id``. Rows with a null id or label, a null vector or a
    null or non-finite component take no part; vectors of different length never meet. A
    row is no partner of a row with its own id. Of rows that repeat an anchor's id the one
    with the smallest label, then vector, asks; rows that repeat an id with the same score
    are one answer. Positives and negatives go by score, then by smaller id; where there
    are fewer, all are returned, and an anchor without them has no rows. Scores are exact;
    beyond a long they are cut to its ends. Other columns are not looked at.
    """
    spark = df.sparkSession
    vector = F.col(vector_col)
    if dict(df.dtypes)[vector_col] != "array<float>":
        vector = vector.cast("array<double>")
    taken = df.select(F.col(id_col).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), vector.alias("vector"))
    finite = F.coalesce(F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))
    rows = settle(taken.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite).withColumn("dim", F.size("vector")))
    size = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.floor(SCALE * x.cast("double")).cast("double") * F.floor(SCALE * x.cast("double")).cast("double")))
    longest = rows.agg(F.max(size).alias("m")).first()["m"] or 0.0
    asking = rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vector", "dim")).alias("a")).select("id", "a.*")
    asking = settle(asking.withColumn("most", size * F.lit(longest)))

    open_, near = asking, None
    for share in REACH:
        least = F.lit(float("-inf")) if share is None else F.col("most") * share
        met = _in_tiles(rows, open_.withColumn("least", least), ["dim", "label"], _positives_of(positives), "anchor_id long, positive_id long, positive_score long")
        found = _ranked(met, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank")
        if share is None:
            near = found if near is None else near.unionByName(found)
            break
        found = settle(found)
        full = found.groupBy("anchor_id").agg(F.count("*").alias("n")).where(F.col("n") >= positives)
        done = found.join(full.select("anchor_id"), "anchor_id", "left_semi")
        near = done if near is None else near.unionByName(done)
        open_ = settle(open_.join(full.select(F.col("anchor_id").alias("id")), "id", "left_anti"))
        if not open_.limit(1).count():
            break

    # Whole numbers s with low * p <= 100 * s <= high * p, as decimals: products may pass a long.
    p = "cast(positive_score as decimal(20,0))"
    ends = near.select(
        "*",
        F.expr(f"cast(ceil({low} * {p} / 100) as long)").alias("bottom"),
        F.expr(f"cast(floor({high} * {p} / 100) as long)").alias("high"),
    )
    windows, found = settle(ends.where("bottom <= high")), None
    for share in OPENED:
        wide = "cast({} as decimal(20,0))".format
        cut = windows.withColumn("low", F.expr(f"cast(floor({wide('bottom')} + {share} * ({wide('high')} - {wide('bottom')})) as long)"))
        lists = cut.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score", "low", "high")).alias("windows"))
        met = _in_tiles(
            rows, asking.drop("most").join(lists, "id"), ["dim"], _negatives_of(negatives),
            "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long",
        )
        best = _ranked(met, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
        if not share:
            found = best if found is None else found.unionByName(best)
            break
        best = settle(best)
        full = best.groupBy("anchor_id", "positive_id").agg(F.count("*").alias("n")).where(F.col("n") >= negatives).drop("n")
        done = best.join(full, ["anchor_id", "positive_id"], "left_semi")
        found = done if found is None else found.unionByName(done)
        windows = settle(windows.join(full, ["anchor_id", "positive_id"], "left_anti"))
        if not windows.limit(1).count():
            break
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _ranked(hits: DataFrame, by: list[str], score: str, name: str, k: int) -> DataFrame:
    """The first k of each group over all tiles; a tile sent k at most."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(name))
    # Rows that repeat an id have one place.
    ranked = hits.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
    return ranked.dropDuplicates([*by, score, name])


SQL = f"""
WITH good AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM good a JOIN good b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""

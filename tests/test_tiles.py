"""Blocks of members and of queries: large joins send each row to few tiles, and pairs meet once."""

import numpy as np
import pytest

from sparkvec.functions.topk import Scorer
from sparkvec.operators import index as ivf
from sparkvec.operators import knn_join as joins
from sparkvec.operators import tiles


def world(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    block = rng.standard_normal((n, 6)) * rng.integers(1, 4, (n, 1))
    block[: n // 3] = block[0] + rng.standard_normal((n // 3, 6)) * 0.1
    block[40:60] = block[3]
    return block, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(block)], "id long, e array<double>").repartition(3)


def brute(block, metric, k):
    ip = block @ block.T
    norm = np.sqrt(np.diag(ip))
    score = {"l2": np.sqrt(((block[:, None] - block[None]) ** 2).sum(axis=2)), "ip": -ip, "cosine": 1 - ip / norm / norm[:, None]}[metric].round(9)
    return {(i, r + 1, j) for i in range(len(block)) for r, j in enumerate(np.lexsort((np.arange(len(block)), score[i]))[:k].tolist())}


def test_small_cells_share_a_block_and_large_ones_are_cut():
    blocks = tiles.Blocks(np.array([3, 0, 5, 40, 2, 2, 7]), 10)
    assert list(zip(blocks.low, blocks.high, strict=True)) == [(0, 3), (3, 4), (3, 4), (3, 4), (3, 4), (4, 6), (6, 7)]
    assert blocks.first.tolist() == [0, 0, 0, 1, 5, 5, 6] and blocks.parts.tolist() == [1, 0, 1, 4, 1, 1, 1]
    # A query of 256 small cells is copied three times, not 256 times.
    assert len(tiles.Blocks(np.full(256, 10), 1000)) == 3


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine"])
def test_plans_of_many_blocks_equal_brute_force(spark, monkeypatch, metric):
    block, df = world(spark)
    want = brute(block, metric, 5)
    monkeypatch.setattr(tiles, "LEAST_ROWS", 30)
    args = dict(qid="id", pk="id", field="e", k=5)
    pivot = joins.knn_join(df, df, metric=metric, strategy="pivot", pivots=40, **args)
    assert {(r.qid, r.rank, r.pk) for r in pivot.collect()} == want
    # A scan beyond the bound, and one whose queries are repeated or have no score.
    monkeypatch.setattr(joins, "BLOCK_BYTES", 8 * 6 * 50)
    scan = joins.knn_join(df, df, metric=metric, strategy="scan", **args)
    assert {(r.qid, r.rank, r.pk) for r in scan.collect()} == want
    short = df.selectExpr("id", "slice(e, 1, 5) as e")
    whole = joins.knn_join(df.unionByName(df).unionByName(short), df, metric=metric, strategy="scan", block_bytes=8 * 6 * 400, **args)
    assert {(r.qid, r.rank, r.pk) for r in whole.collect()} == want


@pytest.mark.parametrize("metric", ["l2", "ip"])
def test_a_query_of_all_cells_meets_each_row_once(spark, monkeypatch, metric):
    block, df = world(spark)
    cells = ivf.train_centroids(df, "e", n_list=7, n_iters=3, metric=metric)
    index = ivf.assign(df, "e", cells, soar=True).cache()
    met, count = [], len(block)
    tile, scan = ivf.tile_topk, ivf.probe_scan

    def seen(members, queries, n, counts, choose, **shape):
        mask = choose(block, None)
        met.append((mask[:, : len(counts)] @ counts).max())
        return tile(members, queries, n, counts, choose, **shape)

    def scanned(members, *a, **shape):
        met.append(members.count())
        return scan(members, *a, **shape)

    monkeypatch.setattr(ivf, "tile_topk", seen)
    monkeypatch.setattr(ivf, "probe_scan", scanned)
    monkeypatch.setattr(tiles, "LEAST_ROWS", 30)
    for block_bytes in (8 * 6 * 50, tiles.BLOCK_BYTES):
        got = ivf.ivf_knn(df, index, cells, qid="id", pk="id", field="e", k=5, n_probe=7, block_bytes=block_bytes)
        assert {(r.qid, r.rank, r.pk) for r in got.collect()} == brute(block, metric, 5)
    assert met == [count, count]
    # In some cells only, both places of a row count.
    few = [{(r.qid, r.rank, r.pk) for r in ivf.ivf_knn(df, index, cells, qid="id", pk="id", field="e", k=5, n_probe=2, block_bytes=b).collect()} for b in (8 * 6 * 50, tiles.BLOCK_BYTES)]
    assert few[0] == few[1]


@pytest.mark.parametrize("scale,shift", [(1, 0), (1, 1e5), (1e-18, 0), (1e180, 0)])
def test_scorer_ranks_in_double_what_single_precision_cannot(scale, shift):
    rng = np.random.default_rng(2)
    m, q = ((rng.standard_normal((n, 4)) + shift) * scale for n in (3000, 30))
    m[100:2000] = m[7]
    keys, cells, mask = rng.permutation(3000), rng.integers(0, 5, 3000), rng.random((30, 5)) < 0.6
    bound = np.full(30, np.nan)
    hits = Scorer("l2", q, 9, bound=bound).top(m, keys, cells=cells, mask=mask)
    want = set()
    for i, a in enumerate(q):
        total = np.zeros(3000)
        with np.errstate(over="ignore"):
            for x, y in zip(m.T, a, strict=True):
                total += (x - y) ** 2
            score = np.sqrt(total)
        inside = np.flatnonzero(mask[i, cells])
        want |= {(i, key) for key in keys[inside[np.lexsort((keys[inside], score[inside]))[:9]]].tolist()}
    assert set(zip(hits.query.tolist(), hits.key.tolist(), strict=True)) == want

"""Operators on vectors against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvec.llm import collision_ann, vector_dedup
from sparkvec.llm.components import components


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 24))
    rows = []
    for i in range(600):
        v = centres[i % 20] + rng.normal(size=24) * (0.2 if i % 3 else 1.0)
        rows.append((i, v.tolist()))
    rows += [(1000 + i, rows[1][1]) for i in range(300)]  # copies
    rows += [(2000, None), (2001, [0.0] * 24), (2002, [math.nan] * 24), (2003, [1.0, None] * 12), (2004, [math.inf] * 24), (2005, [1.0] * 7), (2006, [])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as id", "'x' as vector", "1 as links")


def good(v):
    return v is not None and len(v) == 24 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def test_near_duplicate_vectors(spark, vectors):
    data = {r.vec_id: r.embedding for r in vectors.collect()}
    ids = sorted(i for i, v in data.items() if good(v))
    x = np.array([data[i] for i in ids])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, True)
    label = np.arange(len(ids))
    while True:
        new = np.where(link, label[None, :], len(ids)).min(axis=1)
        if (new == label).all():
            break
        label = new
    want = {i: (int(link[k].sum()) - 1, ids[label[k]]) for k, i in enumerate(ids)}
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(vectors).collect()}
    assert len(got) == len(data)
    found = sum(n for n, _ in got.values())
    assert found <= sum(n for n, _ in want.values()) and found >= 0.999 * sum(n for n, _ in want.values())
    assert sum(got[i] == w for i, w in want.items()) >= 0.99 * len(want)
    assert all(got[i] == (0, i) for i in data if i not in want)
    assert vector_dedup.near_duplicates(vectors.where("false")).count() == 0


def test_tiles_give_the_same_links(vectors, monkeypatch):
    whole = sorted(vector_dedup.near_duplicates(vectors).collect())
    monkeypatch.setattr(vector_dedup, "TILE", 7)
    assert sorted(vector_dedup.near_duplicates(vectors).collect()) == whole


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(6).normal(size=(5, 32))
    assert np.allclose(np.linalg.norm(vector_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1) * math.sqrt(32))


def test_collision_counting_search(vectors):
    data = {r.vec_id: r.embedding for r in vectors.collect() if good(r.embedding)}
    ids = np.array(sorted(data))
    x = np.array([data[i] for i in ids])
    got = {}
    for r in collision_ann.search(vectors, F.col("id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hits = 0
    asked = [i for i in ids if i % 50 == 0]
    assert {i for i in got if i != 2005} == set(asked)
    for i in asked:
        far = np.sqrt(np.square(x - np.array(data[i])).sum(axis=1))
        far[ids == i] = np.inf
        best = np.lexsort((ids, far))[:10]
        mine = sorted(got[i])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert all(math.isclose(s, far[np.searchsorted(ids, v)]) for _, v, s in mine)
        assert [(s, v) for _, v, s in mine] == sorted((s, v) for _, v, s in mine)
        hits += len({m[1] for m in mine} & set(ids[best].tolist()))
    assert hits >= 0.95 * 10 * len(asked)
    assert collision_ann.search(vectors.where("false"), F.col("id") % 50 == 0).count() == 0
    few = collision_ann.search(vectors.where("vec_id in (0, 1, 2)"), F.col("id") == 0).collect()
    assert [r.rank for r in few] == [1, 2]


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (None, 3)] + [(200, k) for k in range(201, 260)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 51)} | {101: 100} | {k: 200 for k in range(201, 260)}


def test_tiny_huge_and_wide_vectors(spark):
    rows = [(1, [1e-200, 2e-200]), (2, [2.0, 1.0]), (3, [1e200, 2e200]), (4, [5e-324, 1e-323]), (5, [1.0, 2.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (3, 1), 3: (3, 1), 4: (3, 1), 5: (3, 1), 2: (0, 2)}
    wide = np.random.default_rng(8).normal(size=(2, 40_000))
    wide = [(i, (wide[i % 2] + 0.001 * i).tolist()) for i in range(4)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_dedup.near_duplicates(spark.createDataFrame(wide, "vec_id long, embedding array<double>")).collect()}
    assert got == {0: (1, 0), 2: (1, 0), 1: (1, 1), 3: (1, 1)}

"""Statistics of index cells: what they say, and that a search with them reads no more than it must."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkvec.operators import index as ivf
from sparkvec.operators.cell_stats import StoredStats, conjuncts, within

EVERY = dict(qid="id", pk="id", field="v")


def test_conditions_are_taken_apart():
    assert conjuncts("a = 1 and b in (1, 2) AND c between 3 and 4") == ["a = 1", "b in (1, 2)", "c between 3 and 4"]
    assert conjuncts("a = 'x and y' and not b") == ["a = 'x and y'", "not b"]
    assert conjuncts("a = 1 or b = 2 and c = 3") == ["a = 1 or b = 2 and c = 3"]
    assert conjuncts("(a = 1 or b = 2) and case when a = 1 and b = 1 then true else false end") == [
        "(a = 1 or b = 2)",
        "case when a = 1 and b = 1 then true else false end",
    ]
    assert within("a <= 5", "a", "lo", "hi", False) == "lo <= 5"
    assert within("5 < a", "a", "lo", "hi", False) == "hi > 5"
    assert within("a between -1 and 2.5", "a", "lo", "hi", False) == "lo <= 2.5 and hi >= -1"
    assert within("`a` = 'x'", "a", "lo", "hi", True) == "lo <= 'x' and hi >= 'x'"
    assert within("a = 9", "a", "lo", "hi", True) is None and within("a + 1 = 9", "a", "lo", "hi", False) is None


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """600 rows in 12 cells; ``few`` has 5 values, ``many`` one a row, ``home`` is the cell, ``note`` is long."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 6)) * 8
    rows = []
    for i in range(600):
        few = None if i % 7 == 0 else i % 5
        rows.append((i, (centres[i % 12] + rng.normal(size=6)).tolist(), few, i * 1.5, f"c{i % 12}", "x" * 200 + str(i)))
    df = spark.createDataFrame(rows, "id int, v array<double>, few int, many double, home string, note string").repartition(4)
    cells = ivf.Centroids(centres, "l2", 6)
    path = str(tmp_path_factory.mktemp("index") / "cells")
    ivf.write_index(ivf.assign(df, "v", cells), path)
    return df, cells, *ivf.read_index(spark, path)


FILTERS = {
    "few = 3": True, "few is null": True, "few is null or few > 2": True, "home = 'c3'": True, "home in ('c1', 'c2')": True,
    "lower(home) = 'c5'": True, "few = 3 and home = 'c3'": False, "many between 100 and 200": True, "many >= 899": True,
    "few = 1 and many < 30": False, "note like '%9'": False, "many + few > 800": False, "home = 'none'": True, "few * 2 = 4 and not home = 'c1'": False,
}


def test_bounds_hold(made):
    df, cells, table, stats = made
    rows = stats.load(cells.points).stats.count
    assert rows.sum() == df.where("v is not null").count()
    for condition, exact in FILTERS.items():
        found = stats.load(cells.points, condition, table.columns)
        real = np.zeros(len(cells.points) + 1, np.int64)
        for r in table.where(condition).groupBy("cell").count().collect():
            real[r["cell"]] = r["count"]
        assert (found.stats.count >= real).all() and (found.stats.count <= rows).all(), condition
        assert (found.stats.count[found.known] == real[found.known]).all(), condition
        assert not exact or found.known.all(), condition
    # Fifty rows a cell are few values; a column of more is bounded by its ends.
    assert stats.load(cells.points, F.col("few") == 3).stats.count.sum() == 600


def test_ends_exclude_cells(spark):
    rows = [(i, i % 3, float(i % 3 * 1000 + i % 700), f"{i % 3}-{i:05}") for i in range(3000)]
    index = spark.createDataFrame(rows, "id int, cell int, x double, s string").withColumn("distance", F.lit(0.0))
    stats, points = StoredStats.of(index), np.zeros((3, 2))
    for condition, want in (("x > 2500", [0, 0, 1000]), ("x between 700 and 1100", [0, 1000, 0]), ("x = 350", [1000, 0, 0]), ("s >= '2'", [0, 0, 1000]), ("s = '1-00004' and x < 99999", [0, 1000, 0])):
        got = stats.load(points, condition, index.columns)
        assert got.stats.count[:3].tolist() == want and got.known[:3].tolist() == [w == 0 for w in want], condition


def test_searches_agree_with_measured_counts(made):
    df, cells, table, stats = made
    asked = df.where("id % 20 = 0")
    for condition in (None, *FILTERS):
        for search, dial in ((ivf.ivf_knn, {"n_probe": 1}), (ivf.ann_knn, {"ef": 40})):
            plain = search(asked, table, cells, k=7, filter=condition, **dial, **EVERY).collect()
            stored = search(asked, table, cells, k=7, filter=condition, stats=stats, **dial, **EVERY).collect()
            assert sorted(stored) == sorted(plain), (condition, dial)
    tiles = ivf.ivf_knn(asked, table, cells, n_probe=2, stats=stats, filter="many < 500", block_bytes=6 * 8 * 10, **EVERY)
    local = ivf.ivf_knn(asked, table, cells, n_probe=2, stats=stats, filter="many < 500", **EVERY)
    assert sorted(tiles.collect()) == sorted(local.collect()) and local.count() == 300


def test_only_open_cells_are_counted(made, monkeypatch):
    df, cells, table, stats = made
    counts = stats.load(cells.points, "many + few > 0", table.columns)
    lifted = cells.lift_queries(cells.points[:1])
    asked = []

    class Passing:
        def where(self, condition):
            asked.append(str(condition))
            return table.where("many + few > 0").where(condition)

    settled = counts.settled(Passing(), lambda known: known.first_cells(lifted, 10))
    used = settled.first_cells(lifted, 10)
    assert len(asked) == 1 and used.sum() < 4
    real = {r["cell"]: r["count"] for r in table.where("many + few > 0").groupBy("cell").count().collect()}
    assert all(settled.count[c] == real[c] for c in np.flatnonzero(used[0]))


def test_no_shuffle_of_members(made):
    df, cells, table, stats = made
    found = ivf.ivf_knn(df.where("id % 20 = 0"), table, cells, n_probe=2, stats=stats, **EVERY)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "MapInArrow" in plan
    assert "PartitionFilters" in found._jdf.queryExecution().executedPlan().toString()

"""Trained cells, the nearest point by two levels, and document ids by offsets."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparkvec.functions import spaces
from sparkvec.operators import index as ivf
from sparkvec.operators import writes


@pytest.mark.parametrize("kind", ["clustered", "spread", "copies", "one"])
def test_two_levels_find_the_nearest(kind):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(500, 7))
    if kind == "clustered":
        points = points * 0.05 + rng.normal(size=(20, 7))[rng.integers(0, 20, 500)] * 10
    if kind == "copies":
        points[200:] = points[100]
    if kind == "one":
        points = points[:1]
    block = np.concatenate([points[:30] + 1e-3, rng.normal(size=(300, 7)) * 5, np.full((1, 7), np.inf), np.zeros((1, 7))])
    flat, deep = spaces.Nearest(points), spaces.Nearest(points, flat=0)
    assert flat.coarse is None and deep.coarse is not None
    (a, x), (b, y) = flat.find(block), deep.find(block)
    assert np.allclose(x, y, equal_nan=True) and a[-2] == b[-2] == len(points)
    same = np.isfinite(x)
    assert np.allclose(np.linalg.norm(block[same] - points[b[same]], axis=1), x[same], atol=1e-6)
    assert spaces.Nearest(points[:0]).find(block)[1].tolist() == [np.inf] * len(block)


def test_training_is_as_good_as_k_means(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(10, 8)) * 6
    rows = [(i, (centres[i % 10] + rng.normal(size=8)).tolist()) for i in range(3000)] + [(9000, None), (9001, [1.0] * 7), (9002, [float("nan")] * 8)]
    df = spark.createDataFrame(rows, "id int, v array<double>").repartition(5)

    def cost(points):
        cells = ivf.Centroids(points, "l2", 8)
        return ivf.assign(df.where("id < 9000"), "v", cells).agg(F.sum(F.col("distance") * F.col("distance"))).first()[0]

    model = KMeans(k=20, maxIter=10, seed=3).fit(df.where("id < 9000").select(array_to_vector("v").alias("features")))
    theirs = cost(np.array(model.clusterCenters()))
    whole = ivf.train_centroids(df, "v", n_list=20, n_iters=10)
    part = ivf.train_centroids(df, "v", n_list=20, n_iters=10, per_cell=40)
    assert len(whole.points) <= 20 and cost(whole.points) < 1.5 * theirs and cost(part.points) < 2 * theirs
    for metric in ("ip", "cosine", "mipsl2"):
        cells = ivf.train_centroids(df, "v", n_list=5, n_iters=3, metric=metric)
        assert cells.points.shape == (5, 8 if metric == "cosine" else 9) and np.isfinite(cells.points).all()
    assert len(ivf.train_centroids(df.where("id = 1"), "v", n_list=4).points) == 1
    assert len(ivf.train_centroids(df.where("false"), "v", n_list=4).points) == 0


def test_empty_cells_start_again(spark):
    sample = spark.createDataFrame([([0.0, float(i % 7)],) for i in range(70)] + [([90.0, 0.0],)], "v array<float>")
    points = np.array([[0.0, 3.0], [1000.0, 1000.0], [-1000.0, 0.0]])
    moved = ivf._round(sample, points, 2)
    assert np.allclose(moved[0], [90 / 71, 210 / 71]) and [90.0, 0.0] in moved.tolist()


def test_ids_are_dense_and_ordered(spark):
    df = spark.range(5000).selectExpr("cast(id as string) as id", "id as x").repartition(7)
    got = writes.assign_doc_ids(df, pk="id", start=10, digits=2).select("id", "x", "_doc_id")
    assert got.columns == ["id", "x", "_doc_id"]
    rows = got.withColumn("g", writes.key_group("id", 2)).orderBy("_doc_id").collect()
    assert [r["_doc_id"] for r in rows] == list(range(10, 5010))
    assert [(r["g"], r["id"]) for r in rows] == sorted((r["g"], r["id"]) for r in rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert writes.assign_doc_ids(df.where("false"), pk="id").count() == 0

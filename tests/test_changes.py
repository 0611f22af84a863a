"""Writes as change rows: what is stored, what is read, and what an index makes of it."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sparkvec import Collection, Field, Index, InvalidArgument, Schema
from sparkvec.operators import index as ivf
from sparkvec.sources import collection

SCHEMA = (
    Schema("c")
    .add("id", "string", primary_key=True)
    .add("v", "vector_fp32", dimension=3, nullable=True, index={"type": "flat", "metric": "l2"})
    .add("n", "int64", nullable=True)
)
LAYOUT = "id string, v array<float>, n long"


def vector(n):
    return [float(n % 13), float(n % 7), float(n)]


def frame(spark, rows):
    return spark.createDataFrame([(k, None if n is None else vector(n), n) for k, n in rows], LAYOUT)


def stored(c):
    return {r["id"]: r["n"] for r in c.scan().collect()}


def size(path, under=""):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(os.path.join(path, under)) for f in names if f.endswith(".parquet"))


def test_any_order_of_writes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(collection, "FOLD_AFTER", 4)
    rng, keys = random.Random(5), [f"k{i}" for i in range(40)]
    model = {k: i for i, k in enumerate(keys[:20])}
    c = Collection.create(spark, str(tmp_path / "c"), SCHEMA, frame(spark, model.items()))
    versions = {c.snapshot().version: dict(model)}
    for step in range(12):
        batch = {k: rng.randint(0, 99) for k in rng.sample(keys, 8)}
        kind = ("insert", "update", "upsert", "delete", "filter", "upsert")[step % 6]
        if kind == "insert":
            got = c.insert(frame(spark, batch.items()))
            want = {k: "already_exists" if k in model else "ok" for k in batch}
            model = batch | model
        elif kind == "update":
            got = c.update(spark.createDataFrame(list(batch.items()), "id string, n long"))
            want = {k: "ok" if k in model else "not_found" for k in batch}
            model |= {k: n for k, n in batch.items() if k in model}
        elif kind == "upsert":
            got, want = c.upsert(frame(spark, batch.items())), dict.fromkeys(batch, "ok")
            model |= batch
        elif kind == "delete":
            got = c.delete(spark.createDataFrame([(k,) for k in batch], "id string"))
            want = {k: "ok" if k in model else "not_found" for k in batch}
            model = {k: n for k, n in model.items() if k not in batch}
        else:
            c.delete_by_filter("n > 70")
            got, want, model = None, None, {k: n for k, n in model.items() if not n > 70}
        assert got is None or {r["pk"]: r["code"] for r in got.collect()} == want, (step, kind)
        assert stored(c) == model, (step, kind)
        versions[c.snapshot().version] = dict(model)
    ids = [r["_doc_id"] for r in c.scan(internal=True).collect()]
    assert len(set(ids)) == len(ids)
    assert len({p.split("/")[0] for p in c.snapshot().changes}) < 4
    for version, then in versions.items():  # earlier snapshots read as they were
        assert {r["id"]: r["n"] for r in c.scan(version).collect()} == then
    fetched = c.fetch(spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "pos int, id string"))
    assert {r["id"]: r["n"] for r in fetched.collect()} == model
    c.optimize(group_digits=2)
    assert stored(c) == model and c.snapshot().changes == () and c.snapshot().digits == 2
    c.delete(spark.createDataFrame([("k1",)], "id string"))
    c.add_column(Field("extra", "int32", nullable=True))
    c.drop_column("n")
    assert c.scan().columns == ["id", "v", "extra"] and c.scan().count() == len(set(model) - {"k1"})


def test_written_bytes_follow_the_batch(spark, tmp_path):
    n = 20_000
    c = Collection.create(spark, str(tmp_path / "c"), SCHEMA, spark.range(n).selectExpr(
        "cast(id as string) as id", "array(cast(rand(1) as float), cast(rand(2) as float), cast(id as float)) as v", "id as n"))
    before = size(c.path)
    for step, keys in enumerate(([50 * i for i in range(50)], [70 * i + 1 for i in range(50)], [n + i for i in range(50)])):
        c.upsert(frame(spark, [(str(k), -k) for k in keys]))
        assert size(c.path, "data") == before
        assert size(c.path, "changes") < (step + 1) * max(before / 4, 16 * 2500)
    c.delete(spark.createDataFrame([("7",)], "id string"))
    assert c.scan().count() == n + 49 and c.scan().where("n < 0").count() == 149
    c.optimize()
    assert c.scan().count() == n + 49 and c.scan().where("n < 0").count() == 149


@pytest.mark.parametrize("quantize", [None, "int8"])
def test_an_index_outlives_changes(spark, tmp_path, quantize):
    c = Collection.create(spark, str(tmp_path / "c"), SCHEMA, frame(spark, [(f"k{i}", i) for i in range(300)]))
    c.create_index("v", Index("ivf", metric="l2", n_list=6, n_iters=3, quantize=quantize))
    c.insert(frame(spark, [("new", 500)]))
    c.upsert(frame(spark, [("k5", 900), ("k6", None), ("more", 41)]))
    c.delete(spark.createDataFrame([("k7",), ("k41",)], "id string"))
    state = c._index_state(c.snapshot(), c.snapshot().indexes["v"])
    assert not state.rewritten and state.valid and state.changes
    for condition in (None, "n between 30 and 60", "n = 900", "n is null"):
        ask = dict(qid="id", k=4, filter=condition)
        queries = c.scan().where("v is not null")
        near = c.search_many(queries, "v", n_probe=6, scale_factor=50.0, **ask).collect()
        assert sorted(near) == sorted(c.search_many(queries, "v", linear=True, **ask).collect()), condition
    assert c.stats().where("metric = 'index_completeness'").first()["value"] < 1.0
    c.optimize()  # the cells are used again
    assert c.stats().where("metric = 'index_completeness'").first()["value"] == 1.0


def test_filters_name_current_columns(spark, tmp_path):
    c = Collection.create(spark, str(tmp_path / "c"), SCHEMA, frame(spark, [(f"k{i}", i) for i in range(30)]))
    c.create_index("v", Index("ivf", metric="l2", n_list=2, n_iters=2), keep=["n"])
    assert c.search_many(c.scan(), "v", qid="id", k=1, filter="n = 3").count() == 30
    c.drop_column("n")
    for dial in ({}, {"n_probe": 1}, {"linear": True}):
        with pytest.raises(InvalidArgument, match="unknown column"):
            c.search_many(c.scan(), "v", qid="id", k=1, filter="n = 3", **dial)
    with pytest.raises(InvalidArgument, match="unknown column"):
        c.search("v", vector(3), filter="n = 3", n_probe=1)


def test_hits_bring_fields_from_their_groups(spark, tmp_path):
    c = Collection.create(spark, str(tmp_path / "c"), SCHEMA, frame(spark, [(f"k{i}", i) for i in range(64)]))
    c.create_index("v", Index("ivf", metric="l2", n_list=4, n_iters=2))
    found = c.search("v", vector(9), k=1, n_probe=1)
    assert [(r["id"], r["n"]) for r in found.collect()] == [("k9", 9)]
    groups = {f.rsplit("_group=", 1)[1][0] for f in found.inputFiles() if "_group=" in f}
    assert len(groups) == 1
    ask = c.scan().where("id in ('k1', 'k2')")
    got = c.search_many(ask, "v", qid="id", k=2, n_probe=4, output_fields=["n"], include_vector=True, include_doc_id=True)
    assert got.columns == ["qid", "rank", "pk", "score", "n", "v", "_doc_id"]
    by_id = {r["id"]: r for r in c.scan(internal=True).collect()}
    assert got.count() == 4 and all((r["v"], r["_doc_id"], r["n"]) == (by_id[r["pk"]]["v"], by_id[r["pk"]]["_doc_id"], by_id[r["pk"]]["n"]) for r in got.collect())
    with pytest.raises(InvalidArgument):
        c.search_many(ask, "v", qid="id", output_fields=["nope"])


def test_cells_are_trained_again_when_norms_grow(spark, tmp_path):
    c = Collection.create(spark, str(tmp_path / "c"), SCHEMA, frame(spark, [(f"k{i}", i) for i in range(60)]))
    c.create_index("v", Index("ivf", metric="ip", n_list=4, n_iters=2))
    first = c.index("v")[1]
    c.optimize()
    assert (c.index("v")[1].points == first.points).all()
    c.insert(frame(spark, [("long", 10_000)]))
    c.optimize()
    assert c.index("v")[1].max_norm > first.max_norm
    assert ivf.PER_CELL * 4 > 61 and c.search("v", [0.0, 0.0, 1.0], k=1, metric="ip", n_probe=1).first()["id"] == "long"
    assert c.scan().agg(F.count("*")).first()[0] == 61


def test_column_changes_in_the_log(spark, tmp_path):
    c = Collection.create(spark, str(tmp_path / "c"), SCHEMA, frame(spark, [(f"k{i}", i) for i in range(80)]))
    c.create_index("v", Index("ivf", metric="l2", n_list=4, n_iters=2), keep=["n"])
    before, parts = size(c.path), c.snapshot().parts
    c.rename_column("n", "count")
    c.rename_column("v", "place")
    c.add_column(Field("note", "string", nullable=True))
    c.rename_column("id", "name")
    assert size(c.path) == before and c.snapshot().parts == parts
    assert c.scan().columns == ["name", "place", "count", "note"]
    assert c.scan().where("count = 7 and note is null").first()["name"] == "k7"
    assert c._index_state(c.snapshot(), c.snapshot().indexes["place"]).valid
    ask = dict(qid="name", k=3, filter="count between 10 and 40")
    near = c.search_many(c.scan(), "place", n_probe=4, **ask)
    assert sorted(near.collect()) == sorted(c.search_many(c.scan(), "place", linear=True, **ask).collect()) and near.count() == 240
    assert c.stats().where("metric = 'index_completeness'").first()["value"] == 1.0
    with pytest.raises(InvalidArgument):
        c.rename_column("count", "name")
    with pytest.raises(InvalidArgument):
        c.rename_column("n", "m")
    # A dropped column does not come back under its name, nor a renamed one under its old name.
    c.drop_column("count")
    c.add_column(Field("count", "int64", nullable=True))
    c.add_column(Field("n", "int64", nullable=True))
    assert c.scan().where("count is not null or n is not null").count() == 0
    c.upsert(spark.createDataFrame([("k1", vector(1), "new", 5, 6)], "name string, place array<float>, note string, count long, n long"))
    assert [tuple(r)[2:] for r in c.scan().where("name = 'k1'").select("name", "place", "note", "count", "n").collect()] == [("new", 5, 6)]
    c.optimize()
    assert c.snapshot().stored == {} and c.scan().where("n = 6").count() == 1 and c.scan().count() == 80
    assert c.search_many(c.scan(), "place", qid="name", k=1, n_probe=1).count() == 80

import re

import pytest
from pyspark.sql import functions as F

from sparkvec import AlreadyExists, Collection, Field, Index, InvalidArgument, NotFound, Schema
from sparkvec.operators import index as ivf
from sparkvec.operators.knn_join import knn_join
from sparkvec.streaming.upsert import apply_batch, streaming_upsert

SCHEMA = (
    Schema("test")
    .add("id", "string", primary_key=True)
    .add("embedding", "vector_fp32", dimension=4, nullable=True, index={"type": "flat", "metric": "l2"})
    .add("title", "string", nullable=True)
)
LAYOUT = "id string, embedding array<double>, title string"


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), LAYOUT)


def unit(i, title="t"):
    v = [0.0] * 4
    v[i % 4] = 1.0 + i
    return (f"doc-{i}", v, title)


@pytest.fixture
def made(spark, tmp_path):
    return Collection.create(spark, str(tmp_path / "c"), SCHEMA, docs(spark, *[unit(i) for i in range(5)]))


def titles(c):
    return {r["id"]: r["title"] for r in c.scan().collect()}


def codes(results):
    return sorted((r["pk"], r["code"]) for r in results.collect())


def test_lifecycle(spark, tmp_path, made):
    with pytest.raises(AlreadyExists):
        Collection.create(spark, made.path, SCHEMA)
    with pytest.raises(NotFound):
        Collection.open(spark, str(tmp_path / "none"))
    with pytest.raises(InvalidArgument):
        Collection.create(spark, str(tmp_path / "bad"), Schema("x"))
    again = Collection.open(spark, made.path)
    assert again.schema == SCHEMA and again.schema.pk == "id"
    assert again.scan().count() == 5
    empty = Collection.create(spark, str(tmp_path / "empty"), SCHEMA)
    assert empty.stats().first()["value"] == 0.0
    assert empty.scan().count() == 0


def test_documents(spark, made):
    assert codes(made.insert(docs(spark, unit(1, "again"), unit(7)))) == [
        ("doc-1", "already_exists"), ("doc-7", "ok"),
    ]
    assert titles(made)["doc-1"] == "t"
    patch = spark.createDataFrame([("doc-1", "patched"), ("doc-99", "x")], "id string, title string")
    assert codes(made.update(patch)) == [("doc-1", "ok"), ("doc-99", "not_found")]
    row = made.scan().where("id = 'doc-1'").first()
    assert row["title"] == "patched" and row["embedding"] == [0.0, 2.0, 0.0, 0.0]
    before = {r["id"]: r["_doc_id"] for r in made.scan(internal=True).collect()}
    assert codes(made.upsert(docs(spark, unit(1, "upserted"), unit(8)))) == [("doc-1", "ok"), ("doc-8", "ok")]
    after = {r["id"]: r["_doc_id"] for r in made.scan(internal=True).collect()}
    assert before.items() <= after.items() and len(set(after.values())) == len(after) == 7
    keys = spark.createDataFrame([("doc-8",), ("doc-8",), ("nope",)], "id string").coalesce(1)
    assert codes(made.delete(keys)) == [("doc-8", "not_found"), ("doc-8", "ok"), ("nope", "not_found")]
    made.delete_by_filter("title = 'upserted'")
    assert "doc-1" not in titles(made) and len(titles(made)) == 5
    request = spark.createDataFrame([(0, "doc-4"), (1, "zzz"), (2, "doc-0")], "pos int, id string")
    assert [r["id"] for r in made.fetch(request).collect()] == ["doc-4", "doc-0"]


def test_bad_documents_are_reported_not_stored(spark, made):
    bad = docs(spark, (None, [1.0] * 4, "x"), ("short", [1.0], "x"), unit(9))
    results = {r["pk"]: (r["code"], r["message"]) for r in made.insert(bad).collect()}
    assert results["doc-9"] == ("ok", "")
    assert results["short"] == ("invalid_argument", "vector field 'embedding' has dimension 1, expected 4")
    assert results[None] == ("invalid_argument", "primary key must be set")
    assert made.scan().count() == 6


def test_search(spark, made):
    hits = made.search("embedding", [1.0, 0.0, 0.0, 0.0], k=1).collect()
    assert [(r["id"], r["score"]) for r in hits] == [("doc-0", 0.0)]
    numbered = made.search("embedding", [1.0, 0.0, 0.0, 0.0], k=2, include_doc_id=True, filter="title = 't'")
    assert all(isinstance(r["_doc_id"], int) for r in numbered.collect())
    plain = made.search("embedding", [1.0, 0.0, 0.0, 0.0], k=3, include_vector=True)
    late = made.search("embedding", [1.0, 0.0, 0.0, 0.0], k=3, include_vector=True, late_fetch=True)
    assert plain.columns == late.columns and plain.collect() == late.collect()
    with pytest.raises(InvalidArgument):
        made.search("embedding", [1.0])
    with pytest.raises(InvalidArgument):
        made.search("title", [1.0] * 4)


def test_schema_changes(spark, made):
    made.add_column(Field("score", "double"), default="length(title) * 2.5")
    assert made.scan().first()["score"] == 2.5
    made.rename_column("score", "rank")
    failed = made.cast_column(Field("title", "int32", nullable=True))
    assert failed.count() == 5 and "title" in made.schema
    assert made.scan().where("title is null and rank = 2.5").count() == 5
    made.drop_column("rank")
    assert made.scan().columns == ["id", "embedding", "title"]
    made.add_column(Field("rank", "double", nullable=True))
    assert made.scan().where("rank is not null").count() == 0
    with pytest.raises(InvalidArgument):
        made.drop_column("id")
    # Earlier snapshots stay readable.
    assert made.scan(version=1).columns == ["id", "embedding", "title"]
    assert made.scan(version=1).where("title = 't'").count() == 5


def test_optimize_keeps_every_row(spark, tmp_path):
    small = SCHEMA.with_segment_size(2)
    c = Collection.create(spark, str(tmp_path / "o"), small, docs(spark, *[unit(i) for i in range(9)]), group_digits=0)
    c.insert(docs(spark, *[unit(i) for i in range(9, 13)]))
    before = c.scan().orderBy("id").collect()
    c.optimize(sort_by=["title"])
    assert c.scan().orderBy("id").collect() == before
    assert len(c.scan().inputFiles()) >= 7


def test_two_writers_cannot_share_a_version(spark, made):
    stale = made.snapshot()
    made.insert(docs(spark, unit(20)))
    with pytest.raises(AlreadyExists):
        made._append(stale, made._with_ids(made.scan(internal=True).drop("_doc_id").limit(0), stale))
    assert made.scan().count() == 6


def test_index_life(spark, tmp_path):
    rows = [unit(i) for i in range(40)]
    c = Collection.create(spark, str(tmp_path / "i"), SCHEMA, docs(spark, *rows))
    c.create_index("embedding", Index("ivf", metric="l2", n_list=4, n_iters=3, use_soar=True))
    assert {r["metric"]: r["value"] for r in c.stats().collect()} == {"doc_count": 40.0, "index_completeness": 1.0}
    c.insert(docs(spark, *[unit(i) for i in range(40, 50)]))
    assert {r["metric"]: r["value"] for r in c.stats().collect()}["index_completeness"] == 0.8
    c.optimize()
    assert {r["metric"]: r["value"] for r in c.stats().collect()}["index_completeness"] == 1.0
    table, cells = c.index("embedding")
    every = dict(qid="id", pk="id", field="embedding", k=3)
    full = ivf.ivf_knn(c.scan(), table, cells, n_probe=len(cells.points), **every)
    exact = knn_join(c.scan(), c.scan(), **every)
    assert set(full.collect()) == set(exact.collect())
    # Changes after the build: fresh rows are found, stale ones are not returned.
    c.insert(docs(spark, ("new", [50.0, 1.0, 0.0, 0.0], "n")))
    c.upsert(docs(spark, ("doc-4", [0.0, 0.0, 0.0, 77.0], "moved")))
    c.delete(spark.createDataFrame([("doc-8",)], "id string"))
    ask = dict(qid="id", k=3)
    got = c.search_many(c.scan(), "embedding", n_probe=len(cells.points), **ask)
    assert set(got.collect()) == set(c.search_many(c.scan(), "embedding", linear=True, **ask).collect())
    assert "doc-8" not in {r["pk"] for r in got.collect()}
    assert c.search_many(c.scan(), "embedding", ef=10, filter="title = 'n'", **ask).count() == c.scan().count()
    c.drop_index("embedding")
    assert c.schema["embedding"].index is None
    with pytest.raises(NotFound):
        c.index("embedding")
    assert c.search("embedding", [1.0, 0.0, 0.0, 0.0], k=1).first()["id"] == "doc-0"


@pytest.mark.parametrize("kind", ["fp16", "int8", "int4"])
def test_quantized_index(spark, tmp_path, kind):
    rows = [unit(i) for i in range(30)]
    c = Collection.create(spark, str(tmp_path / "q"), SCHEMA, docs(spark, *rows))
    c.create_index("embedding", Index("ivf", metric="l2", n_list=3, n_iters=3, quantize=kind))
    table, cells = c.index("embedding")
    assert "embedding" not in table.columns and table.count() == 30
    ask = dict(qid="id", k=1)
    # Enough candidates: the original vectors give every document itself.
    hits = c.search_many(c.scan(), "embedding", n_probe=len(cells.points), scale_factor=10.0, **ask)
    assert all(r["qid"] == r["pk"] and r["score"] == 0.0 for r in hits.collect()) and hits.count() == 30


# -- approximate search ------------------------------------------------------------


@pytest.fixture(scope="module")
def world(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "label", "embedding")
    df = df.cache()
    cells = ivf.train_centroids(df, "embedding", n_list=8, n_iters=3, metric="cosine")
    return df, cells, ivf.assign(df, "embedding", cells).cache()


EVERY = dict(qid="vec_id", pk="vec_id", field="embedding", k=5)


def test_assignment_is_nearest_and_whole(world):
    import numpy as np

    df, cells, table = world
    rows = table.collect()
    assert len(rows) == df.count()
    for r in rows[:50]:
        x = cells.lift(np.array([r["embedding"]], dtype=float))
        gap = np.sqrt(((x - cells.points) ** 2).sum(axis=1))
        assert r["cell"] == gap.argmin() and abs(gap.min() - r["distance"]) < 1e-9


def test_recall_grows_to_one(world):
    df, cells, table = world
    exact = knn_join(df, df, metric="cosine", **EVERY).cache()
    seen = []
    for n in (1, 3, len(cells.points)):
        found = ivf.ivf_knn(df, table, cells, n_probe=n, **EVERY)
        seen.append(ivf.recall_at_k(found, exact).first()["recall"])
    assert seen == sorted(seen) and seen[-1] == 1.0 and seen[0] > 0.2
    whole = ivf.ann_knn(df, table, cells, ef=df.count(), **EVERY)
    assert ivf.recall_at_k(whole, exact).first()["recall"] == 1.0
    # Tiles of a few rows give the same hits as one tile per cell.
    tiny = ivf.ivf_knn(df, table, cells, n_probe=3, block_bytes=64 * 8 * 20, **EVERY)
    assert set(tiny.collect()) == set(ivf.ivf_knn(df, table, cells, n_probe=3, **EVERY).collect())


def test_soar_copies_go_elsewhere_and_never_repeat(world):
    df, cells, _ = world
    spilled = ivf.assign(df, "embedding", cells, soar=True).cache()
    per_key = spilled.groupBy("vec_id").agg(F.count("*").alias("n"), F.countDistinct("cell").alias("c"))
    assert per_key.where("n = 2 and c = 2").count() == df.count()
    found = ivf.ivf_knn(df, spilled, cells, n_probe=3, **EVERY)
    assert found.groupBy("qid", "pk").count().where("count > 1").count() == 0
    assert found.groupBy("qid").count().where("count > 5").count() == 0


def test_adaptive_and_single_query(world):
    df, cells, table = world
    q = [0.1] * 64
    args = dict(pk="vec_id", field="embedding")
    few = ivf.knn_adaptive(df, table, cells, q, filter="label = 2", ratio=0.5, **args).collect()
    many = ivf.knn_adaptive(df, table, cells, q, filter="label = 2", ratio=0.0, **args).collect()
    linear = ivf.ivf_knn_one(table, cells, q, linear=True, filter="label = 2", **args).collect()
    assert few == many == linear and len(few) == 10


def test_probe_list_prunes_partitions(spark, world, tmp_path):
    df, cells, table = world
    ivf.write_index(table, str(tmp_path / "x"))
    stored = spark.read.parquet(str(tmp_path / "x"))
    text = ivf.ivf_knn_one(stored, cells, [0.1] * 64, pk="vec_id", field="embedding", n_probe=2)
    physical = text._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "PartitionFilters: [isnotnull(cell" in physical or "PartitionFilters: [cell" in physical


# -- streaming -----------------------------------------------------------------------

USERS = Schema("users").add("id", "string", primary_key=True).add("v", "int32", nullable=True).add("at", "int64")


def test_replayed_batch_changes_nothing(spark, tmp_path):
    c = Collection.create(spark, str(tmp_path / "u"), USERS)
    batch = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "id string, v int, at bigint")
    assert apply_batch(c, batch, 0, name="s", order=["at"])
    version = c.snapshot().version
    assert not apply_batch(c, batch, 0, name="s", order=["at"])
    assert c.snapshot().version == version
    assert [tuple(r) for r in c.scan().collect()] == [("a", 2, 2)]


def test_late_batches_do_not_set_back(spark, tmp_path):
    c = Collection.create(spark, str(tmp_path / "u"), USERS)
    new = spark.createDataFrame([("a", 2, 9)], "id string, v int, at bigint")
    old = spark.createDataFrame([("a", 1, 3), ("b", 1, 3)], "id string, v int, at bigint")
    apply_batch(c, new, 0, name="s", order=["at"])
    apply_batch(c, old, 1, name="s", order=["at"])
    assert sorted(tuple(r) for r in c.scan().collect()) == [("a", 2, 9), ("b", 1, 3)]


def test_stream_resumes(spark, tmp_path):
    source, point = str(tmp_path / "in"), str(tmp_path / "cp")
    c = Collection.create(spark, str(tmp_path / "u"), USERS)

    def run():
        stream = spark.readStream.schema("id string, v int, at bigint").parquet(source)
        streaming_upsert(stream, c, name="s", order=["at"], checkpoint=point).awaitTermination()

    spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "id string, v int, at bigint").write.parquet(source)
    run()
    spark.createDataFrame([("a", 5, 5)], "id string, v int, at bigint").write.mode("append").parquet(source)
    run()
    assert sorted(tuple(r) for r in c.scan().collect()) == [("a", 5, 5), ("b", 1, 1)]


def test_create_refuses_records_it_cannot_store(spark, tmp_path):
    schema = Schema("c").add("id", "string", primary_key=True).add("v", "vector_fp32", dimension=2)
    rows = [("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", [1.0]), (None, [1.0, 1.0]), ("c", [2.0, 2.0])]
    records = spark.createDataFrame(rows, "id string, v array<float>")
    with pytest.raises(InvalidArgument):
        Collection.create(spark, str(tmp_path / "a"), schema, records)
    with pytest.raises(NotFound):
        Collection.open(spark, str(tmp_path / "a"))
    made = Collection.create(spark, str(tmp_path / "b"), schema, records, rejects="report")
    assert made.load_results.count() == 5 and made.load_results.where("code = 'ok'").count() == 2
    assert made.scan().count() == 2


def test_a_new_checkpoint_is_a_new_run(spark, tmp_path):
    schema = Schema("c").add("id", "string", primary_key=True).add("n", "int64")
    made = Collection.create(spark, str(tmp_path / "c"), schema)
    for run in ("one", "two"):
        source = str(tmp_path / run)
        spark.createDataFrame([(run, 1)], "id string, n long").write.parquet(source)
        stream = spark.readStream.schema("id string, n long").parquet(source)
        streaming_upsert(stream, made, name="s", order=["n"], checkpoint=str(tmp_path / f"check-{run}")).awaitTermination()
    assert {r.id for r in made.scan().collect()} == {"one", "two"}


def test_writes_judge_nulls_and_sparse_vectors(spark, tmp_path):
    schema = (
        Schema("c")
        .add("id", "string", primary_key=True)
        .add("n", "int32")
        .add("s", "sparse_vector_fp32", dimension=10, nullable=True)
    )
    made = Collection.create(spark, str(tmp_path / "c"), schema)
    kind = "id string, n int, s struct<indices: array<bigint>, values: array<float>>"
    rows = [("a", 1, None), ("b", 2, ([5, 1, 1], [1.0] * 3)), ("c", 3, ([-3], [1.0])), ("d", 4, ([1, 2], [1.0])), ("e", 5, ([0, 9], [1.0, 2.0]))]
    for write in (made.insert, made.upsert):
        codes = {r.pk: r.code for r in write(spark.createDataFrame(rows, kind)).collect()}
        assert {k for k, c in codes.items() if c == "invalid_argument"} == {"b", "c", "d"}
    changed = made.update(spark.createDataFrame([("a", None), ("e", 9)], "id string, n int")).collect()
    assert {r.pk: r.code for r in changed} == {"a": "invalid_argument", "e": "ok"}
    assert {r.id: r.n for r in made.scan().collect()} == {"a": 1, "e": 9}


def test_index_state_after_writes(spark, tmp_path):
    rows = [(str(i), [float(i % 5), float(i)]) for i in range(40)]
    schema = Schema("c").add("id", "string", primary_key=True).add("v", "vector_fp32", dimension=2, index={"type": "ivf", "metric": "l2", "n_list": 4})
    made = Collection.create(spark, str(tmp_path / "c"), schema, spark.createDataFrame(rows, "id string, v array<float>"))
    made.create_index("v", Index("ivf", metric="l2", n_list=4, n_iters=2))

    def share():
        return made.stats().where("metric = 'index_completeness'").first()["value"]

    assert share() == 1.0
    made.update(spark.createDataFrame(rows, "id string, v array<float>"))
    assert share() == 0.0


def test_tiled_cells_are_pruned(spark, tmp_path):
    df = spark.createDataFrame([(i, [float(i % 7), float(i)]) for i in range(200)], "pk long, v array<double>")
    cells = ivf.train_centroids(df, "v", n_list=8, n_iters=2)
    ivf.write_index(ivf.assign(df, "v", cells), str(tmp_path / "x"))
    stored = spark.read.parquet(str(tmp_path / "x"))
    found = ivf.ivf_knn(df.limit(3), stored, cells, qid="pk", pk="pk", field="v", k=2, n_probe=1, block_bytes=16 * 8)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*cell#\d+ (IN \(|= )", plan)

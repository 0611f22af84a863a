import pytest

from sparkvec import Field, InvalidArgument
from sparkvec.operators import ddl, writes
from sparkvec.operators.fetch import fetch, missing_keys


def table(spark, rows, schema="id string, title string, n int"):
    return spark.createDataFrame(rows, schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def base(spark):
    return table(spark, [("a", "one", 1), ("b", "two", 2), ("c", None, 3)]).cache()


def codes(result):
    return sorted((r["pk"], r["code"]) for r in result.results.fillna("-", ["pk"]).collect())


def test_insert(spark, base):
    batch = table(spark, [("a", "x", 9), ("d", "first", 4), ("d", "second", 5), (None, "none", 0)])
    done = writes.insert(base, batch.coalesce(1), pk="id")
    assert codes(done) == [
        ("-", "invalid_argument"), ("a", "already_exists"), ("d", "already_exists"), ("d", "ok"),
    ]
    assert rows(done.snapshot.where("id in ('a', 'd')")) == [("a", "one", 1), ("d", "first", 4)]
    summary = writes.write_summary(done.results).first()
    assert (summary["success"], summary["errors"]) == (1, 3)
    assert done.results.columns == ["pk", "op", "code", "message"]


def test_update_patches(spark, base):
    batch = table(spark, [("a", "new"), ("a", "newer"), ("z", "x")], "id string, title string").coalesce(1)
    done = writes.update(base, batch, pk="id")
    assert codes(done) == [("a", "ok"), ("a", "ok"), ("z", "not_found")]
    assert rows(done.snapshot) == [("a", "newer", 1), ("b", "two", 2), ("c", None, 3)]


def test_update_with_presence(spark, base):
    batch = table(
        spark,
        [("a", None, 7, ["n"]), ("b", None, None, ["title"])],
        "id string, title string, n int, _present array<string>",
    )
    assert rows(writes.update(base, batch, pk="id").snapshot) == [
        ("a", "one", 7), ("b", None, 2), ("c", None, 3),
    ]


def test_upsert_last_wins_and_is_idempotent(spark, base):
    batch = table(spark, [("a", "x", 1), ("a", "y", 2), ("d", "z", 3)]).coalesce(1)
    once = writes.upsert(base, batch, pk="id").snapshot
    assert rows(once) == [("a", "y", 2), ("b", "two", 2), ("c", None, 3), ("d", "z", 3)]
    assert rows(writes.upsert(once, batch, pk="id").snapshot) == rows(once)


def test_order_column_decides(spark, base):
    batch = table(spark, [("d", "late", 9), ("d", "early", 1)]).repartition(2)
    assert rows(writes.dedupe_first(batch, pk="id", order=["n"])) == [("d", "early", 1)]
    assert rows(writes.upsert(base, batch, pk="id", order=["n"]).snapshot.where("id = 'd'")) == [("d", "late", 9)]


def test_delete_undoes_insert(spark, base):
    batch = table(spark, [("d", "x", 4), ("e", "y", 5)])
    grown = writes.insert(base, batch, pk="id").snapshot
    done = writes.delete(grown, batch.select("id"), pk="id")
    assert rows(done.snapshot) == rows(base)
    again = writes.delete(base, table(spark, [("a",), ("a",), ("q",)], "id string").coalesce(1), pk="id")
    assert codes(again) == [("a", "not_found"), ("a", "ok"), ("q", "not_found")]


def test_delete_by_filter_keeps_unknown(base):
    assert rows(writes.delete_by_filter(base, "title = 'two'")) == [("a", "one", 1), ("c", None, 3)]
    with pytest.raises(InvalidArgument):
        writes.delete_by_filter(base, "no_such = 1")


def test_empty_batches(spark, base):
    none = base.where("id = '?'")
    for op in (writes.insert, writes.update, writes.upsert):
        done = op(base, none, pk="id")
        assert rows(done.snapshot) == rows(base) and done.results.count() == 0
    assert rows(writes.insert(none, base, pk="id").snapshot) == rows(base)


def test_counts_add_up(spark, base):
    batch = table(spark, [("a", "x", 1), (None, "x", 1), ("q", "x", 1), ("q", "x", 1)])
    for op in (writes.insert, writes.update, writes.upsert):
        s = writes.write_summary(op(base, batch, pk="id").results).first()
        assert s["success"] + s["errors"] == 4


def test_merge_presence_decides(spark):
    first = table(spark, [("a", "one", 1), ("b", "two", 2)])
    second = spark.createDataFrame(
        [("a", None, ["title"]), ("b", None, []), ("c", "new", ["title"])],
        "id string, title string, _present array<string>",
    )
    merged = writes.merge_records(first, second, pk="id")
    assert rows(merged.select("id", "title", "n")) == [("a", None, 1), ("b", "two", 2), ("c", "new", None)]


def test_merge_across_a_type_conflict(spark):
    first = table(spark, [("a", 1)], "id string, v int")
    second = table(spark, [("a", "x")], "id string, v string")
    assert rows(writes.merge_records(first, second, pk="id").select("id", "v")) == [("a", "x")]


def test_doc_ids_are_dense(spark):
    df = spark.range(1000).selectExpr("cast(id as string) as id").repartition(7)
    got = sorted(r["_doc_id"] for r in writes.assign_doc_ids(df, pk="id", start=50).collect())
    assert got == list(range(50, 1050))


def test_fetch_keeps_request_order(spark, base):
    keys = spark.createDataFrame([(0, "c"), (1, "a"), (2, "nope"), (3, "c")], "pos int, id string")
    assert [(r["pos"], r["id"]) for r in fetch(base, keys, pk="id").collect()] == [(0, "c"), (1, "a"), (3, "c")]
    assert [r["id"] for r in missing_keys(base, keys, pk="id").collect()] == ["nope"]


def test_ddl(spark, base):
    added = ddl.add_column(base, Field("m", "int32"), default="n * 10")
    assert rows(added.select("id", "m")) == [("a", 10), ("b", 20), ("c", 30)]
    assert ddl.add_column(base, Field("m", "double", nullable=True)).where("m is null").count() == 3
    with pytest.raises(InvalidArgument):
        ddl.add_column(base, Field("m", "int32"))
    with pytest.raises(InvalidArgument):
        ddl.add_column(base, Field("n", "int32", nullable=True))
    with pytest.raises(InvalidArgument):
        ddl.add_column(base, Field("m", "int32"), default="(select 1)")
    assert ddl.drop_column(base, "title").columns == ["id", "n"]
    assert ddl.rename_column(base, "n", "count").columns == ["id", "title", "count"]
    with pytest.raises(InvalidArgument):
        ddl.rename_column(base, "n", "title")
    cast, bad = ddl.cast_column(base, Field("title", "int64", nullable=True))
    assert cast.where("title is null").count() == 3 and bad.count() == 2


def test_hot_key_is_reduced_before_the_shuffle(spark, base):
    text = writes.dedupe_last(base, pk="id")._jdf.queryExecution().toString()
    physical = text.split("== Physical Plan ==")[1]
    assert physical.count("WindowGroupLimit") == 2

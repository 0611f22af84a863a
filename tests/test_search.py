import math

import numpy as np
import pytest

from sparkvec import InvalidArgument
from sparkvec.functions import predicates
from sparkvec.operators import search
from sparkvec.operators.knn_join import knn_join
from sparkvec.operators.writes import assign_doc_ids

# Four unit vectors whose expected neighbours are known.
UNIT = [
    ("doc-1", [1.0, 0.0, 0.0, 0.0], "science"),
    ("doc-2", [0.0, 1.0, 0.0, 0.0], "tech"),
    ("doc-3", [0.0, 0.0, 1.0, 0.0], "science"),
    ("doc-4", [0.0, 0.0, 0.0, 1.0], "art"),
]
Q = [1.0, 0.0, 0.0, 0.0]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(UNIT, "id string, embedding array<float>, category string").cache()


def ids(df):
    return [r["id"] for r in df.collect()]


@pytest.mark.parametrize("engine", ["arrow", "sql"])
def test_top_k(docs, engine):
    assert ids(search.knn(docs, "embedding", Q, pk="id", k=1, engine=engine)) == ["doc-1"]
    # The other three tie: the key decides.
    assert ids(search.knn(docs, "embedding", Q, pk="id", k=3, engine=engine)) == ["doc-1", "doc-2", "doc-3"]
    assert len(ids(search.knn(docs, "embedding", Q, pk="id", k=99, engine=engine))) == 4


def test_filter_and_fields(docs):
    hits = search.knn(docs, "embedding", Q, pk="id", filter="category = 'art'")
    assert hits.columns == ["id", "score", "category"]
    assert [r["category"] for r in hits.collect()] == ["art"]
    assert search.knn(docs, "embedding", Q, pk="id", output_fields=["id"]).columns == ["id", "score"]
    with_vector = search.knn(docs, "embedding", Q, pk="id", k=1, include_vector=True).first()
    assert with_vector["embedding"] == Q
    numbered = assign_doc_ids(docs, pk="id")
    hit = search.knn(numbered, "embedding", Q, pk="id", k=1, include_doc_id=True).first()
    assert isinstance(hit["_doc_id"], int)
    with pytest.raises(InvalidArgument):
        search.knn(docs, "embedding", Q, pk="id", include_doc_id=True)
    with pytest.raises(InvalidArgument):
        search.knn(docs, "embedding", Q, pk="id", k=0)
    with pytest.raises(InvalidArgument):
        search.knn(docs, "embedding", Q, pk="id", metric="manhattan")
    with pytest.raises(InvalidArgument):
        search.knn(docs, "nope", Q, pk="id")


ODD = [
    ("a-null", None),
    ("b-short", [1.0, 2.0]),
    ("c-zero", [0.0, 0.0, 0.0]),
    ("d-nan", [math.nan, 0.0, 0.0]),
    ("e-inf", [math.inf, 0.0, 0.0]),
    ("f-hole", [None, 0.0, 0.0]),
    ("g", [1.0, 2.0, 2.0]),
    ("h", [1.0, 2.0, 2.0]),
    ("i", [-3.0, 0.5, 1.0]),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "id string, e array<double>").cache()


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine", "mipsl2"])
def test_unusable_vectors_never_enter(odd, metric):
    q = [0.5, 1.0, 0.0]
    arrow = search.knn(odd, "e", q, pk="id", metric=metric).collect()
    assert arrow == search.knn(odd, "e", q, pk="id", metric=metric, engine="sql").collect()
    got = [r["id"] for r in arrow]
    assert not {"a-null", "b-short", "d-nan", "f-hole"} & set(got)
    assert ("c-zero" in got) == (metric != "cosine")
    assert got.index("g") < got.index("h")


def test_empty_collection(spark, odd):
    none = odd.where("id = 'zzz'")
    for metric in ("l2", "ip", "cosine", "mipsl2"):
        assert search.knn(none, "e", [1.0, 0.0, 0.0], pk="id", metric=metric).count() == 0
        assert knn_join(odd, none, qid="id", pk="id", field="e", metric=metric).count() == 0


def test_radius_is_inclusive(docs):
    near = search.knn(docs, "embedding", Q, pk="id", radius=0.0)
    assert ids(near) == ["doc-1"]
    assert ids(search.knn(docs, "embedding", Q, pk="id", metric="ip", radius=1.0)) == ["doc-1"]


def test_mipsl2_orders_like_ip(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(
        [(f"{i:03d}", (rng.normal(size=6) * (1 + i % 5)).tolist()) for i in range(120)], "id string, e array<double>"
    )
    q = rng.normal(size=6).tolist()
    assert ids(search.knn(df, "e", q, pk="id", metric="ip", k=120)) == ids(
        search.knn(df, "e", q, pk="id", metric="mipsl2", k=120)
    )


# -- joins against brute force -----------------------------------------------


def brute(queries, members, k, metric):
    top = max((math.sqrt(sum(x * x for x in v)) for _, v in members), default=0.0)
    out = []
    for qid, q in queries:
        scored = []
        for pk, v in members:
            ip = sum(a * b for a, b in zip(v, q))
            nv, nq = math.sqrt(sum(a * a for a in v)), math.sqrt(sum(b * b for b in q))
            if metric == "l2":
                s = math.sqrt(sum((a - b) ** 2 for a, b in zip(v, q)))
            elif metric == "ip":
                s = ip
            elif metric == "cosine":
                if nv * nq == 0:
                    continue
                s = 1 - ip / (nv * nq)
            else:
                s = math.sqrt(max(0.0, top * top + nq * nq - 2 * ip))
            scored.append((-s if metric == "ip" else s, pk))
        out += [(qid, n + 1, pk) for n, (_, pk) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def small_world():
    """Clusters, a hot group of identical vectors (a third of the rows), zeros, ties.

    Halves only, so that sums are exact and ties are real ties.
    """
    rng = np.random.default_rng(7)
    centers = np.round(rng.normal(size=(5, 4)) * 6) / 2
    rows = [centers[i % 5] + np.round(rng.normal(size=4) * 2) / 2 for i in range(160)]
    rows += [np.array([1.0, 1.0, 0.0, 0.0])] * 100 + [np.zeros(4)] * 10
    return [(f"m{i:04d}", r.tolist()) for i, r in enumerate(rows)]


@pytest.mark.parametrize("metric", ["l2", "ip", "cosine", "mipsl2"])
def test_both_join_plans_equal_brute_force(spark, metric):
    members = small_world()
    queries = [("q" + pk, v) for pk, v in members[::6]]
    m = spark.createDataFrame(members, "pk string, e array<double>").repartition(3)
    q = spark.createDataFrame(queries, "qid string, e array<double>")
    want = brute(queries, members, 7, metric)
    args = dict(qid="qid", pk="pk", field="e", k=7, metric=metric)
    for options in (
        dict(strategy="scan"),
        dict(strategy="pivot", pivots=8, block_bytes=4 * 8 * 40),
        # Over the bound: the size check itself picks the pivot plan.
        dict(strategy="auto", pivots=5, block_bytes=4 * 8 * 16),
    ):
        got = sorted((r["qid"], r["rank"], r["pk"]) for r in knn_join(q, m, **args, **options).collect())
        assert got == want, options
    with pytest.raises(InvalidArgument):
        knn_join(q, m, strategy="scan", block_bytes=4 * 8 * 16, **args)


def test_join_with_filter_and_odd_rows(spark, odd):
    want = knn_join(odd, odd, qid="id", pk="id", field="e", k=3, filter="id > 'c'").collect()
    pivot = knn_join(odd, odd, qid="id", pk="id", field="e", k=3, filter="id > 'c'", strategy="pivot").collect()
    assert {tuple(r) for r in want if r["qid"] != "e-inf"} == {tuple(r) for r in pivot if r["qid"] != "e-inf"}
    assert all(r["pk"] > "c" for r in want)
    assert not {"a-null", "b-short", "f-hole"} & {r["qid"] for r in want}


def test_repeated_query_ids_fold(spark, docs):
    twice = docs.unionByName(docs)
    for strategy in ("scan", "pivot"):
        hits = knn_join(twice, docs, qid="id", pk="id", field="embedding", k=2, strategy=strategy)
        assert hits.count() == 8


# -- predicate text ------------------------------------------------------------


@pytest.mark.parametrize(
    "text",
    [
        "category = 'art'",
        "category == \"it's (select) fine\"",
        "id in ('doc-1', 'doc-2') and not category like 'a%'",
        "category is null or length(id) between 1 and 10e2",
        "`category` <> 'x' and array_contains(array(id, category), 'doc-1')",
        "cast(length(id) as int) >= 1",
    ],
)
def test_plain_predicates_pass(docs, text):
    predicates.where(docs, text).count()


@pytest.mark.parametrize(
    "text",
    [
        "reflect('java.lang.System', 'exit', '1') = ''",
        "java_method('java.lang.System', 'nanoTime') > 0",
        "id in (select id from other)",
        "exists (select 1)",
        "other_column = 1",
        "`other column` = 1",
        "id = 1 -- comment",
        "id = 1; drop table x",
        "id = ${spark.secret}",
        "",
        "input_file_name() = ''",
        "id in (table other)",
        r"category = r'\' or reflect('java.lang.System', 'exit', '1') = ''",
        "category = 'x''y'",
        "`id'` = 1 or reflect('x') = `'id`",
    ],
)
def test_other_predicates_are_refused(docs, text):
    with pytest.raises(InvalidArgument):
        predicates.where(docs, text)


# -- plans -----------------------------------------------------------------------


def plan_text(df):
    return df._jdf.queryExecution().toString()


def test_search_plan_prunes_and_pushes(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    text = plan_text(search.knn(base, "embedding", [0.1] * 64, pk="vec_id", filter="label = 3", output_fields=["vec_id"]))
    assert "TakeOrderedAndProject" in text
    assert "EqualTo(label,3)" in text
    assert "Exchange" not in text.split("== Physical Plan ==")[1]


def test_join_plans_have_no_cross_join(spark, docs):
    for strategy in ("scan", "pivot"):
        text = plan_text(knn_join(docs, docs, qid="id", pk="id", field="embedding", k=2, strategy=strategy))
        physical = text.split("== Physical Plan ==")[1]
        assert "CartesianProduct" not in physical and "NestedLoopJoin" not in physical
        assert "WindowGroupLimit" in physical

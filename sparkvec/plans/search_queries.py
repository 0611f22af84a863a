"""Search, filters, projections, lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.predicates import where
from ..operators import search
from ..operators.fetch import fetch, missing_keys
from ..operators.knn_join import knn_join
from ..operators.writes import assign_doc_ids
from ..sources.records import null_profile
from . import shared
from .registry import Tables, query
from .shared import QUERY, articles, join_sql, knn_sql, rounded, vectors


def _flat(metric: str):
    def plan(spark, folder):
        df = vectors(Tables(spark, folder))
        return rounded(search.knn(df, "e", QUERY, pk="vec_id", metric=metric))

    return plan


for _metric in ("l2", "ip", "cosine", "mipsl2"):
    query(f"knn_flat_{_metric}", knn_sql(_metric))(_flat(_metric))


@query("knn_filtered", knn_sql("ip", where="label = 3"))
def knn_filtered(spark, folder):
    df = vectors(Tables(spark, folder))
    return rounded(search.knn(df, "e", QUERY, pk="vec_id", metric="ip", filter="label = 3"))


@query("knn_top_100", knn_sql("cosine", k=100))
def knn_top_100(spark, folder):
    df = vectors(Tables(spark, folder))
    return rounded(search.knn(df, "e", QUERY, pk="vec_id", metric="cosine", k=100))


@query("knn_scoring_in_sql", knn_sql("l2", k=25))
def knn_scoring_in_sql(spark, folder):
    df = vectors(Tables(spark, folder))
    return rounded(search.knn(df, "e", QUERY, pk="vec_id", metric="l2", k=25, engine="sql"))


@query("knn_output_fields", knn_sql("cosine", columns="lang", source="a"))
def knn_output_fields(spark, folder):
    hits = search.knn(
        articles(Tables(spark, folder)),
        "e",
        QUERY,
        pk="vec_id",
        metric="cosine",
        output_fields=["lang"],
    )
    return rounded(hits)


@query("knn_all_scalar_fields", knn_sql("l2", columns="label, lang, source, n_chars", source="a"))
def knn_all_scalar_fields(spark, folder):
    df = articles(Tables(spark, folder))
    return rounded(search.knn(df, "e", QUERY, pk="vec_id", metric="l2"))


@query(
    "knn_include_vector",
    knn_sql("l2", columns="label, len(e)::INTEGER AS vector_size, round(list_sum(e), 6) AS vector_sum"),
)
def knn_include_vector(spark, folder):
    df = vectors(Tables(spark, folder))
    hits = search.knn(df, "e", QUERY, pk="vec_id", metric="l2", include_vector=True)
    return shared.measured(rounded(hits), "e")


@query(
    "knn_include_doc_id",
    f"""WITH {shared.VECTORS_SQL}, {shared.QUERY_SQL},
    n AS (SELECT *, row_number() OVER (ORDER BY substr(md5(vec_id::VARCHAR), 1, 3), vec_id) - 1 AS doc_id FROM v),
    s AS (SELECT *, list_distance(e, q) AS s FROM n, q)
    SELECT vec_id, round(s, 6) AS score, label, doc_id::BIGINT AS doc_id FROM s ORDER BY s, vec_id LIMIT 10""",
)
def knn_include_doc_id(spark, folder):
    df = assign_doc_ids(vectors(Tables(spark, folder)), pk="vec_id")
    hits = search.knn(df, "e", QUERY, pk="vec_id", metric="l2", include_doc_id=True)
    return rounded(hits).withColumnRenamed(search.DOC_ID, "doc_id")


@query("knn_radius", knn_sql("cosine", where="s <= 0.9", k=50))
def knn_radius(spark, folder):
    df = vectors(Tables(spark, folder))
    return rounded(search.knn(df, "e", QUERY, pk="vec_id", metric="cosine", k=50, radius=0.9))


@query("knn_radius_ip", knn_sql("ip", where="s >= 2.0", k=1000))
def knn_radius_ip(spark, folder):
    df = vectors(Tables(spark, folder))
    return rounded(search.knn(df, "e", QUERY, pk="vec_id", metric="ip", k=1000, radius=2.0))


def _join(metric: str, **options):
    def plan(spark, folder):
        df = vectors(Tables(spark, folder))
        return rounded(knn_join(df, df, qid="vec_id", pk="vec_id", field="e", metric=metric, **options))

    return plan


query("knn_join", join_sql("l2"))(_join("l2"))
query("knn_join_cosine", join_sql("cosine"))(_join("cosine"))
query("knn_join_mipsl2", join_sql("mipsl2"))(_join("mipsl2"))
# The plan for query sides beyond the broadcast bound, on the same input.
query("knn_join_pivot_l2", join_sql("l2"))(_join("l2", strategy="pivot", pivots=32))
query("knn_join_pivot_ip", join_sql("ip"))(_join("ip", strategy="pivot", pivots=32))


# -- filters -----------------------------------------------------------------


@query("filter_equality", "SELECT doc_id, lang, source FROM documents WHERE lang = 'de'")
def filter_equality(spark, folder):
    return where(Tables(spark, folder).documents, "lang == 'de'").select("doc_id", "lang", "source")


@query(
    "filter_range",
    "SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_retailprice BETWEEN 905 AND 1200 AND p_size < 20",
)
def filter_range(spark, folder):
    part = Tables(spark, folder).part
    return where(part, "p_retailprice between 905 and 1200 and p_size < 20").select(
        "p_partkey", "p_size", "p_retailprice"
    )


@query(
    "filter_in",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus != 'F'",
)
def filter_in(spark, folder):
    orders = Tables(spark, folder).orders
    return where(orders, "o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus != 'F'").select(
        "o_orderkey", "o_orderpriority"
    )


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring' OR p_name LIKE 'red%'")
def filter_like(spark, folder):
    part = Tables(spark, folder).part
    return where(part, "p_name like '%ring' or p_name like 'red%'").select("p_partkey", "p_name")


def _judged_documents(t: Tables):
    return t.documents.drop("text").join(t.labels, "doc_id", "left")


_JUDGED_SQL = (
    "j AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic"
    " FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
)


@query(
    "filter_null",
    f"WITH {_JUDGED_SQL} SELECT doc_id, quality FROM j WHERE toxic IS NULL OR quality = 1",
)
def filter_null(spark, folder):
    df = _judged_documents(Tables(spark, folder))
    return where(df, "toxic is null or quality = 1").select("doc_id", "quality")


@query(
    "filter_array_contains",
    "SELECT doc_id FROM documents WHERE list_contains([lang, source], 'es') OR list_contains([lang, source], 'src3')",
)
def filter_array_contains(spark, folder):
    df = Tables(spark, folder).documents.withColumn("tags", F.array("lang", "source"))
    return where(df, "array_contains(tags, 'es') or array_contains(tags, 'src3')").select("doc_id")


@query(
    "select_forward_fields", "SELECT vec_id::VARCHAR AS id, label FROM embeddings"
)
def select_forward_fields(spark, folder):
    return search.select_fields(shared.embedding_collection(Tables(spark, folder)), "forward")


@query("select_vector_fields", f"SELECT {shared.measured_sql('embedding')} FROM embeddings")
def select_vector_fields(spark, folder):
    df = search.select_fields(shared.embedding_collection(Tables(spark, folder)), "vector")
    return shared.measured(df, "embedding")


@query("select_indexed_fields", f"SELECT label, {shared.measured_sql('embedding')} FROM embeddings")
def select_indexed_fields(spark, folder):
    df = search.select_fields(shared.embedding_collection(Tables(spark, folder)), "indexed")
    return shared.measured(df, "embedding")


@query(
    "null_profile",
    f"WITH {_JUDGED_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM j"
        for c in ("doc_id", "lang", "source", "n_chars", "quality", "toxic")
    ),
)
def null_profile_query(spark, folder):
    return null_profile(_judged_documents(Tables(spark, folder)))


# -- key lookups ---------------------------------------------------------------


def _requests(t: Tables):
    """Every conversation turn asks for the label of one document, latest first."""
    return t.conversations.select(
        (-(F.col("conv_id") * 1000 + F.col("turn"))).alias("pos"), F.col("conv_id").alias("doc_id")
    )


_REQUESTS_SQL = "r AS (SELECT -(conv_id * 1000 + turn) AS pos, conv_id AS doc_id FROM conversations)"


@query(
    "fetch_by_keys",
    f"WITH {_REQUESTS_SQL} SELECT r.doc_id, pos, quality, toxic FROM r JOIN labels l ON l.doc_id = r.doc_id ORDER BY pos",
)
def fetch_by_keys(spark, folder):
    t = Tables(spark, folder)
    return fetch(t.labels, _requests(t), pk="doc_id")


@query(
    "fetch_missing_keys",
    f"WITH {_REQUESTS_SQL} SELECT doc_id, pos FROM r WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def fetch_missing_keys(spark, folder):
    t = Tables(spark, folder)
    return missing_keys(t.labels, _requests(t), pk="doc_id")

"""Inputs several registered queries share, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import Schema, stamp
from .registry import Tables

DIMENSION = 64

# One fixed query vector, the argument a caller would pass.
QUERY = [((i * 37) % 101) / 50 - 1 for i in range(DIMENSION)]
QUERY_SQL = "q AS (SELECT list(((i * 37) % 101)::DOUBLE / 50 - 1 ORDER BY i) AS q FROM range(64) r(i))"


def vectors(t: Tables) -> DataFrame:
    """All embeddings, stretched row by row so that the four metrics disagree
    (as given, every vector has norm 1)."""
    stretch = 1 + F.col("vec_id") % 7
    return t.embeddings.select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double") * stretch).alias("e")
    )


VECTORS_SQL = (
    "v AS (SELECT vec_id, label, [x::DOUBLE * (1 + vec_id % 7) for x in embedding] AS e FROM embeddings)"
)


def articles(t: Tables) -> DataFrame:
    """Embeddings with the scalar facts of the document of the same number."""
    return vectors(t).join(
        t.documents.select(F.col("doc_id").alias("vec_id"), "lang", "source", "n_chars"), "vec_id", "left"
    )


ARTICLES_SQL = (
    VECTORS_SQL
    + ", a AS (SELECT v.*, d.lang, d.source, d.n_chars FROM v LEFT JOIN documents d ON d.doc_id = v.vec_id)"
)

SCORE_SQL = {
    "l2": "list_distance(e, q)",
    "ip": "list_inner_product(e, q)",
    "cosine": "list_cosine_distance(e, q)",
    "mipsl2": (
        "sqrt(greatest(0, (SELECT max(list_inner_product(e, e)) FROM v)"
        " + list_inner_product(q, q) - 2 * list_inner_product(e, q)))"
    ),
}


def knn_sql(metric: str, columns: str = "label", where: str = "true", k: int = 10, source: str = "v") -> str:
    """Exact top-k against the fixed query vector."""
    with_ = VECTORS_SQL if source == "v" else ARTICLES_SQL
    direction = "DESC" if metric == "ip" else "ASC"
    return (
        f"WITH {with_}, {QUERY_SQL}, s AS (SELECT *, {SCORE_SQL[metric]} AS s FROM {source}, q)"
        f" SELECT vec_id, round(s, 6) AS score, {columns} FROM s WHERE {where}"
        f" ORDER BY s {direction}, vec_id LIMIT {k}"
    )


def join_sql(metric: str, k: int = 10) -> str:
    """Exact k nearest of every vector, by brute force."""
    score = SCORE_SQL[metric].replace("(e, q)", "(b.e, a.e)").replace("(q, q)", "(a.e, a.e)")
    direction = "DESC" if metric == "ip" else "ASC"
    return (
        f"WITH {VECTORS_SQL}, s AS (SELECT a.vec_id AS qid, b.vec_id AS pk, {score} AS s FROM v a, v b),"
        f" r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s {direction}, pk) AS n FROM s)"
        f" SELECT qid, n::INTEGER AS rank, pk, round(s, 6) AS score FROM r WHERE n <= {k}"
    )


def rounded(df: DataFrame, *names: str) -> DataFrame:
    for name in names or ("score",):
        df = df.withColumn(name, F.round(name, 6))
    return df


EMBEDDING_SCHEMA = (
    Schema("embeddings")
    .add("id", "string", primary_key=True)
    .add("label", "int32", nullable=True, index="invert")
    .add(
        "embedding",
        "vector_fp32",
        dimension=DIMENSION,
        index={"type": "ivf", "metric": "cosine", "n_list": 16, "n_iters": 5},
    )
)


def embedding_records(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").cast("string").alias("id"), "label", "embedding")


def embedding_collection(t: Tables) -> DataFrame:
    return stamp(embedding_records(t), EMBEDDING_SCHEMA)


def measured(df: DataFrame, field: str) -> DataFrame:
    """Replace a vector column by numbers any engine can compare."""
    total = F.aggregate(field, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return df.withColumn("vector_size", F.size(field)).withColumn("vector_sum", F.round(total, 6)).drop(field)


def measured_sql(column: str) -> str:
    return f"len({column})::INTEGER AS vector_size, round(list_sum([x::DOUBLE for x in {column}]), 6) AS vector_sum"

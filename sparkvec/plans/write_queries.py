"""Writes, merges, schema changes and validation over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sparse
from ..operators import ddl, stats, writes
from ..schema import Field, Schema, stamp
from ..sources.records import conform_records, export_records, validate_records
from ..session import scratch_path
from ..streaming.upsert import latest_per_key
from . import shared
from .registry import Tables, query

# -- writes: labels are the base, documents the batch ---------------------------


def _batch(t: Tables):
    return t.documents.select(
        "doc_id",
        (F.col("n_chars") % 2).cast("int").alias("quality"),
        (F.col("n_chars") % 3).cast("int").alias("toxic"),
    )


_BATCH = (
    "b AS (SELECT doc_id, (n_chars % 2)::INTEGER AS quality, (n_chars % 3)::INTEGER AS toxic FROM documents)"
)


def _turns(t: Tables):
    """A batch with many rows per key: one per conversation turn."""
    return t.conversations.select(
        F.col("conv_id").alias("doc_id"), F.length("text").alias("quality"), F.col("turn").cast("int").alias("toxic")
    )


_TURNS = "c AS (SELECT conv_id AS doc_id, length(text)::INTEGER AS quality, turn::INTEGER AS toxic FROM conversations)"


@query(
    "dedupe_batch_first",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1",
)
def dedupe_batch_first(spark, folder):
    return writes.dedupe_first(Tables(spark, folder).events, pk="user_id", order=["ts", "event_id"])


_LATEST = "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query("dedupe_batch_last", _LATEST)
def dedupe_batch_last(spark, folder):
    return writes.dedupe_last(Tables(spark, folder).events, pk="user_id", order=["ts", "event_id"])


@query(
    "latest_per_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id DESC) = 1",
)
def latest(spark, folder):
    """The top event by value of each user and type: a key of two columns."""
    events = Tables(spark, folder).events.withColumn("key", F.struct("user_id", "event_type"))
    return latest_per_key(events, pk="key", order=["value", "event_id"]).drop("key")


@query(
    "insert_snapshot",
    f"WITH {_BATCH} SELECT * FROM labels UNION ALL SELECT * FROM b WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def insert_snapshot(spark, folder):
    t = Tables(spark, folder)
    return writes.insert(t.labels, _batch(t), pk="doc_id").snapshot


@query(
    "insert_results",
    f"""WITH {_BATCH} SELECT doc_id AS pk, 'insert' AS op,
    CASE WHEN l.doc_id IS NULL THEN 'ok' ELSE 'already_exists' END AS code,
    CASE WHEN l.doc_id IS NULL THEN '' ELSE 'document already exists' END AS message
    FROM b LEFT JOIN labels l USING (doc_id)""".replace("l.doc_id IS NULL", "l.quality IS NULL"),
)
def insert_results(spark, folder):
    t = Tables(spark, folder)
    return writes.insert(t.labels, _batch(t), pk="doc_id").results


@query(
    "insert_repeated_keys",
    f"""WITH {_TURNS}, f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY toxic) AS n FROM c)
    SELECT * FROM labels UNION ALL
    SELECT doc_id, quality, toxic FROM f WHERE n = 1 AND doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def insert_repeated_keys(spark, folder):
    t = Tables(spark, folder)
    return writes.insert(t.labels, _turns(t), pk="doc_id", order=["toxic"]).snapshot


@query(
    "insert_repeated_results",
    f"""WITH {_TURNS}, f AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY toxic) AS n FROM c),
    h AS (SELECT f.*, f.doc_id IN (SELECT doc_id FROM labels) AS held FROM f)
    SELECT doc_id AS pk, 'insert' AS op, CASE WHEN held OR n > 1 THEN 'already_exists' ELSE 'ok' END AS code,
    CASE WHEN held THEN 'document already exists' WHEN n > 1 THEN 'document repeated in batch' ELSE '' END AS message
    FROM h""",
)
def insert_repeated_results(spark, folder):
    t = Tables(spark, folder)
    return writes.insert(t.labels, _turns(t), pk="doc_id", order=["toxic"]).results


@query(
    "write_summary",
    """SELECT count(*) FILTER (WHERE l.doc_id IS NULL) AS success, count(l.doc_id) AS errors
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def write_summary(spark, folder):
    t = Tables(spark, folder)
    return writes.write_summary(writes.insert(t.labels, _batch(t), pk="doc_id").results)


@query(
    "update_snapshot",
    f"""WITH {_BATCH} SELECT l.doc_id, coalesce(b.quality, l.quality) AS quality, l.toxic
    FROM labels l LEFT JOIN b ON b.doc_id = l.doc_id""",
)
def update_snapshot(spark, folder):
    t = Tables(spark, folder)
    return writes.update(t.labels, _batch(t).drop("toxic"), pk="doc_id").snapshot


@query(
    "update_results",
    """SELECT d.doc_id AS pk, 'update' AS op, CASE WHEN l.doc_id IS NULL THEN 'not_found' ELSE 'ok' END AS code,
    CASE WHEN l.doc_id IS NULL THEN 'document not found' ELSE '' END AS message
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def update_results(spark, folder):
    t = Tables(spark, folder)
    return writes.update(t.labels, _batch(t), pk="doc_id").results


@query(
    "upsert_snapshot",
    f"""WITH {_TURNS}, f AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY toxic DESC) = 1)
    SELECT * FROM f UNION ALL SELECT * FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM f)""",
)
def upsert_snapshot(spark, folder):
    t = Tables(spark, folder)
    return writes.upsert(t.labels, _turns(t), pk="doc_id", order=["toxic"]).snapshot


@query("upsert_results", "SELECT conv_id AS pk, 'upsert' AS op, 'ok' AS code, '' AS message FROM conversations")
def upsert_results(spark, folder):
    t = Tables(spark, folder)
    return writes.upsert(t.labels, _turns(t), pk="doc_id", order=["toxic"]).results


def _page_keys(t: Tables):
    return t.pages.select(F.col("page_id").alias("doc_id"))


@query("delete_by_keys", "SELECT * FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)")
def delete_by_keys(spark, folder):
    t = Tables(spark, folder)
    return writes.delete(t.labels, _page_keys(t), pk="doc_id").snapshot


@query(
    "delete_results",
    """SELECT page_id AS pk, 'delete' AS op, CASE WHEN l.doc_id IS NULL THEN 'not_found' ELSE 'ok' END AS code,
    CASE WHEN l.doc_id IS NULL THEN 'document not found' ELSE '' END AS message
    FROM pages LEFT JOIN labels l ON l.doc_id = page_id""",
)
def delete_results(spark, folder):
    t = Tables(spark, folder)
    return writes.delete(t.labels, _page_keys(t), pk="doc_id").results


@query(
    "delete_by_filter",
    """SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    WHERE NOT coalesce(l.toxic = 1 OR (d.lang = 'de' AND l.quality = 0), false)""",
)
def delete_by_filter(spark, folder):
    t = Tables(spark, folder)
    base = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    # Unlabelled documents have an unknown predicate and stay.
    return writes.delete_by_filter(base, "toxic = 1 or (lang = 'de' and quality = 0)")


@query(
    "merge_records",
    """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id,
      CASE WHEN l.quality = 1 THEN NULL ELSE d.lang END AS lang, d.n_chars, l.toxic,
      CASE WHEN l.doc_id IS NULL THEN 'lang,n_chars' ELSE 'lang,n_chars,toxic' END AS present
    FROM documents d FULL OUTER JOIN labels l ON l.doc_id = d.doc_id""",
)
def merge_records(spark, folder):
    t = Tables(spark, folder)
    first = t.documents.select("doc_id", "lang", "n_chars")
    # Good labels carry an explicit null language, the others carry none.
    carried = F.when(F.col("quality") == 1, F.array(F.lit("lang"), F.lit("toxic"))).otherwise(F.array(F.lit("toxic")))
    second = t.labels.select("doc_id", F.lit(None).cast("string").alias("lang"), "toxic", carried.alias("_present"))
    merged = writes.merge_records(first, second, pk="doc_id")
    return merged.select("*", F.array_join("_present", ",").alias("present")).drop("_present")


# -- schema changes --------------------------------------------------------------


@query("add_column_default", "SELECT *, p_retailprice * p_size + 1 AS stock_value FROM part")
def add_column_default(spark, folder):
    field = Field("stock_value", "double")
    return ddl.add_column(Tables(spark, folder).part, field, default="p_retailprice * p_size + 1")


@query("drop_column", "SELECT * EXCLUDE (text) FROM documents")
def drop_column(spark, folder):
    return ddl.drop_column(ddl.drop_column(Tables(spark, folder).documents, "text"), "no_such_field")


@query("rename_column", "SELECT * RENAME (p_name AS title) FROM part")
def rename_column(spark, folder):
    return ddl.rename_column(Tables(spark, folder).part, "p_name", "title")


@query(
    "cast_column",
    "SELECT event_id, ts, user_id, event_type, TRY_CAST(trunc(value) AS INTEGER) AS value, props FROM events",
)
def cast_column(spark, folder):
    return ddl.cast_column(Tables(spark, folder).events, Field("value", "int32", nullable=True))[0]


@query(
    "cast_column_errors",
    "SELECT * FROM nation WHERE TRY_CAST(n_name AS DOUBLE) IS NULL AND n_name IS NOT NULL",
)
def cast_column_errors(spark, folder):
    return ddl.cast_column(Tables(spark, folder).nation, Field("n_name", "double", nullable=True))[1]


# -- records ---------------------------------------------------------------------

_PART_SCHEMA = (
    Schema("parts")
    .add("key", "string", primary_key=True)
    .add("size", "int64")
    .add("price", "float")
    .add("stock", "uint64", nullable=True)
)


@query(
    "conform_records",
    """SELECT p_partkey::VARCHAR AS key, p_size::BIGINT AS size, p_retailprice::FLOAT::DOUBLE AS price,
    NULL::DECIMAL(20, 0) AS stock, CASE WHEN p_size < 10 THEN 'field ''stock'' cannot be read as uint64' END AS problem
    FROM part""",
)
def conform(spark, folder):
    raw = Tables(spark, folder).part.select(
        F.col("p_partkey").alias("key"),
        F.col("p_size").cast("string").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_size") < 10, F.lit("many")).alias("stock"),
        F.col("p_brand").alias("not_declared"),
    )
    done = conform_records(raw, _PART_SCHEMA, errors="problem")
    return done.withColumn("price", F.col("price").cast("double"))


@query("export_records", "SELECT vec_id::VARCHAR AS id, label FROM embeddings")
def export(spark, folder):
    """Out as JSON lines and in again: the declared facts are gone, the data is not."""
    plain = export_records(shared.embedding_collection(Tables(spark, folder)), ["id", "label"])
    path = scratch_path(spark, "export")
    plain.write.json(path)
    return spark.read.schema(plain.schema).json(path)


_CHECKED = Schema("checked").add("id", "string", primary_key=True).add(
    "embedding", "vector_fp32", dimension=64
).add("title", "string").add("score", "double").add("terms", "sparse_vector_fp32", dimension=60, nullable=True)


@query(
    "validate_records",
    """WITH r AS (SELECT e.*, d.lang FROM embeddings e LEFT JOIN documents d ON d.doc_id = e.vec_id)
    SELECT vec_id, CASE WHEN label = 0 THEN 'primary key must be set'
      WHEN label = 1 THEN 'required field ''embedding'' is missing'
      WHEN lang IS NULL OR lang = 'de' THEN 'required field ''title'' is missing'
      WHEN label = 2 THEN 'vector field ''embedding'' has dimension 65, expected 64'
      WHEN label = 3 THEN 'vector field ''embedding'' has a null element'
      WHEN last_one IS NOT NULL AND last_one >= 60
        THEN 'vector field ''terms'' has index ' || last_one || ', expected below 60' END AS error
    FROM r LEFT JOIN (SELECT vec_id, max(i) AS last_one FROM (
      SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
      WHERE abs(x) > 0.2::FLOAT GROUP BY vec_id) m USING (vec_id)""",
)
def validate(spark, folder):
    t = Tables(spark, folder)
    label, e = F.col("label"), F.col("embedding")
    longer = F.concat(e, F.array(F.lit(0.0).cast("float")))
    holed = F.transform(e, lambda x, i: F.when(i != 5, x))
    raw = t.embeddings.join(t.documents.select(F.col("doc_id").alias("vec_id"), "lang"), "vec_id", "left").select(
        "vec_id",
        F.when(label != 0, F.col("vec_id").cast("string")).alias("id"),
        F.when(label == 1, F.lit(None)).when(label == 2, longer).when(label == 3, holed).otherwise(e).alias("embedding"),
        F.when(F.col("lang") != "de", F.col("lang")).alias("title"),
        label.cast("double").alias("score"),
        sparse.from_dense("embedding", lambda x: F.abs(x) > F.lit(0.2).cast("float")).alias("terms"),
    )
    return validate_records(raw, _CHECKED).select("vec_id", "error")


# -- counts and reports ----------------------------------------------------------


@query("stats_doc_count", "SELECT count(*) AS doc_count FROM documents")
def stats_doc_count(spark, folder):
    return stats.doc_count(Tables(spark, folder).documents)


@query(
    "stats_index_completeness",
    """SELECT round(avg(CASE WHEN l.doc_id IS NULL THEN 0.0 ELSE 1.0 END), 6) AS completeness
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def stats_index_completeness(spark, folder):
    t = Tables(spark, folder)
    return shared.rounded(stats.index_completeness(t.documents, t.labels, pk="doc_id"), "completeness")


def _annotated(t: Tables):
    return t.documents.join(t.embeddings.withColumnRenamed("vec_id", "doc_id"), "doc_id", "left")


_ANNOTATED = "a AS (SELECT d.*, e.embedding, e.label FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id)"


def _profile_sql(field: str, kind: str, size: str, length: str = "NULL::INTEGER") -> str:
    return (
        f"SELECT '{field}' AS field, '{kind}' AS type, count(*) AS docs, count(*) - count({field}) AS nulls,"
        f" coalesce(sum({size}), 0)::BIGINT AS bytes, min({length})::INTEGER AS min_length,"
        f" max({length})::INTEGER AS max_length FROM a"
    )


@query(
    "storage_profile",
    f"WITH {_ANNOTATED} "
    + " UNION ALL ".join(
        [
            _profile_sql("doc_id", "int64", "8"),
            _profile_sql("text", "string", "strlen(text)"),
            _profile_sql("lang", "string", "strlen(lang)"),
            _profile_sql("source", "string", "strlen(source)"),
            _profile_sql("n_chars", "int64", "8"),
            _profile_sql("embedding", "array_float", "len(embedding) * 4", "len(embedding)"),
            _profile_sql("label", "int32", "CASE WHEN label IS NOT NULL THEN 4 END"),
        ]
    ),
)
def storage_profile(spark, folder):
    return stats.storage_profile(_annotated(Tables(spark, folder)))


_REPORTED = (
    Schema("reported")
    .add("doc_id", "string", primary_key=True)
    .add("text", "string", nullable=True)
    .add("label", "int32", index="invert")
    .add("embedding", "vector_fp32", dimension=64, index={"type": "hnsw", "metric": "cosine"})
)


def _report_sql(field: str, declared: str, actual: str, category: str, key: str, nullable: str, dim: int, index: str, length: str, bad: str) -> str:
    return (
        f"SELECT '{field}' AS field, '{declared}' AS declared_type, '{actual}' AS actual_type,"
        f" '{category}' AS category, {key} AS primary_key, {nullable} AS nullable, {dim} AS dimension,"
        f" {index} AS index_type, count(*) - count({field}) AS nulls, min({length})::INTEGER AS min_length,"
        f" max({length})::INTEGER AS max_length, count(*) FILTER (WHERE {bad}) AS violations FROM a"
    )


@query(
    "schema_report",
    f"WITH {_ANNOTATED} "
    + " UNION ALL ".join(
        [
            _report_sql("doc_id", "string", "bigint", "forward", "true", "false", 0, "NULL", "NULL", "doc_id IS NULL"),
            _report_sql("text", "string", "string", "forward", "false", "true", 0, "NULL", "NULL", "false"),
            _report_sql("label", "int32", "int", "forward", "false", "false", 0, "'invert'", "NULL", "label IS NULL"),
            _report_sql("embedding", "vector_fp32", "array<float>", "vector", "false", "false", 64, "'hnsw'",
                        "len(embedding)", "embedding IS NULL OR len(embedding) != 64"),
        ]
    ),
)
def schema_report(spark, folder):
    return stats.schema_report(stamp(_annotated(Tables(spark, folder)), _REPORTED), _REPORTED)

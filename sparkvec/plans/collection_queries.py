"""Collections on disk, index tables, approximate search and streaming."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.metrics import literal_vector, squared_l2
from ..functions.quantize import trained
from ..functions.spaces import lifted_column
from ..operators import index as ivf
from ..operators.knn_join import knn_join, largest_norm
from ..operators.layout import write_arranged
from ..schema import Field, Index, Schema
from ..session import scratch_path
from ..sources.collection import Collection
from ..streaming.upsert import streaming_upsert
from . import shared
from .registry import Tables, query
from .shared import QUERY, join_sql, knn_sql, rounded, vectors

_EMBEDDINGS = f"SELECT vec_id::VARCHAR AS id, label, {shared.measured_sql('embedding')} FROM embeddings"


def _created(spark, folder) -> Collection:
    records = shared.embedding_records(Tables(spark, folder))
    return Collection.create(spark, scratch_path(spark, "collection"), shared.EMBEDDING_SCHEMA, records)


@query("create_collection", _EMBEDDINGS)
def create_collection(spark, folder):
    return shared.measured(_created(spark, folder).scan(), "embedding")


@query("scan_collection", "SELECT vec_id::VARCHAR AS id, label FROM embeddings")
def scan_collection(spark, folder):
    made = _created(spark, folder)
    return Collection.open(spark, made.path).scan().select("id", "label")


@query("optimize_compact", _EMBEDDINGS)
def optimize_compact(spark, folder):
    made = _created(spark, folder)
    made.optimize()
    return shared.measured(made.scan(), "embedding")


@query("optimize_layout", "SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'fr' AND n_chars > 1000")
def optimize_layout(spark, folder):
    path = scratch_path(spark, "layout")
    documents = Tables(spark, folder).documents
    write_arranged(
        documents, path, sort_by=["lang", "n_chars"], pk="doc_id", bloom=["source"], max_records=50_000
    )
    return spark.read.parquet(path).where("lang = 'fr' and n_chars > 1000").select("doc_id", "lang", "n_chars")


@query(
    "collection_writes",
    """WITH e AS (SELECT vec_id::VARCHAR AS id, label FROM embeddings),
    n AS (SELECT conv_id::VARCHAR AS id, max_by(length(text), turn)::INTEGER AS label FROM conversations GROUP BY conv_id),
    u AS (SELECT * FROM n UNION ALL SELECT * FROM e WHERE id NOT IN (SELECT id FROM n)),
    p AS (SELECT u.id, coalesce(l.quality, u.label) AS label FROM u LEFT JOIN labels l ON l.doc_id::VARCHAR = u.id)
    SELECT * FROM p WHERE id NOT IN (SELECT page_id::VARCHAR FROM pages) AND NOT coalesce(label = 3, false)""",
)
def collection_writes(spark, folder):
    """Upsert, update, delete by key and by filter on a stored collection."""
    t = Tables(spark, folder)
    schema = Schema("marks").add("id", "string", primary_key=True).add("label", "int32", nullable=True)
    made = Collection.create(
        spark, scratch_path(spark, "marks"), schema, shared.embedding_records(t).drop("embedding")
    )
    turns = t.conversations.select(F.col("conv_id").alias("id"), F.length("text").alias("label"), "turn")
    made.upsert(turns, order=["turn"])
    made.update(t.labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    made.delete(t.pages.select(F.col("page_id").cast("string").alias("id")))
    made.delete_by_filter("label = 3")
    return made.scan()


@query(
    "create_index",
    """SELECT 'doc_count' AS metric, NULL::VARCHAR AS field, count(*)::DOUBLE AS value FROM embeddings
    UNION ALL SELECT 'index_completeness', 'embedding', 1.0::DOUBLE""",
)
def create_index(spark, folder):
    made = _created(spark, folder)
    made.create_index("embedding", Index("ivf", metric="cosine", n_list=16, n_iters=5))
    return made.stats()


@query("optimize_interleaved", "SELECT doc_id, lang, n_chars FROM documents WHERE n_chars BETWEEN 500 AND 900 OR source = 'src3'")
def optimize_interleaved(spark, folder):
    """A layout along a space-filling key of three fields keeps every row."""
    path = scratch_path(spark, "layout")
    documents = Tables(spark, folder).documents
    write_arranged(documents, path, sort_by=["n_chars", "lang", "source"], pk="doc_id", files=8, interleave=True)
    found = spark.read.parquet(path).where("n_chars between 500 and 900 or source = 'src3'")
    return found.select("doc_id", "lang", "n_chars")


# -- index tables ----------------------------------------------------------------


def _trained(t: Tables, metric: str = "l2", n_list: int = 16):
    df = vectors(t)
    return df, ivf.train_centroids(df, "e", n_list=n_list, n_iters=5, metric=metric)


@query("ivf_centroids", "SELECT true AS bounded, true AS own_cell_nearest, true AS better_than_one_cell")
def ivf_centroids(spark, folder):
    """What k-means must hold: at most k cells, rows in their nearest one, less cost than one cell."""
    df, cells = _trained(Tables(spark, folder))
    mean = df.select(F.posexplode("e").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("x"))
    listed = mean.agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("m"))
    centre = literal_vector(listed.select(F.transform("m", lambda p: p["x"])).first()[0])  # one vector
    placed = ivf.assign(df, "e", cells)
    gaps = F.array(*(squared_l2("e", literal_vector(p)) for p in cells.points))
    return placed.agg(
        F.lit(len(cells.points) <= 16).alias("bounded"),
        (F.max(F.abs(F.sqrt(F.array_min(gaps)) - F.col("distance"))) < 1e-6).alias("own_cell_nearest"),
        (F.sum(F.col("distance") * F.col("distance")) < F.sum(squared_l2("e", centre))).alias("better_than_one_cell"),
    )


# Cells that SQL can state too: the mean vector of each label, in the metric's space.


def _label_cells(t: Tables, metric: str) -> ivf.Centroids:
    rows = vectors(t).withColumn("e", lifted_column(metric, "e", shared.DIMENSION, None))
    means = rows.select("label", F.posexplode("e").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    found = means.orderBy("label", "i").collect()  # labels times dimensions
    return ivf.Centroids(np.array([r["x"] for r in found]).reshape(-1, shared.DIMENSION), metric, shared.DIMENSION)


def _cells_sql(metric: str) -> str:
    """``u``: vectors in the metric's space; ``m``: cells; ``g``: all distances; ``a``: each row's cell."""
    space = "e" if metric == "l2" else "[x / sqrt(list_inner_product(e, e)) for x in e]"
    return f"""{shared.VECTORS_SQL}, u AS (SELECT vec_id, label, e, {space} AS y FROM v),
    x AS (SELECT label, unnest(y) AS x, generate_subscripts(y, 1) AS i FROM u),
    w AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS x FROM x GROUP BY label, i) GROUP BY label),
    m AS (SELECT row_number() OVER (ORDER BY label) - 1 AS cell, c FROM w),
    g AS (SELECT vec_id, label, cell, y, c, e, list_distance(y, c) AS d FROM u, m),
    a AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cell) = 1)"""


# The second place of a row: least |r'|^2 + (r . r' / |r|)^2, with r and r' its residuals.
_SPILL_SQL = """b AS (SELECT g.vec_id, g.cell, g.d, g.e, g.label FROM a JOIN g USING (vec_id) WHERE g.cell <> a.cell
    QUALIFY row_number() OVER (PARTITION BY g.vec_id ORDER BY g.d * g.d + pow(
      list_inner_product([z[1] - z[2] for z in list_zip(a.y, a.c)], [z[1] - z[2] for z in list_zip(g.y, g.c)]) / a.d, 2), g.cell) = 1)"""


def _probed_sql(metric: str, probes: int, need: int, k: int = 10, members: str = "a", where: str = "true") -> str:
    """Exact ranking inside the cells that a probe visits: ``probes`` of them, or until they hold ``need``."""
    score = "list_distance(q.e, h.e)" if metric == "l2" else "list_cosine_distance(h.e, q.e)"
    return f"""z AS (SELECT cell, count(*) AS n FROM {members} WHERE {where} GROUP BY cell),
    r AS (SELECT vec_id AS qid, cell, row_number() OVER w AS place FROM g WINDOW w AS (PARTITION BY vec_id ORDER BY d, cell)),
    o AS (SELECT qid, cell, place, coalesce(sum(n) OVER (PARTITION BY qid ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS before FROM r JOIN z USING (cell)),
    p AS (SELECT qid, cell FROM o WHERE place <= {probes} OR before < {need}),
    s AS (SELECT DISTINCT p.qid, h.vec_id AS pk, {score} AS s FROM p JOIN (SELECT * FROM {members} WHERE {where}) h USING (cell)
      JOIN v q ON q.vec_id = p.qid),
    n AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s, pk) AS n FROM s)
    SELECT qid, n::INTEGER AS rank, pk, round(s, 6) AS score FROM n WHERE n <= {k}"""


@query("ivf_assign", f"WITH {_cells_sql('l2')} SELECT vec_id, cell::INTEGER AS cell, round(d, 6) AS distance FROM a")
def ivf_assign(spark, folder):
    t = Tables(spark, folder)
    return rounded(ivf.assign(vectors(t), "e", _label_cells(t, "l2")).select("vec_id", "cell", "distance"), "distance")


@query(
    "ivf_soar_assign",
    f"""WITH {_cells_sql('l2')}, {_SPILL_SQL}
    SELECT vec_id, cell::INTEGER AS cell, round(d, 6) AS distance, false AS spill FROM a
    UNION ALL SELECT vec_id, cell::INTEGER, round(d, 6), true FROM b""",
)
def ivf_soar_assign(spark, folder):
    t = Tables(spark, folder)
    placed = ivf.assign(vectors(t), "e", _label_cells(t, "l2"), soar=True)
    return rounded(placed.select("vec_id", "cell", "distance", "spill"), "distance")


def _stored_index(spark, df, cells, **options):
    path = scratch_path(spark, "index")
    ivf.write_index(ivf.assign(df, "e", cells, **options), path)
    return ivf.read_index(spark, path)


def _probed(metric: str, n_probe: int | None, **options):
    def plan(spark, folder):
        df, cells = _trained(Tables(spark, folder), metric)
        stored, facts = _stored_index(spark, df, cells, **options)
        return rounded(ivf.ivf_knn(df, stored, cells, qid="vec_id", pk="vec_id", field="e", n_probe=n_probe, stats=facts))

    return plan


def _by_label(metric: str, search=ivf.ivf_knn, soar: bool = False, **options):
    def plan(spark, folder):
        t = Tables(spark, folder)
        cells = _label_cells(t, metric)
        stored, facts = _stored_index(spark, vectors(t), cells, soar=soar)
        return rounded(search(vectors(t), stored, cells, qid="vec_id", pk="vec_id", field="e", stats=facts, **options))

    return plan


_BOTH = "c2 AS (SELECT vec_id, cell, e, label FROM a UNION ALL SELECT vec_id, cell, e, label FROM b)"
query("ivf_knn", f"WITH {_cells_sql('l2')}, {_probed_sql('l2', 1, 10)}")(_by_label("l2"))
query("ivf_soar_knn", f"WITH {_cells_sql('l2')}, {_SPILL_SQL}, {_BOTH}, {_probed_sql('l2', 2, 20, members='c2')}")(
    _by_label("l2", n_probe=2, soar=True)
)
# The filter leaves few members in most cells: probing goes on until ten of them are seen.
query("ivf_knn_filtered", f"WITH {_cells_sql('l2')}, {_probed_sql('l2', 1, 10, where='vec_id % 9 = 4')}")(
    _by_label("l2", n_probe=1, filter="vec_id % 9 = 4")
)
query("ann_knn", f"WITH {_cells_sql('cosine')}, {_probed_sql('cosine', 0, 64)}")(_by_label("cosine", ivf.ann_knn, ef=64))
# Probing every cell is exact search, with and without spilled copies.
query("ivf_knn_full_probe", join_sql("cosine"))(_probed("cosine", 16))
query("ivf_soar_full_probe", join_sql("ip"))(_probed("ip", 16, soar=True))


# Decoded int8 codes pick 20 candidates per query, the vectors rank the best 10.
@query(
    "ivf_knn_refined",
    f"""WITH {shared.VECTORS_SQL},
    x AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v),
    r AS (SELECT i, min(x) AS lo, max(x) AS hi FROM x GROUP BY i),
    c AS (SELECT vec_id, i, lo + floor((x - lo) / (hi - lo) * 255 + 0.5) * (hi - lo) / 255 AS y FROM x JOIN r USING (i)),
    d AS (SELECT vec_id AS pk, list(y ORDER BY i) AS y FROM c GROUP BY vec_id),
    s AS (SELECT v.vec_id AS qid, v.e AS q, d.pk, row_number() OVER (
      PARTITION BY v.vec_id ORDER BY list_distance(d.y, v.e), d.pk) AS place FROM v, d),
    f AS (SELECT s.qid, s.pk, list_distance(v.e, s.q) AS s FROM s JOIN v ON v.vec_id = s.pk WHERE place <= 20),
    n AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s, pk) AS n FROM f)
    SELECT qid, n::INTEGER AS rank, pk, round(s, 6) AS score FROM n WHERE n <= 10""",
)
def ivf_knn_refined(spark, folder):
    df, cells = _trained(Tables(spark, folder))
    quantizer = trained(df, "e", "int8", shared.DIMENSION)
    path = scratch_path(spark, "codes")
    ivf.write_index(ivf.quantized(ivf.assign(df, "e", cells), "e", quantizer), path)
    codes, facts = ivf.read_index(spark, path)
    hits = ivf.ivf_knn_refined(
        df,
        codes,
        df,
        cells,
        quantizer,
        qid="vec_id",
        pk="vec_id",
        field="e",
        n_probe=len(cells.points),
        scale_factor=2.0,
        stats=facts,
    )
    return rounded(hits)


@query("ivf_knn_one_full_probe", knn_sql("l2", columns="label", k=20))
def ivf_knn_one_full_probe(spark, folder):
    df, cells = _trained(Tables(spark, folder))
    stored, facts = _stored_index(spark, df, cells)
    hits = ivf.ivf_knn_one(
        stored, cells, QUERY, pk="vec_id", field="e", n_probe=len(cells.points), k=20, stats=facts
    )
    return rounded(hits)


@query("knn_force_linear", knn_sql("mipsl2"))
def knn_force_linear(spark, folder):
    df, cells = _trained(Tables(spark, folder), "mipsl2")
    stored, _ = _stored_index(spark, df, cells)
    return rounded(ivf.ivf_knn_one(stored, cells, QUERY, pk="vec_id", field="e", linear=True))


@query("knn_adaptive", knn_sql("l2", where="label = 3"))
def knn_adaptive(spark, folder):
    # About a tenth of the rows pass, under the ratio: the exact scan answers.
    df, cells = _trained(Tables(spark, folder))
    stored, facts = _stored_index(spark, df, cells)
    hits = ivf.knn_adaptive(
        df, stored, cells, QUERY, pk="vec_id", field="e", filter="label = 3", ratio=0.25, stats=facts
    )
    return rounded(hits)


@query("knn_adaptive_by_index", knn_sql("l2", where="label <> 3"))
def knn_adaptive_by_index(spark, folder):
    """Most rows pass: the index answers, visiting every cell that could hold a hit."""
    df, cells = _trained(Tables(spark, folder))
    stored, facts = _stored_index(spark, df, cells)
    search = dict(pk="vec_id", field="e", filter="label <> 3", ratio=0.25, stats=facts)
    return rounded(ivf.knn_adaptive(df, stored, cells, QUERY, **search))


# Cells trained on the shorter half; longer vectors come later, so the norm grows.
@query("ivf_mipsl2_after_growth", join_sql("mipsl2"))
def ivf_mipsl2_after_growth(spark, folder):
    df = vectors(Tables(spark, folder))
    cells = ivf.train_centroids(df.where("vec_id % 7 < 4"), "e", n_list=8, n_iters=3, metric="mipsl2")
    stored, facts = _stored_index(spark, df, cells)
    top = largest_norm(df, "e", shared.DIMENSION)
    every = dict(qid="vec_id", pk="vec_id", field="e", n_probe=len(cells.points))
    return rounded(ivf.ivf_knn(df, stored, cells, max_norm=top, stats=facts, **every))


_RECALL = " UNION ALL ".join(
    f"""SELECT {n} AS n_probe, count(DISTINCT x.qid) AS queries, count(*) AS expected, round(avg((f.pk IS NOT NULL)::INTEGER), 6) AS recall
    FROM ({join_sql('cosine')}) x LEFT JOIN (WITH {_cells_sql('cosine')}, {_probed_sql('cosine', n, 10)}) f ON f.qid = x.qid AND f.pk = x.pk"""
    for n in (1, 4, 10)
)


@query("recall_at_k", _RECALL)
def recall_at_k(spark, folder):
    t = Tables(spark, folder)
    cells = _label_cells(t, "cosine")
    stored, facts = _stored_index(spark, vectors(t), cells)
    curve = ivf.recall_curve(vectors(t), vectors(t), stored, cells, [1, 4, 10], qid="vec_id", pk="vec_id", field="e", stats=facts)
    return rounded(curve, "recall")


# Every query comes twice, and once more without its last element.
@query("knn_join_mixed_dimensions", join_sql("l2"))
def knn_join_mixed_dimensions(spark, folder):
    df = vectors(Tables(spark, folder))
    short = df.withColumn("e", F.slice("e", 1, shared.DIMENSION - 1))
    asked = short.unionByName(df).unionByName(df)
    return rounded(knn_join(asked, df, qid="vec_id", pk="vec_id", field="e", strategy="scan"))


@query("knn_join_mixed_dimensions_pivot", join_sql("l2"))
def knn_join_mixed_dimensions_pivot(spark, folder):
    df = vectors(Tables(spark, folder))
    short = df.withColumn("e", F.slice("e", 1, shared.DIMENSION - 1))
    asked = short.unionByName(df).unionByName(df)
    return rounded(knn_join(asked, df, qid="vec_id", pk="vec_id", field="e", strategy="pivot"))


@query("recall_of_exact", "SELECT count(*) AS queries, count(*) * 10 AS expected, 1.0::DOUBLE AS recall FROM embeddings")
def recall_of_exact(spark, folder):
    df, cells = _trained(Tables(spark, folder), "l2")
    stored, facts = _stored_index(spark, df, cells)
    every = dict(qid="vec_id", pk="vec_id", field="e")
    found = ivf.ivf_knn(df, stored, cells, n_probe=len(cells.points), stats=facts, **every)
    return ivf.recall_at_k(found, knn_join(df, df, metric="l2", **every))


# -- an index and changes of the schema --------------------------------------------


def _indexed(spark, folder) -> Collection:
    made = _created(spark, folder)
    made.create_index("embedding", Index("ivf", metric="cosine", n_list=16, n_iters=3))
    return made


def _asked(spark, folder, key: str):
    return shared.embedding_records(Tables(spark, folder)).select(F.col(key).alias("qid"), "embedding")


_JOIN_EMBEDDINGS = """WITH s AS (SELECT a.vec_id::VARCHAR AS qid, b.vec_id::VARCHAR AS pk,
    list_cosine_distance(b.embedding::DOUBLE[], a.embedding::DOUBLE[]) AS s FROM embeddings a, embeddings b WHERE {where}),
    n AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s, pk) AS n FROM s)
    SELECT qid, n::INTEGER AS rank, pk, round(s, 6) AS score FROM n WHERE n <= 10"""


@query("indexed_add_column", _JOIN_EMBEDDINGS.format(where="b.label * 2 >= 4"))
def indexed_add_column(spark, folder):
    made = _indexed(spark, folder)
    made.add_column(Field("twice", "int32", nullable=True), default="label * 2")
    made.stats()
    made.optimize()
    hits = made.search_many(_asked(spark, folder, "id"), "embedding", qid="qid", filter="twice >= 4", n_probe=16)
    return rounded(hits)


@query("indexed_rename_columns", _JOIN_EMBEDDINGS.format(where="b.label >= 2"))
def indexed_rename_columns(spark, folder):
    made = _indexed(spark, folder)
    for old, new in (("id", "key"), ("label", "kind"), ("embedding", "v")):
        made.rename_column(old, new)
    made.stats()
    # The index outlives a rename; all its cells are probed, under the new names.
    before = made.search_many(_asked(spark, folder, "id"), "v", qid="qid", query_field="embedding", filter="kind >= 2", n_probe=16)
    made.optimize()
    after = made.search_many(_asked(spark, folder, "id"), "v", qid="qid", query_field="embedding", filter="kind >= 2", n_probe=16)
    return rounded(before.intersectAll(after))


_HITS = """WITH s AS (SELECT a.vec_id::VARCHAR AS qid, b.vec_id::VARCHAR AS pk, b.label AS label,
    list_cosine_distance(b.embedding::DOUBLE[], a.embedding::DOUBLE[]) AS s FROM embeddings a, embeddings b),
    n AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY s, pk) AS n FROM s)
    SELECT qid, n::INTEGER AS rank, pk, round(s, 6) AS score, label FROM n WHERE n <= 10 AND s <= 0.7"""


@query("collection_search_fields_radius", _HITS)
def collection_search_fields_radius(spark, folder):
    made = _indexed(spark, folder)
    found = made.search_many(
        _asked(spark, folder, "id"), "embedding", qid="qid", n_probe=16, radius=0.7, output_fields=["label"]
    )
    return rounded(found)


@query(
    "collection_search_ivf",
    f"WITH {shared.QUERY_SQL}, s AS (SELECT vec_id::VARCHAR AS id, label, list_cosine_distance(embedding::DOUBLE[], q) AS s FROM embeddings, q)"
    " SELECT id, label, round(s, 6) AS score FROM s WHERE label <> 3 ORDER BY s, id LIMIT 10",
)
def collection_search_ivf(spark, folder):
    made = _indexed(spark, folder)
    return rounded(made.search("embedding", QUERY, n_probe=16, filter="label <> 3", output_fields=["id", "label"]))


@query("indexed_drop_vector", "SELECT vec_id::VARCHAR AS id, label, 0 AS indexes FROM embeddings")
def indexed_drop_vector(spark, folder):
    made = _indexed(spark, folder)
    made.drop_column("embedding")
    made.optimize()
    return made.scan().withColumn("indexes", F.lit(len(made.snapshot().indexes)))


# -- streaming -------------------------------------------------------------------


@query(
    "streaming_upsert",
    """SELECT user_id::VARCHAR AS id, event_type, value, event_id, epoch_us(ts) AS seen FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def streaming_upsert_query(spark, folder):
    """Events as a stream of files in no particular order, upserted batch by batch."""
    events = Tables(spark, folder).events.select(
        F.col("user_id").cast("string").alias("id"),
        "event_type",
        "value",
        "event_id",
        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts")).alias("seen"),
    )
    source = scratch_path(spark, "events")
    events.repartitionByRange(3, "seen").write.parquet(source)
    schema = (
        Schema("users")
        .add("id", "string", primary_key=True)
        .add("event_type", "string", nullable=True)
        .add("value", "double", nullable=True)
        .add("event_id", "int64")
        .add("seen", "int64")
    )
    made = Collection.create(spark, scratch_path(spark, "users"), schema)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source)
    running = streaming_upsert(
        stream,
        made,
        name="users",
        order=["seen", "event_id"],
        checkpoint=scratch_path(spark, "checkpoint"),
    )
    running.awaitTermination()
    return made.scan()

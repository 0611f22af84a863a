"""The registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Plan, Tables
from . import collision_ann, hard_negatives, language, lattice_lm, licenses, minhash, packing, phrases, pieces, pii, quality, token_counts, vector_dedup

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(plan: Plan) -> Plan:
        PLANS[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return register


@query("op10_minhash_near_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(Tables(spark, folder).documents)


@query("op3_first_fit_packing")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(Tables(spark, folder).documents)


@query("op8_weak_pii")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return pii.summary(Tables(spark, folder).documents)


@query("op9_language_id")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Documents: their ``lang`` is the declared language, their source the host."""
    return language.identify(language.document_evidence(Tables(spark, folder).documents)).withColumnRenamed("id", "doc_id")


@query("language_id_pages")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(language.page_evidence(Tables(spark, folder).pages)).withColumnRenamed("id", "page_id")


@query("op2_weak_label_quality")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(Tables(spark, folder).documents)


@query("op5_lattice_lm")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return lattice_lm.score(Tables(spark, folder).documents)


@query("op4_cross_polytope_dedup")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicates(Tables(spark, folder).embeddings)


@query("op6_collision_counting_ann")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest of each vector whose id is divisible by 100."""
    return collision_ann.search(Tables(spark, folder).embeddings, F.col("id") % 100 == 0)


@query("op1_token_counts", token_counts.sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(Tables(spark, folder).documents)


@query("op7_lattice_pieces")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.digest(Tables(spark, folder).documents, pieces.piece_table(spark), white=True)


@query("op13_license_scan", licenses.sql())
def _(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.summary(Tables(spark, folder).documents)


@query("op11_phrase_collocations", phrases.SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(Tables(spark, folder).documents)


@query("op12_hard_negatives", hard_negatives.SQL)
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are rows whose id is divisible by 50; where it is divisible by 7 the label is the next one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(Tables(spark, folder).embeddings, F.col("id") % 50 == 0, label=moved)

"""A corpus pipeline over ``documents``: each stage works on all that the one before kept.

Rows that a stage rejects are named by a digest of all their columns, or by a number that
is stored with them: both stay the same when another job reads the table with other
splits. So null and repeated ids are fine. The rejected names are written first: if they
are few, Spark broadcasts them by their known size and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkvec.llm import language, minhash, packing, pii, quality
from sparkvec.session import scratch_path, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ROW = "__row"
#: Near copies in the pipeline: similarity 0.8 or more. At 0.8 a pair shares no bucket with chance 1.3e-7.
NEAR = {"numerator": 80, "denominator": 100, "rows": 5, "bands": 40}


def _digest(docs: DataFrame) -> Column:
    """128 bits of all columns; nulls, which hashes pass over, are told apart."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    nulls = F.concat(*(c.isNull().cast("string") for c in columns))
    return F.struct(F.xxhash64(nulls, *columns).alias("h1"), F.xxhash64(F.lit(1), nulls, *columns).alias("h2"))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` with a column ROW, without the rows that ``rejected(id)`` names."""
    gone = settle(rejected.select(F.col("id").alias(ROW)).distinct())
    return docs.join(gone, ROW, "left_anti").drop(ROW)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose language is known: ``lang`` is what they declare, ``source`` their host.

    Equal rows have equal evidence, so a digest of the row can name them.
    """
    named = docs.withColumn(ROW, _digest(docs))
    seen = language.evidence(named, ROW, F.col("text"), F.col("lang"), F.col("source"))
    return _without(named, language.identify(seen).where("not kept"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay that the weakly supervised scorer does not find bad."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    kept = quality.classify(rows, id_col="row").where("kept")
    return kept.select(*(F.col("doc_id").getField(c).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    # Equal rows are told apart by a number that is written with them.
    numbered = settle(docs.withColumn(ROW, F.monotonically_increasing_id()))
    groups = settle(
        minhash.near_duplicates(numbered, id_col=ROW, **NEAR)
        .select(F.col("doc_id").alias("id"), F.col("component_id").alias("group"))
        .join(numbered.select(F.col(ROW).alias("id"), F.col("doc_id").alias("name")), "id")
    )
    first = groups.groupBy("group").agg(F.min_by("id", F.struct(F.col("name").isNull(), "name", "id")).alias("id"))
    return _without(numbered, groups.join(first, "id", "left_anti"))


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts becomes a mark of its kind."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars")))


def first_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, see :func:`sparkvec.llm.packing.pack`."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_dedup),
    ("pii_redaction", pii_redaction),
    ("first_fit_packing", first_fit_packing),
]

#: The trained stages have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

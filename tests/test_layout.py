"""Rows along a space-filling key: nothing is lost, and each field's files are narrow."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sparkvec import Collection, Schema
from sparkvec.operators.layout import interleaved_key, write_arranged


def touched(path, field, value):
    """Files whose range of a field holds the value, of all files."""
    files = glob.glob(f"{path}/*.parquet")
    hit = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(field)
        spans = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hit += any(s.min <= value <= s.max for s in spans)
    return hit, len(files)


def test_every_field_skips_files(spark, tmp_path):
    df = spark.range(20_000).select(
        "id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(1000)).alias("b"),
        F.concat(F.lit("s"), F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(900)).cast("string")).alias("c"),
    )
    fields = ["a", "b", "c"]
    plain, mixed = str(tmp_path / "plain"), str(tmp_path / "mixed")
    write_arranged(df, plain, sort_by=fields, pk="id", files=27)
    write_arranged(df, mixed, sort_by=fields, pk="id", files=27, interleave=True)
    assert sorted(spark.read.parquet(mixed).collect()) == sorted(df.collect())
    for field, value in (("a", 500), ("b", 500), ("c", "s500")):
        hit, files = touched(mixed, field, value)
        assert files >= 20 and hit <= 0.6 * files, field
    assert touched(plain, "b", 500)[0] > 0.9 * touched(plain, "b", 500)[1]


def test_key_of_odd_fields(spark):
    rows = [(i, None if i % 3 == 0 else 7, float(i % 5), f"n{i % 4}", i % 2 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, same int, x double, s string, flag boolean").withColumn("d", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id") % 30))
    keys = df.withColumn("z", interleaved_key(df, ["same", "x", "s", "flag", "d"]))
    assert keys.where("z is null or z < 0").count() == 0 and keys.select("z").distinct().count() == 60
    assert df.where("false").withColumn("z", interleaved_key(df.where("false"), ["x"])).count() == 0


def test_optimize_interleaved(spark, tmp_path):
    schema = Schema("c").add("id", "string", primary_key=True).add("a", "int64", nullable=True, index="invert").add("b", "int64", nullable=True, index="invert")
    df = spark.range(2000).selectExpr("cast(id as string) as id", "id % 50 as a", "id % 47 as b")
    c = Collection.create(spark, str(tmp_path / "c"), schema, df)
    c.optimize(interleave=True)
    assert sorted(c.scan().collect()) == sorted(df.collect())

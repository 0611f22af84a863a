"""Session settings used by tests and bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .errors import FailedPrecondition


def local_session(cores: int = 8, app: str = "sparkvec", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine.

    On a cluster the caller's own session is used as it is; nothing in the
    package changes session settings.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _shared_dir(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    already = context.getCheckpointDir()
    if already:
        return already
    if not context.master.startswith("local"):
        raise FailedPrecondition(
            "set spark.checkpoint.dir to a folder every executor can reach"
        )
    local = tempfile.mkdtemp(prefix="sparkvec-")
    context.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a temporary table in the cluster's shared folder."""
    return f"{_shared_dir(spark).rstrip('/')}/sparkvec-{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several jobs that must agree even when an
    executor is lost in between: the written files replace the lineage. ``spark``
    is the session that reads it (a micro-batch arrives in a session of its own).
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.mode("errorifexists").parquet(path)
    return (spark or df.sparkSession).read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Like :func:`settle`, densely packed, for large tables that :func:`discard` removes; with their path."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of this run that nothing reads any more.

    Call it once all that was made from the table is written itself: a lost executor
    must find what it has to read again.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)

"""Registered queries: a name, a DataFrame plan, and SQL that must agree with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a plan; without ``sql`` only its rows are checked."""

    def register(plan: Plan) -> Plan:
        PLANS[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return register


class Tables:
    """The given tables by name: ``t.documents`` reads ``documents.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{name}.parquet")

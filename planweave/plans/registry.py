"""Where queries register: a builder (spark, folder) and, if SQL can say the same, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The Parquet tables of a folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a builder that takes Tables."""

    def register(f):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: f(Tables(spark, folder))
        QUERIES[key].__doc__ = f.__doc__
        if sql is not None:
            ORACLE[key] = sql
        return f

    return register

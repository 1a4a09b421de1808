"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    """Queries of one module: name -> callable, and name -> SQL where SQL can express the query."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(f: Callable[[Tables], DataFrame]):
            self.queries[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return add


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

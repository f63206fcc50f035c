"""Registered queries: a Spark plan and, where SQL can say it, the same rule in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The driver's parquet tables of one scale factor, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")

    @property
    def documents(self) -> DataFrame:
        """Long texts: their row-local work should use every core."""
        return spread(self.__getattr__("documents"), "doc_id")

    @property
    def pages(self) -> DataFrame:
        return spread(self.__getattr__("pages"), "page_id")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` with its SQL twin."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            SQL[name] = sql
        return fn

    return add

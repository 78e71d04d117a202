"""Registered queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from eodledger.session import tune

Build = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """The given tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]


def registered(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL giving the same rows if there is one."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, folder: build(Tables(tune(spark), folder))
        if sql is not None:
            CHECKS[name] = sql
        return build

    return add

"""Reads from an operational database over JDBC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Fixed value: seconds after which a read from the operational database is given up.
READ_TIMEOUT = 780

# The transaction columns copied to the warehouse.
TRANSACTION_COLUMNS = (
    "id",
    "ticket",
    "no",
    "user_id",
    "external_id",
    "processed_at",
    "completed_at",
    "created_at",
    "updated_at",
)


@dataclass(frozen=True)
class Split:
    """How one read is divided over tasks."""

    column: str
    lower: int
    upper: int
    parts: int


def jdbc_options(url: str, query: str, split: Split | None = None, timeout: int = READ_TIMEOUT) -> dict[str, str]:
    """Options of a JDBC read. A split read wraps the query as a derived table, because
    Spark divides tables, not queries."""
    options = {"url": url, "queryTimeout": str(timeout), "fetchsize": "10000"}
    if split is None:
        return options | {"query": query}
    return options | {
        "dbtable": f"({query}) source",
        "partitionColumn": split.column,
        "lowerBound": str(split.lower),
        "upperBound": str(split.upper),
        "numPartitions": str(split.parts),
    }


def read_operational(
    spark: SparkSession, url: str, query: str, split: Split | None = None, **connection: str
) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, split), **connection).load()

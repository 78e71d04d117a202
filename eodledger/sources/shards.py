"""Sources split into one table per server and year."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: how a year's shard table is named.
DEALS_PREFIX = "mt5_deals_"


def shard_table(server: str, year: int, prefix: str = DEALS_PREFIX) -> str:
    return f"{server}.{prefix}{year}"


def read_shards(
    read: Callable[[str], DataFrame], shards: Iterable[tuple[str, int]], prefix: str = DEALS_PREFIX
) -> DataFrame:
    """One lazy frame over the listed shard tables, tagged with server and year.

    A later filter or semi join on the tags drops the shards it does not need.
    """
    frames = [
        read(shard_table(server, year, prefix)).withColumns(
            {"server": F.lit(server), "year": F.lit(year)}
        )
        for server, year in shards
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def touched_shards(deals: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of ``deals`` in shards that ``wanted (server, year)`` names.

    The shards are read off the list first: there are no more of them than servers times years. As
    values they prune the folders of a tree and the branches of a union before anything is read.
    """
    years: dict[str, list[int]] = {}
    for server, year in sorted(map(tuple, wanted.select("server", "year").dropna().distinct().collect())):
        years.setdefault(server, []).append(year)
    named = [(F.col("server") == server) & F.col("year").isin(*own) for server, own in years.items()]
    return deals.where(reduce(lambda a, b: a | b, named, F.lit(False)))


def write_shard_tree(df: DataFrame, root: str) -> None:
    """Write ``df`` as ``server=…/year=…`` folders, a large shard in several files."""
    df.hint("rebalance", "server", "year").write.mode("overwrite").partitionBy("server", "year").parquet(root)


def read_shard_tree(spark: SparkSession, root: str) -> DataFrame:
    """Shards kept as ``server=…/year=…`` folders; the tags are partition columns."""
    return spark.read.parquet(root).where(F.col("server").isNotNull() & F.col("year").isNotNull())

"""Row concatenation."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_shards(shards: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Frames of the same columns, each row tagged with the shard it came from."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in shards.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def union_populations(with_scope: DataFrame, without_scope: DataFrame, scope: str) -> DataFrame:
    """Two populations where only the first has the scope column; duplicates stay."""
    return with_scope.unionByName(
        without_scope.withColumn(scope, F.lit(None).cast(with_scope.schema[scope].dataType))
    )

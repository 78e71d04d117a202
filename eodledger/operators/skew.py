"""Joins that stay balanced when one key, or the missing key, holds many rows.

Adaptive execution splits a hot partition of an inner, left, semi or anti sort-merge
join on the preserved side. The functions here cover what it cannot: a hot optional
side, NULL keys, and a fact side that must be spread whatever the join strategy.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
HOT = "__hot"


def left_join_spread_nulls(
    left: DataFrame, right: DataFrame, key: str, right_key: str, spread_by: str, spread: int = 256
) -> DataFrame:
    """Left join on one key where many left rows have none.

    Rows without a key match nothing, yet a plain join sends all of them to one
    task. Here they are dealt over ``spread`` tasks by another column.
    """
    dealt = left.withColumn(
        SALT, F.when(F.col(key).isNull(), F.pmod(F.xxhash64(spread_by), F.lit(spread))).otherwise(0)
    )
    target = right.withColumn("__right_salt", F.lit(0).cast("bigint"))
    joined = dealt.join(
        target,
        (F.col(key) == target[right_key]) & (F.col(SALT) == F.col("__right_salt")),
        "left",
    )
    return joined.drop(SALT, "__right_salt")


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.01) -> DataFrame:
    """Keys holding more than ``share`` of all rows: at most 1/share of them exist."""
    least = df.agg((F.count(F.lit(1)) * F.lit(share)).alias("least")).scalar()
    return df.groupBy(*keys).count().where(F.col("count") > least).drop("count")


def salted_join(
    fact: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    how: str,
    share: float = 0.01,
    salts: int = 64,
) -> DataFrame:
    """Join on equal names with hot fact keys dealt over ``salts`` tasks.

    The other side repeats only its rows for hot keys. The hot-key list is bounded by
    1/share rows, which is why it may be broadcast. Valid for inner, left, left_semi
    and left_anti, where no row of the other side is preserved.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"salted_join cannot preserve the other side: {how}")
    keys = list(keys)
    hot = F.broadcast(hot_keys(fact, keys, share).withColumn(HOT, F.lit(True)))
    rest = [c for c in fact.columns if c not in keys] or keys
    keyless = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = fact.join(hot, keys, "left").withColumn(
        SALT,
        F.when(F.col(HOT) | keyless, F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int")).otherwise(0),
    ).drop(HOT)
    copies = F.when(F.col(HOT), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = other.join(hot, keys, "left").withColumn(SALT, F.explode(copies)).drop(HOT)
    return dealt.join(repeated, [*keys, SALT], how).drop(SALT)


def left_join_hot_right(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """Left join whose optional side may hold a hot key.

    A left join cannot split its right side. The matched part is written as an inner
    join, which can, and the unmatched left rows come from an anti join against the
    distinct right keys.
    """
    matched = left.join(right, left[key] == right[right_key], "inner")
    present = right.select(F.col(right_key).alias("__present")).distinct()
    alone = left.join(present, left[key] == F.col("__present"), "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)

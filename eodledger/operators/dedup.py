"""One row per key.

Each function ranks with row_number and keeps rank 1. Spark turns that into a
per-partition limit before the exchange, so a key holding a third of all rows sends
at most one row per map task to its reducer.

Descending order puts NULL first and ascending order puts it last. ``ties`` names the
columns that decide between equal times; give enough of them to make the result unique.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eodledger.functions.times import bucket_at_most, ntz

RANK = "__rank"


def _ranked(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    return df.withColumn(RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def _newest(order_by: str, ties: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_first() for c in (order_by, *ties)]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str, ties: Sequence[str] = ()
) -> DataFrame:
    return _ranked(df, keys, _newest(order_by, ties)).where(F.col(RANK) == 1).drop(RANK)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: str, ties: Sequence[str] = ()
) -> DataFrame:
    order = [F.col(c).asc_nulls_last() for c in (order_by, *ties)]
    return _ranked(df, keys, order).where(F.col(RANK) == 1).drop(RANK)


def rank_then_keep(
    df: DataFrame, keys: Sequence[str], order_by: str, keep: Column, ties: Sequence[str] = ()
) -> DataFrame:
    """Keep a key only if its newest row passes; an older passing row does not count."""
    ranked = _ranked(df, keys, _newest(order_by, ties))
    return ranked.where((F.col(RANK) == 1) & keep).drop(RANK)


def keep_then_rank(
    df: DataFrame, keys: Sequence[str], order_by: str, keep: Column, ties: Sequence[str] = ()
) -> DataFrame:
    """The newest row among those that pass."""
    return latest_per_key(df.where(keep), keys, order_by, ties)


def as_of_snapshot(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    cutoff: datetime,
    ties: Sequence[str] = (),
    bucketed: bool = False,
) -> DataFrame:
    """State known at a cutoff.

    bucketed: the half-hour bucket of the time is at most the cutoff; otherwise the
    time itself is strictly before it.
    """
    known = bucket_at_most(F.col(at), cutoff) if bucketed else F.col(at) < ntz(cutoff)
    return latest_per_key(df.where(known), keys, at, ties)


def union_latest(
    frames: Sequence[DataFrame], keys: Sequence[str], order_by: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key over several sets with the same columns, matched by position."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.union(frame)
    return latest_per_key(stacked, keys, order_by, ties)

"""Families of conditional sums described as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """A named sum of the amount over the rows where ``when`` holds."""

    name: str
    when: Column


def rounded_sum(value: Column, scale: int = 2) -> Column:
    """Rounded sum; NULL when no row contributes."""
    return F.round(F.sum(value), scale)


def rounded_sum_or_zero(value: Column, scale: int = 2) -> Column:
    return F.coalesce(rounded_sum(value, scale), F.lit(0.0))


def sum_measures(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    measures: Sequence[Measure],
    totals: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """All measures per key in one aggregate, then totals of the rounded parts."""
    sums = [rounded_sum_or_zero(F.when(m.when, F.col(amount))).alias(m.name) for m in measures]
    result = df.groupBy(*keys).agg(*sums)
    for name, parts in (totals or {}).items():
        result = result.withColumn(name, reduce(lambda a, b: a + b, [F.col(p) for p in parts]))
    return result


def product_volumes(
    product: Column, volume: str, products: Mapping[str, str], lot: float = 100.0
) -> list[Column]:
    """One volume column per product, in lots, zero where a product was not traded."""
    return [
        F.coalesce(F.sum(F.when(product == label, F.col(volume))) / lot, F.lit(0.0)).alias(name)
        for name, label in products.items()
    ]


def state_counts(states: Mapping[str, Column], ticket: str) -> list[Column]:
    """Count of tickets in each state."""
    return [F.count(F.when(state, F.col(ticket))).alias(name) for name, state in states.items()]

"""Amount expressions of an account row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def clip_positive(value: Column) -> Column:
    return F.when(value > 0, value).otherwise(0.0)


def clip_negative(value: Column) -> Column:
    return F.when(value < 0, value).otherwise(0.0)


def used_credit(credit: Column, equity: Column) -> Column:
    """How much of a granted credit is consumed, as a non-positive number."""
    return F.when(
        credit > 0, F.when(equity < 0, -credit).when(equity < credit, equity - credit).otherwise(0.0)
    ).otherwise(0.0)


def positive_equity(equity: Column, balance: Column, credit: Column) -> Column:
    """Equity without credit, never below zero."""
    under_water = (equity < balance) & (balance < 0)
    own = equity - credit
    return F.when(under_water | (own < 0), 0.0).otherwise(F.round(own, 2))


def weighted_cost(pairs: list[tuple[Column, Column]]) -> Column:
    """Sum of volume times rate; one missing term makes the whole cost NULL."""
    total = pairs[0][0] * pairs[0][1]
    for volume, rate in pairs[1:]:
        total = total + volume * rate
    return total


def to_usd(amount: Column, currency: Column, pair: Column, close: Column) -> Column:
    """Convert by a six-letter pair: base currency multiplies, quote currency divides."""
    return F.round(
        F.when(currency == "USD", amount)
        .when(F.substring(pair, 1, 3) == currency, amount * close)
        .when(F.right(pair, F.lit(3)) == currency, amount / close)
        .otherwise(0.0),
        2,
    )

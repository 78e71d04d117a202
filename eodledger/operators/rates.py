"""Daily closes and currency lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodledger.operators.dedup import latest_per_key
from eodledger.operators.skew import salted_join
from eodledger.session import stored

#: Newest rates of up to this many bytes are sent to every task.
BROADCAST_BYTES = 8 << 20


def daily_close(
    prices: DataFrame, symbol: str, at: str, price: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Last price of each symbol and day.

    max_by is combined before the exchange, so a symbol with a third of all ticks costs
    its reducer one partial row per map task; a window would bring in every tick.
    Without ``ties`` it also runs as a hash aggregate, which needs no sort; name tie
    columns only where a symbol can have two prices at one time.
    """
    order = F.struct(*[F.col(c) for c in (at, *ties)]) if ties else F.col(at)
    return prices.groupBy(symbol, F.to_date(at).alias("day")).agg(
        F.max_by(F.col(price), order).alias("close")
    )


def latest_rate_lookup(
    accounts: DataFrame,
    rates: DataFrame,
    on: str,
    rate_key: str,
    rate_day: str,
    ties: Sequence[str] = (),
    only_if: Column | None = None,
    most: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each account with the newest rate of its currency; accounts without one stay.

    Joining every rate day and ranking afterwards gives the same rows, but multiplies
    the accounts by the number of days. Ranking the rates first keeps it one to one.
    ``only_if`` is a further join condition on the account side.

    The newest rates are stored and measured. Up to ``most`` bytes they go to every task
    and no account moves; beyond that both sides move, and the accounts of a frequent
    currency are dealt over many tasks.
    """
    newest = stored(latest_per_key(rates, [rate_key], rate_day, ties), "newest")
    size = sum((F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) + 16 for f in newest.schema.fields), F.lit(16))
    wanted = F.col(on) if only_if is None else F.when(only_if, F.col(on))
    keyed = accounts.withColumn("__rate_key", wanted)
    found = newest.withColumn("__rate_key", F.col(rate_key)).where(F.col(rate_key).isNotNull())
    if newest.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= most:
        joined = keyed.join(F.broadcast(found), "__rate_key", "left")
    else:
        joined = salted_join(keyed, found, ["__rate_key"], "left")
    return joined.select(*accounts.columns, *newest.columns)

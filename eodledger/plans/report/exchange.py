"""Exchange rates of the report."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodledger.config import ReportConfig
from eodledger.operators.joins import validity_join
from eodledger.operators.rates import daily_close

# The price symbols read and the account currency each one serves.
PAIR_CURRENCY = {
    "EUR/USD": "EUR",
    "AUD/USD": "AUD",
    "GBP/USD": "GBP",
    "USD/CAD": "CAD",
    "USD/HKD": "HKD",
    "NZD/USD": "NZD",
    "USD/CNH": "CNH",
    "USD/CHF": "CHF",
    "USD/JPY": "JPY",
}


def exchange_rates(tables: Mapping[str, DataFrame], cfg: ReportConfig) -> DataFrame:
    """[day, symbol] Daily closes with the symbol settings valid on that day.

    Minute prices are reduced to closes before they meet the settings.
    """
    first_day = cfg.day - timedelta(days=cfg.price_days)
    prices = (
        tables["pricing_ohlc_minute"]
        .where(F.col("core_symbol").isin(*PAIR_CURRENCY))
        .where(F.col("timereceived_server") >= F.lit(first_day.isoformat()).cast("timestamp_ntz"))
        .select("core_symbol", "timereceived_server", F.col("close").alias("price"))
    )
    closes = daily_close(prices, "core_symbol", "timereceived_server", "price", ["price"])
    closes = closes.withColumn("plain", F.replace("core_symbol", F.lit("/"), F.lit("")))
    settings = tables["symbol_settings"].select(
        "symbol", "start_date", "last_active", "contractsize", "basecurrency", "type"
    )
    valid = validity_join(closes, settings, "plain", "day", "symbol", "start_date", "last_active")
    currencies = F.create_map(*[F.lit(x) for pair in PAIR_CURRENCY.items() for x in pair])
    return (
        valid.withColumn("ac", F.try_element_at(currencies, F.col("core_symbol")))
        .select(
            F.col("day").alias("dt_report"),
            "core_symbol",
            "symbol",
            "ac",
            "close",
            "contractsize",
            "basecurrency",
            "type",
        )
        .distinct()
    )

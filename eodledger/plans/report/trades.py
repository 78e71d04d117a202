"""Trades: deduplication, volumes, counts and lifetime profit."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodledger.config import ReportConfig
from eodledger.functions.times import (
    local_bucket_is,
    ntz,
    seconds_between,
    ymd_window,
)
from eodledger.operators.dedup import latest_per_key, rank_then_keep, union_latest
from eodledger.operators.joins import not_in
from eodledger.operators.measures import product_volumes, rounded_sum, state_counts

Tables = Mapping[str, DataFrame]

# The close time of a trade that is still open, and trade commands.
STILL_OPEN = datetime(1970, 1, 1)
MARKET = (0, 1)
PENDING = (2, 3, 4, 5)
SETTLED = (0, 1, 6, 7)
CREDIT = 7
COPIED_TRADE = "%from master trade%"

TRADE_COLUMNS = (
    "symbol",
    "cmd",
    "volume",
    "open_time",
    "close_time",
    "swaps",
    "commission",
    "commission_agent",
    "profit",
    "modify_time",
)
TRADE_KEY = ("server", "login", "ticket")
TRADE_TIES = ("close_time", "open_time", "cmd", "volume", "profit", "swaps", "commission", "symbol")


def _trades(df: DataFrame, cfg: ReportConfig) -> DataFrame:
    login = F.col("login").cast("string").alias("login")
    return df.where(~F.col("server").isin(*cfg.excluded_servers)).select(
        "server", login, "ticket", *TRADE_COLUMNS
    )


def _within_day(column: str, cfg: ReportConfig) -> Column:
    """The day before the report, closing midnight included."""
    return F.col(column).between(ntz(cfg.previous_start), ntz(cfg.day_start))


def _month(df: DataFrame, cfg: ReportConfig) -> DataFrame:
    return df.where(ymd_window(cfg.month_back, cfg.day))


def opened(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """Versions of trades opened on the day, several per ticket."""
    return _trades(_month(tables["report_server_trades_open"], cfg), cfg).where(_within_day("open_time", cfg))


def pending(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """Versions of pending orders placed on the day."""
    return _trades(tables["report_server_trades_pending_history"], cfg).where(_within_day("open_time", cfg))


def latest_trades(versions: DataFrame) -> DataFrame:
    """[server, login, ticket] Newest version."""
    return latest_per_key(versions, TRADE_KEY, "modify_time", TRADE_TIES)


def closed(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[server, login, ticket] Trades closed on the day and open nowhere.

    Ticket and server are compared as one text. The day is tested on the newest
    version only. The open-ticket test depends on nothing but the ranking key, so it
    may follow the ranking, where one day's trades are left instead of a month's
    versions.
    """
    key = F.concat(F.col("ticket").cast("string"), F.col("server"))
    still_open = tables["report_server_trades_open"].where(
        ~F.col("server").isin(*cfg.excluded_servers) & F.col("ticket").isNotNull()
    )
    month = _trades(_month(tables["report_server_trades_closed"], cfg), cfg)
    day = rank_then_keep(month, TRADE_KEY, "modify_time", _within_day("close_time", cfg), TRADE_TIES)
    return not_in(day, key, still_open, key)


def open_at_report(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """Open trades seen in exactly the report hour's bucket."""
    hour = cfg.report_time.replace(minute=0, second=0, microsecond=0)
    seen = _month(tables["report_server_trades_open_history"], cfg).where(
        local_bucket_is(F.col("utc_now"), cfg.report_tz, hour)
    )
    return _trades(seen, cfg)


def symbol_groups(tables: Tables) -> DataFrame:
    """[symbol, server] Product group of the newest symbol setting."""
    servers = tables["crm_servers"].select("server", "crm_server_id")
    groups = tables["crm_external_symbol_groups"].select(
        F.col("id").alias("group_id"), F.col("name").alias("symbol_group")
    )
    rows = (
        tables["crm_external_symbols"]
        .select(F.col("name").alias("symbol"), "trading_server_id", "external_symbol_group_id", "updated_at")
        .join(servers, F.col("trading_server_id") == F.col("crm_server_id"), "left")
        .join(groups, F.col("external_symbol_group_id") == F.col("group_id"), "left")
    )
    newest = latest_per_key(rows, ["symbol", "trading_server_id"], "updated_at", ["symbol_group", "server"])
    return newest.select("symbol", "symbol_group", "server")


def trade_volumes(closed_trades: DataFrame, groups: DataFrame, cfg: ReportConfig) -> DataFrame:
    """[server, login] Costs, profit and lots per product of the closed trades.

    Closed trades are free of open tickets already, so no second anti join is made.
    """
    rows = closed_trades.join(groups, ["symbol", "server"], "left")
    product = F.col("symbol_group")
    if cfg.variant.lower_product_label:
        product = F.lower(product)
    return rows.groupBy("server", "login").agg(
        rounded_sum(F.col("swaps")).alias("swaps"),
        rounded_sum(F.col("commission")).alias("commissions"),
        rounded_sum(F.col("profit")).alias("profit"),
        rounded_sum(F.col("swaps") + F.col("commission") + F.col("profit")).alias("sum_pnl"),
        *product_volumes(product, "volume", cfg.variant.products),
    )


def order_counts(opened_versions: DataFrame, closed_trades: DataFrame, pending_versions: DataFrame) -> DataFrame:
    """[server, login] Open, pending and closed counts and mean duration.

    Opened and pending versions are ranked here together with the closed trades; a
    rank within each set first would change nothing. The mean divides the seconds of
    market trades by the count of all settled ones.
    """
    newest = union_latest(
        [closed_trades, opened_versions, pending_versions], TRADE_KEY, "modify_time", TRADE_TIES
    )
    still_open = F.col("close_time") == ntz(STILL_OPEN)
    done = F.col("close_time") != ntz(STILL_OPEN)
    cmd = F.col("cmd")
    counts = state_counts(
        {
            "count_open_orders": still_open & cmd.isin(*MARKET),
            "count_pending_orders": still_open & cmd.isin(*PENDING),
            "count_closed_orders": done & cmd.isin(*SETTLED),
        },
        "ticket",
    )
    seconds = F.sum(
        F.when(done & cmd.isin(*MARKET), seconds_between(F.col("open_time"), F.col("close_time")))
    )
    return (
        newest.groupBy("server", "login")
        .agg(*counts, seconds.alias("seconds"))
        .withColumn("average_trade_duration", F.try_divide("seconds", "count_closed_orders"))
        .drop("seconds")
    )


def open_order_counts(open_trades: DataFrame) -> DataFrame:
    """[server, login] Distinct open tickets."""
    return open_trades.groupBy("server", "login").agg(F.count_distinct("ticket").alias("open_order_count"))


def lifetime_profit(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[server, login] Profit of all transactions so far.

    A ticket whose newest version is a credit does not count at all; versions copied
    from another account are set aside before ranking.
    """
    rows = (
        tables["report_server_trades_transactions"]
        .where(~F.col("server").isin(*cfg.excluded_servers))
        .where(ymd_window(None, cfg.day))
        .where(F.col("open_time") <= ntz(cfg.day_start))
        .where(~F.lower("comment").like(COPIED_TRADE))
        .select(
            "server",
            F.col("login").cast("string").alias("login"),
            "ticket",
            "profit",
            "cmd",
            "open_time",
            "utc_now",
        )
    )
    newest = rank_then_keep(
        rows,
        ["server", "ticket"],
        "utc_now",
        F.col("cmd") != CREDIT,
        ["open_time", "cmd", "profit", "login"],
    )
    return newest.groupBy("server", "login").agg(
        F.sum("profit").alias("profit_sum"), F.to_date(F.max("open_time")).alias("dt_report")
    )

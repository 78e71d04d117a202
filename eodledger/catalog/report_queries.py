"""The report and each of its parts over the derived inputs."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from eodledger.catalog.inputs import CONFIG_A, CONFIG_B, Derived
from eodledger.catalog.registry import registered
from eodledger.catalog.report_checks import check
from eodledger.config import ReportConfig
from eodledger.plans.report import accounts, exchange, final, money, trades
from eodledger.session import stored_stage

Inputs = Mapping[str, DataFrame]


def _part(name: str, cte: str, cfg: ReportConfig = CONFIG_A):
    def add(build: Callable[[Inputs, ReportConfig], DataFrame]):
        registered(name, check(cfg, cte))(lambda t: build(Derived(t), cfg))
        return build

    return add


@_part("account_state", "account_state")
def account_state(t, cfg):
    return accounts.account_state(t, cfg)


@_part("partner_names_b", "partner_names", CONFIG_B)
@_part("partner_names", "partner_names")
def partner_names(t, cfg):
    return accounts.partner_names(t, cfg)


@_part("users", "member_rows")
def users(t, cfg):
    return accounts.users(t, accounts.users_as_of(t, cfg))


def _accounts(t, cfg):
    return accounts.trading_accounts(t, cfg, accounts.trading_accounts_as_of(t, cfg))


@_part("trading_accounts_b", "trading_accounts", CONFIG_B)
@_part("trading_accounts", "trading_accounts")
def trading_accounts(t, cfg):
    return _accounts(t, cfg)


@_part("first_account_dates", "first_dates")
def first_account_dates(t, cfg):
    return accounts.first_account_dates(accounts.users_as_of(t, cfg), _accounts(t, cfg))


@_part("rebate_rates_b", "rebate_rates", CONFIG_B)
@_part("rebate_rates", "rebate_rates")
def rebate_rates(t, cfg):
    return accounts.rebate_rates(t, cfg)


@_part("wallet_balances", "wallet_balances")
def wallet_balances(t, cfg):
    return accounts.wallet_balances(t, cfg)


@_part("all_accounts_info", "all_accounts")
def all_accounts_info(t, cfg):
    known = accounts.users_as_of(t, cfg)
    return accounts.all_accounts(t, cfg, accounts.account_state(t, cfg), _accounts(t, cfg), known)


@_part("trades_open", "opened_trades")
def trades_open(t, cfg):
    return trades.latest_trades(trades.opened(t, cfg))


@_part("trades_pending", "pending_trades")
def trades_pending(t, cfg):
    return trades.latest_trades(trades.pending(t, cfg))


@_part("trades_closed", "closed_trades")
def trades_closed(t, cfg):
    return trades.closed(t, cfg)


@_part("trades_open_history", "open_at_report")
def trades_open_history(t, cfg):
    return trades.open_at_report(t, cfg)


@_part("symbol_groups", "symbol_groups")
def symbol_groups(t, cfg):
    return trades.symbol_groups(t)


@_part("trades_volume_b", "trade_volumes", CONFIG_B)
@_part("trades_volume", "trade_volumes")
def trades_volume(t, cfg):
    return trades.trade_volumes(trades.closed(t, cfg), trades.symbol_groups(t), cfg)


@_part("orders_count", "order_counts")
def orders_count(t, cfg):
    return trades.order_counts(trades.opened(t, cfg), trades.closed(t, cfg), trades.pending(t, cfg))


@_part("open_orders_count", "open_order_counts")
def open_orders_count(t, cfg):
    return trades.open_order_counts(trades.open_at_report(t, cfg))


@_part("trades_txn", "lifetime_profit")
def trades_txn(t, cfg):
    return trades.lifetime_profit(t, cfg)


@_part("day_transactions", "day_transactions")
def day_transactions(t, cfg):
    return money.day_transactions(t, cfg)


@_part("transactions", "transactions")
def transactions(t, cfg):
    return money.transactions(t, money.day_transactions(t, cfg))


@_part("wallet_rows", "wallet_rows")
def wallet_rows(t, cfg):
    return money.wallet_rows(t, cfg, accounts.users_as_of(t, cfg))


@_part("wallet_transactions_b", "wallet_transactions", CONFIG_B)
@_part("wallet_transactions", "wallet_transactions")
def wallet_transactions(t, cfg):
    return money.wallet_transactions(t, cfg, money.wallet_rows(t, cfg, accounts.users_as_of(t, cfg)))


@_part("exchange_rates", "exchange_rates")
def exchange_rates(t, cfg):
    return exchange.exchange_rates(t, cfg)


@_part("last_report", "last_report")
def last_report(t, cfg):
    return final.last_report(t, cfg)


@_part("first_report", "first_report")
def first_report(t, cfg):
    return final.first_report(t)


@_part("report_lc_b", "report_local", CONFIG_B)
@_part("report_lc", "report_local")
def report_lc(t, cfg):
    return final.local_report(final.report_parts(t, cfg, stored_stage(SparkSession.active())), cfg)


@_part("report_usd_b", "report_usd", CONFIG_B)
@_part("report_usd", "report_usd")
def report_usd(t, cfg):
    return final.equity_report(t, cfg, stored_stage(SparkSession.active()))

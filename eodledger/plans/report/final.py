"""The report itself: local-currency rows, conversion to USD, and the append."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodledger.config import ReportConfig
from eodledger.functions import amounts, texts
from eodledger.functions.times import ntz, to_report_tz
from eodledger.operators.dedup import first_per_key, latest_per_key
from eodledger.plans.report import accounts, exchange, money, trades
from eodledger.session import stored_stage
from eodledger.sources.tables import Warehouse, append_by_position

Tables = Mapping[str, DataFrame]
Stage = Callable[[str, DataFrame], DataFrame]

# The output columns in insert order. ``sixth`` stands for the product
# that differs between the two set-ups.
OUTPUT_COLUMNS = """
dt_report dt_report_insert report_jurisdiction login is_ib group user_id deposit withdraw
net_deposit credit credit_change swap commission agent forex_rebate bullion_rebate oil_rebate
cfd_rebate crypto_rebate {sixth}_rebate trade_cost cost_to_loss forex_vol bullion_vol oil_vol
cfd_vol crypto_vol {sixth}_vol profit pnl equity positive_equity equity_change last_balance
positive_balance used_credit negative_balance currency country member_sales_code ta_sales_code
margin margin_free margin_level leverage used_credit_change negative_balance_change
internal_transfer rebate instant_rebate adjustment misc member_register_date ta_register_date
member_first_ta_registration_date member_first_ib_ta_registration_date jurisdiction
final_jurisdiction trading_server comment member_lead_source ta_lead_source count_open_orders
count_pending_orders count_closed_orders average_trade_duration member_account_type member_type
is_cimb cimb_name cimb_cfd year month day sales_deposit sales_withdraw sales_net_deposit
internal_transfer_deposit_from_ib internal_transfer_withdrawal_to_ib
internal_transfer_from_same_category internal_transfer_to_same_category credit_txn points cfd
rollover misc_op split compensation misc_clear misc_tr misc_funding promo ib_rebate auto_rebate
cpa_rebate total_rebate lifetime_equity_change_usd
"""

# The tables read from the landing and the reporting schema, and the one
# appended to.
LANDING_INPUTS = """
report_server_users_history report_server_trades_open report_server_trades_open_history
report_server_trades_closed report_server_trades_pending_history report_server_trades_transactions
crm_users_history crm_member_account_has_languages crm_external_symbols crm_external_symbol_groups
crm_trading_accounts_history crm_trading_accounts_daily crm_trading_servers crm_trading_server_groups
crm_trading_server_group_has_commission_limits crm_transactions pricing_ohlc_minute symbol_settings
""".split()
REPORTING_INPUTS = """
crm_servers accounting_equity_report_jurisdiction transaction_comment_mapping accounting_t_1_equity_report
""".split()
REPORT_TABLE = "accounting_t_1_equity_report_delta"

# Columns that are kept although nothing fills them.
UNUSED_AMOUNTS = ("rebate", "instant_rebate", "adjustment", "misc")

# The wallet currency, and report columns taken from a measure.
WALLET_CURRENCY = "POINTS"
BASE_MEASURES = {
    "deposit": "deposit",
    "withdraw": "withdrawal",
    "net_deposit": "net_deposit",
    "internal_transfer": "internal_transfer",
    "sales_deposit": "sales_deposit",
    "sales_withdraw": "sales_withdrawal",
    "sales_net_deposit": "sales_net_deposit",
    "internal_transfer_deposit_from_ib": "internal_transfer_deposit_from_ib",
    "internal_transfer_withdrawal_to_ib": "internal_transfer_withdrawal_to_ib",
    "internal_transfer_from_same_category": "internal_transfer_from_same_category",
    "internal_transfer_to_same_category": "internal_transfer_to_same_category",
}
CATEGORY_MEASURES = {
    "credit_txn": "credit",
    "points": "points",
    "cfd": "cfd",
    "rollover": "rollover",
    "misc_op": "misc_op",
    "split": "split",
    "compensation": "compensation",
    "misc_clear": "misc_clear",
    "misc_tr": "misc_tr",
    "misc_funding": "misc_funding",
    "promo": "promo",
    "ib_rebate": "ib_rebate",
    "auto_rebate": "auto_rebate",
    "cpa_rebate": "cpa_rebate",
    "total_rebate": "tot_rebate",
}


def output_columns(cfg: ReportConfig) -> list[str]:
    return OUTPUT_COLUMNS.format(sixth=cfg.variant.sixth_product).split()


def last_report(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """Rows of the report one day earlier."""
    return tables["accounting_t_1_equity_report"].where(F.col("dt_report") == ntz(cfg.previous_start))


def first_report(tables: Tables) -> DataFrame:
    """[user_id, login, trading_server] First report row of each account."""
    rows = (
        tables["accounting_t_1_equity_report"]
        .where(F.col("user_id").isNotNull())
        .select("user_id", "login", "trading_server", "dt_report", "positive_equity")
    )
    return first_per_key(rows, ["user_id", "login", "trading_server"], "dt_report", ["positive_equity"])


@dataclass(frozen=True)
class Parts:
    """The frames the report joins."""

    accounts: DataFrame
    volumes: DataFrame
    orders: DataFrame
    open_orders: DataFrame
    transactions: DataFrame
    wallets: DataFrame
    wallet_balances: DataFrame
    partners: DataFrame
    profits: DataFrame
    last: DataFrame
    first: DataFrame
    rates: DataFrame


def _as_is(name: str, df: DataFrame) -> DataFrame:
    return df


def report_parts(tables: Tables, cfg: ReportConfig, stage: Stage = _as_is) -> Parts:
    """All parts, lazily. ``stage`` may materialise the frames several parts share."""
    known_users = stage("known_users", accounts.users_as_of(tables, cfg))
    known_accounts = accounts.trading_accounts_as_of(tables, cfg)
    ta = stage("trading_accounts", accounts.trading_accounts(tables, cfg, known_accounts))
    closed = stage("closed_trades", trades.closed(tables, cfg))
    return Parts(
        accounts=accounts.all_accounts(tables, cfg, accounts.account_state(tables, cfg), ta, known_users),
        volumes=trades.trade_volumes(closed, trades.symbol_groups(tables), cfg),
        orders=trades.order_counts(trades.opened(tables, cfg), closed, trades.pending(tables, cfg)),
        open_orders=trades.open_order_counts(trades.open_at_report(tables, cfg)),
        transactions=money.transactions(tables, stage("day_transactions", money.day_transactions(tables, cfg))),
        wallets=money.wallet_transactions(
            tables, cfg, stage("wallet_rows", money.wallet_rows(tables, cfg, known_users))
        ),
        wallet_balances=accounts.wallet_balances(tables, cfg),
        partners=accounts.partner_names(tables, cfg),
        profits=trades.lifetime_profit(tables, cfg),
        last=last_report(tables, cfg),
        first=first_report(tables),
        rates=exchange.exchange_rates(tables, cfg),
    )


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select([F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def _joined(parts: Parts) -> DataFrame:
    """The account rows with everything attached.

    The (server, login) aggregates come first and share one exchange; the two reads of
    earlier reports come last, so the final ranking finds its rows already in place.
    """
    rows = parts.accounts
    for prefix, df in (
        ("v_", parts.volumes),
        ("o_", parts.orders),
        ("oo_", parts.open_orders),
        ("t_", parts.transactions),
        ("p_", parts.profits),
    ):
        side = _prefixed(df, prefix)
        rows = rows.join(
            side,
            (F.col("server") == F.col(f"{prefix}server")) & (F.col("login") == F.col(f"{prefix}login")),
            "left",
        )
    wallets = _prefixed(parts.wallets, "w_")
    balances = _prefixed(parts.wallet_balances, "wb_")
    partners = _prefixed(parts.partners.select("name", "login", "rs_type"), "n_")
    last = _prefixed(
        parts.last.select("login", "trading_server", "positive_equity", "used_credit", "negative_balance"),
        "l_",
    )
    first = _prefixed(parts.first.select("login", "trading_server", "positive_equity"), "f_")

    login = F.col("login")
    rows = rows.join(wallets, login == F.col("w_login"), "left")
    rows = rows.join(
        balances,
        (login == F.col("wb_external_id").cast("string")) & (F.col("type") == F.col("wb_type")),
        "left",
    )
    rows = rows.join(partners, (login == F.col("n_login")) & (F.col("type") == F.col("n_rs_type")), "left")
    for prefix, df in (("l_", last), ("f_", first)):
        rows = rows.join(
            df,
            (login == F.col(f"{prefix}login").cast("string"))
            & (F.col("trading_server_name") == F.col(f"{prefix}trading_server")),
            "left",
        )
    return rows


def local_currency(parts: Parts, cfg: ReportConfig) -> DataFrame:
    """The report before conversion, still with its helper columns."""
    zero = amounts.zero_if_null
    is_wallet = F.col("type") == cfg.variant.wallet_code
    is_category_wallet = F.col("type") == cfg.variant.category_wallet_code
    volumes = list(cfg.variant.products)
    rebates = list(cfg.variant.rebate_groups)

    def unless_wallet(value: Column, wallet: Column | float = 0.0) -> Column:
        return F.when(is_wallet, wallet).otherwise(value)

    cost = amounts.weighted_cost([(F.col(f"v_{v}"), F.col(r)) for v, r in zip(volumes, rebates)])
    own = F.col("positive_equity")
    before = zero(F.col("l_positive_equity"))
    moved = zero(F.col("t_tot_txn"))
    balance = F.col("wb_wallet_balance")
    name = F.col("n_name")
    sixth = cfg.variant.sixth_product
    now_utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    run_time = now_utc if cfg.run_time is None else ntz(cfg.run_time)

    columns: dict[str, Column] = {
        "dt_report": ntz(cfg.bucket),
        "dt_report_insert": F.date_format(to_report_tz(run_time, cfg.report_tz), cfg.insert_time_format),
        "report_jurisdiction": F.col("jurisdiction"),
        "final_jurisdiction": F.when(F.col("group").like(accounts.VANUATU_GROUP), accounts.VANUATU).otherwise(
            F.col("jurisdiction")
        ),
        "credit": zero(F.col("credit")),
        "credit_change": F.coalesce("t_credit_change", "w_credit_change", F.lit(0.0)),
        "swap": zero(F.col("v_swaps")),
        "commission": zero(F.col("v_commissions")),
        "trade_cost": zero(F.round(unless_wallet(cost), 2)),
        "cost_to_loss": zero(F.round(unless_wallet(own - before - moved + zero(cost)), 2)),
        "profit": zero(F.col("v_profit")),
        "pnl": zero(unless_wallet(F.col("v_sum_pnl"))),
        "equity": zero(F.col("equity")),
        "positive_equity": zero(own),
        "equity_change": zero(F.round(unless_wallet(own - moved - before), 2)),
        "last_balance": zero(unless_wallet(F.col("balance"), balance)),
        "positive_balance": zero(unless_wallet(F.col("positive_balance"), balance)),
        "used_credit": zero(unless_wallet(F.col("used_credit"))),
        "negative_balance": zero(unless_wallet(F.col("negative_balance"))),
        "currency": F.when(is_wallet, WALLET_CURRENCY).otherwise(F.col("currency")),
        "ta_sales_code": F.col("salescode"),
        # Wallets report their balance in both change columns.
        "used_credit_change": F.round(
            zero(unless_wallet(F.col("used_credit"), balance)) - zero(F.col("l_used_credit")), 2
        ),
        "negative_balance_change": F.round(
            zero(unless_wallet(F.col("negative_balance"), balance)) - zero(F.col("l_negative_balance")), 2
        ),
        "member_register_date": F.col("member_registration_date"),
        "ta_register_date": F.col("ta_registration_date"),
        "trading_server": F.col("trading_server_name"),
        "count_open_orders": zero(F.col("oo_open_order_count")),
        "count_pending_orders": zero(F.col("o_count_pending_orders")),
        "count_closed_orders": zero(F.col("o_count_closed_orders")),
        "average_trade_duration": zero(F.col("o_average_trade_duration")),
        "member_account_type": F.coalesce("member_account_type", F.lit("")),
        "member_type": F.coalesce("member_type", F.lit("")),
        "is_cimb": F.when(name.isNull(), 0).otherwise(1),
        "cimb_name": F.when(name.isNull(), "")
        .when(name.like("%iress%"), "iress")
        .when(name.like("%insight%"), "insights"),
        "cimb_cfd": F.when(name.isNull(), "").otherwise(
            F.concat(F.lit("TM"), texts.part_after(F.lower(name), "tm"))
        ),
        "year": F.lit(f"{cfg.report_time:%Y}"),
        "month": F.lit(f"{cfg.report_time:%m}"),
        "day": F.lit(f"{cfg.report_time:%d}"),
        "lifetime_equity_change_lc": zero(own) - zero(F.col("f_positive_equity")) - zero(F.col("p_profit_sum")),
    }
    columns |= {c: zero(F.col(c)) for c in ("margin", "margin_free", "margin_level", "leverage")}
    columns |= {c: zero(F.col(c)) for c in rebates}
    columns |= {c: zero(F.col(f"v_{c}")) for c in volumes}
    columns |= {c: F.lit(0) for c in UNUSED_AMOUNTS}
    columns |= {
        out: zero(unless_wallet(F.col(f"t_{m}"), F.col(f"w_{m}"))) for out, m in BASE_MEASURES.items()
    }
    columns |= {
        out: zero(F.when(is_category_wallet, F.col(f"w_{m}")).otherwise(F.col(f"t_{m}")))
        for out, m in CATEGORY_MEASURES.items()
    }
    wanted = [c for c in output_columns(cfg) if c != "lifetime_equity_change_usd"]
    rows = _joined(parts).where(~F.upper("jurisdiction").like("%TEST%") | F.col("jurisdiction").isNull())
    return rows.select(
        *[columns.get(c, F.col(c)).alias(c) for c in (*wanted, "lifetime_equity_change_lc")],
        zero(F.col("f_positive_equity")).alias("ta_open_positive_equity"),
        zero(F.col("p_profit_sum")).alias("profit_sum"),
    )


def local_report(parts: Parts, cfg: ReportConfig) -> DataFrame:
    """The distinct rows before conversion. The finished report ranks them, and needs no exchange for this."""
    return local_currency(parts, cfg).distinct()


def to_report(local: DataFrame, rates: DataFrame, cfg: ReportConfig) -> DataFrame:
    """The finished report, one row per account, user and currency.

    Rates are found only for a report at midnight, and then the newest one is taken
    whatever its day. The newest rate per currency is at most one row for each of the
    listed pairs, so it is broadcast.
    """
    newest = F.broadcast(
        latest_per_key(rates, ["ac"], "dt_report", ["symbol", "close"]).select(
            "ac", F.col("symbol").alias("pair"), F.col("close").alias("rate")
        )
    )
    at_midnight = F.col("dt_report") <= F.to_date("dt_report").cast("timestamp_ntz")
    converted = local.join(newest, (F.col("currency") == F.col("ac")) & at_midnight, "left").withColumn(
        "lifetime_equity_change_usd",
        amounts.to_usd(
            F.col("lifetime_equity_change_lc"), F.col("currency"), F.col("pair"), F.col("rate")
        ),
    )
    # Rows equal in all of these are told apart by a hash of the whole row, which is narrower to sort than its columns.
    ties = ["positive_equity", "equity_change", "last_balance", "cimb_cfd", "member_account_type", "trade_cost"]
    one = latest_per_key(
        converted.withColumn("__row", F.xxhash64(*output_columns(cfg))),
        ["dt_report", "user_id", "login", "trading_server", "currency"],
        "ta_open_positive_equity",
        [*ties, "__row"],
    )
    return one.select(*output_columns(cfg))


def equity_report(tables: Tables, cfg: ReportConfig, stage: Stage = _as_is) -> DataFrame:
    parts = report_parts(tables, cfg, stage)
    return to_report(local_currency(parts, cfg), parts.rates, cfg)


def load_inputs(spark: SparkSession, warehouse: Warehouse) -> dict[str, DataFrame]:
    landing = {name: warehouse.landing_table(spark, name) for name in LANDING_INPUTS}
    return landing | {name: warehouse.reporting_table(spark, name) for name in REPORTING_INPUTS}


def run_daily_report(
    spark: SparkSession, warehouse: Warehouse, cfg: ReportConfig, stage: Stage | None = None
) -> None:
    """Read the warehouse, compute the report and append it to the report table.

    Frames that several parts share are written once below the shared folder, unless
    another ``stage`` is given.
    """
    report = equity_report(load_inputs(spark, warehouse), cfg, stage or stored_stage(spark))
    append_report(report, warehouse.reporting_name(REPORT_TABLE), cfg)


def append_report(report: DataFrame, table: str, cfg: ReportConfig) -> None:
    """Append to the report table by position."""
    append_by_position(report, table, output_columns(cfg))

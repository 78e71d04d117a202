"""Money movements: trade-server transactions and wallet transactions by measure."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodledger.config import ReportConfig, Variant
from eodledger.functions import texts
from eodledger.functions.times import ntz, on_days, ymd_window
from eodledger.operators.dedup import latest_per_key
from eodledger.operators.joins import like_template_join
from eodledger.operators.measures import Measure, sum_measures

Tables = Mapping[str, DataFrame]

# Commands and codes of money movements.
MONEY = 6
CREDIT = 7
DONE = 2
TRANSFER_CODE = 3
CREDIT_CODE = 4
ROLLOVER_CODE = 9
MISC_CODE = 10
REBATE_CODE = 11
TRANSFER = "Internal_Transfer"

# Measures known by the last segment of a report type, which is the
# measure name in capitals.
IB_TRANSFERS = ("internal_transfer_deposit_from_ib", "internal_transfer_withdrawal_to_ib")
CATEGORY_TRANSFERS = ("internal_transfer_from_same_category", "internal_transfer_to_same_category")

# Measures known by the first segment of a report type.
FIRST_SEGMENT = {
    "credit": "Credit",
    "points": "Points",
    "cfd": "CFD",
    "rollover": "Rollover",
    "misc_op": "MISC OP",
    "split": "Split",
    "compensation": "Compensation",
    "misc_clear": "MISC Clear",
    "misc_tr": "MISC TR",
    "misc_funding": "MISC FUNDING",
    "promo": "Promo",
}

# Measures known by the second segment of a report type.
REBATES = {
    "ib_rebate": "IB Rebate",
    "auto_rebate": "Auto Rebate",
    "cpa_rebate": "CPA Rebate",
}

TOTALS = {
    "tot_rebate": tuple(REBATES),
    "tot_txn": ("net_deposit", "internal_transfer", *FIRST_SEGMENT, *REBATES),
}


def trade_measures() -> list[Measure]:
    """Measures of trade-server transactions: by command and comment template."""
    money = F.col("cmd") == MONEY
    sales = F.col("sales_type")

    def headed(*labels: str) -> Column:
        return money & F.col("head").isin(*labels)

    def sold(*labels: str) -> Column:
        return money & (F.col("head").isin(*labels) | sales.isin(*labels))

    both = ("Deposit", "Withdrawal")
    measures = [
        Measure("deposit", headed("Deposit")),
        Measure("withdrawal", headed("Withdrawal")),
        Measure("net_deposit", headed(*both)),
        Measure("sales_deposit", sold("Deposit")),
        Measure("sales_withdrawal", sold("Withdrawal")),
        Measure("sales_net_deposit", sold(*both)),
        Measure("credit_change", F.col("cmd") == CREDIT),
        Measure("internal_transfer", headed(TRANSFER)),
    ]
    measures += [Measure(n, money & (F.col("tail") == n.upper())) for n in IB_TRANSFERS + CATEGORY_TRANSFERS]
    measures += [Measure(n, headed(label)) for n, label in FIRST_SEGMENT.items()]
    measures += [Measure(n, money & (F.col("second") == label)) for n, label in REBATES.items()]
    return measures


def wallet_measures(variant: Variant, extra_transfer_type: int) -> list[Measure]:
    """Measures of wallet transactions: by type code and comment template.

    A transaction without a template counts as a sales deposit but not as a deposit,
    because nothing is known to differ from a transfer.
    """
    code = F.col("type")
    into, out = variant.deposit_codes, variant.withdrawal_codes
    not_transfer = F.col("head") != TRANSFER
    transfer = code.isin(TRANSFER_CODE, extra_transfer_type)
    own_code = {
        "credit": CREDIT_CODE,
        "points": variant.points_code,
        "cfd": variant.cfd_code,
        "rollover": ROLLOVER_CODE,
    }
    measures = [
        Measure("deposit", code.isin(*into) & not_transfer),
        Measure("withdrawal", code.isin(*out) & not_transfer),
        Measure("net_deposit", code.isin(*into, *out) & not_transfer),
        Measure("sales_deposit", code.isin(*into)),
        Measure("sales_withdrawal", code.isin(*out)),
        Measure("sales_net_deposit", code.isin(*into, *out)),
        Measure("credit_change", code == CREDIT_CODE),
        Measure("internal_transfer", transfer),
    ]
    measures += [Measure(n, transfer & (F.col("tail") == n.upper())) for n in IB_TRANSFERS]
    measures += [Measure(n, (code == TRANSFER_CODE) & (F.col("tail") == n.upper())) for n in CATEGORY_TRANSFERS]
    measures += [
        Measure(n, (code == own_code.get(n, MISC_CODE)) & (F.col("head") == label))
        for n, label in FIRST_SEGMENT.items()
    ]
    measures += [Measure(n, (code == REBATE_CODE) & (F.col("second") == label)) for n, label in REBATES.items()]
    return measures


def _templates(tables: Tables) -> DataFrame:
    """Templates with their report type cut into segments, once per template."""
    kind = F.col("report_type")
    return tables["transaction_comment_mapping"].select(
        "comment_template",
        texts.segment(kind, 1).alias("head"),
        texts.segment(kind, 2).alias("second"),
        texts.segment(kind, -1).alias("tail"),
        "sales_type",
    )


def day_transactions(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[server, login, ticket] Newest version of the day's transactions."""
    rows = (
        tables["report_server_trades_transactions"]
        .where(~F.col("server").isin(*cfg.excluded_servers))
        .where(ymd_window(cfg.month_back, cfg.day))
        .where(F.col("open_time").between(ntz(cfg.previous_start), ntz(cfg.day_start)))
        .select(
            "server",
            F.col("login").cast("string").alias("login"),
            "ticket",
            "cmd",
            "profit",
            "comment",
            "open_time",
            "modify_time",
        )
    )
    return latest_per_key(
        rows, ["server", "login", "ticket"], "modify_time", ["open_time", "cmd", "profit", "comment"]
    )


def transactions(tables: Tables, day_rows: DataFrame) -> DataFrame:
    """[server, login] Transaction measures.

    Commands that feed no measure lose their comment beforehand, which saves matching
    it and cannot multiply them.
    """
    comment = F.when(F.col("cmd").isin(MONEY, CREDIT), F.col("comment")).alias("comment")
    rows = day_rows.select("server", "login", "cmd", "profit", comment)
    matched = like_template_join(rows, "comment", _templates(tables), "comment_template")
    return sum_measures(matched, ["server", "login"], "profit", trade_measures(), TOTALS)


def wallet_rows(tables: Tables, cfg: ReportConfig, known_users: DataFrame) -> DataFrame:
    """[id] Completed wallet transactions of the day before the report, without house users."""
    done = (
        tables["crm_transactions"]
        .where(F.col("external_id").like("%W%") & (F.col("status") == DONE) & F.col("deleted_at").isNull())
        .where(on_days(F.col("completed_at"), cfg.day_before, cfg.day))
        .select("id", "user_id", "external_id", "type", "fund_amount", "trading_server_comment", "updated_at")
    )
    newest = latest_per_key(
        done,
        ["id"],
        "updated_at",
        ["fund_amount", "type", "trading_server_comment", "external_id", "user_id"],
    )
    code = F.lower("sales_code")
    clients = known_users.where(texts.none_like(code, ("%9999%", "%test%"))).select(
        F.col("id").alias("client_id")
    )
    return newest.join(clients, F.col("user_id") == F.col("client_id"), "left_semi")


def wallet_transactions(tables: Tables, cfg: ReportConfig, rows: DataFrame) -> DataFrame:
    """[login] Wallet measures. All rows share one server label, so it is not grouped on."""
    amounts = rows.select(
        F.col("external_id").cast("string").alias("login"), "type", "fund_amount", "trading_server_comment"
    )
    matched = like_template_join(amounts, "trading_server_comment", _templates(tables), "comment_template")
    measures = wallet_measures(cfg.variant, cfg.extra_transfer_type)
    return sum_measures(matched, ["login"], "fund_amount", measures, TOTALS).withColumn(
        "server", F.lit("wallet")
    )

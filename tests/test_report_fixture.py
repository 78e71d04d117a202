"""The whole report on hand-written inputs, with results worked out by hand."""

from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from eodledger.config import VARIANT_A, VARIANT_B, ReportConfig
from eodledger.plans.report import final
from eodledger.session import stored_stage
from eodledger.sources.tables import Warehouse

D = datetime
EVE = D(2024, 7, 15)
DAY = D(2024, 7, 16)
NEVER = D(1970, 1, 1)
CFG = ReportConfig(
    report_time=DAY, excluded_servers=("demo",), report_tz="Europe/Athens", run_time=D(2024, 7, 16, 1, 2, 3)
)

NTZ = "timestamp_ntz"
TRADE = (
    f"server string, login bigint, ticket bigint, symbol string, cmd int, volume double, open_time {NTZ}, "
    f"close_time {NTZ}, swaps double, commission double, commission_agent double, profit double, modify_time {NTZ}"
)
YMD = "year int, month int, day int"
JULY_15 = (2024, 7, 15)


def snapshot(login, utc_now, name="Ann", group="real\\std", comment="ok", credit=0.0, equity=0.0, balance=0.0,
             currency="USD", server="live1"):
    return (server, login, name, group, comment, utc_now, credit, equity, balance, 1.0, 2.0, 3.0, 100.0,
            currency, D(2021, 1, 1), "web", utc_now.year, utc_now.month, utc_now.day)


def trade(ticket, symbol="EURUSD", cmd=0, volume=0.0, opened=D(2024, 7, 15, 8), closed=NEVER, swaps=0.0,
          commission=0.0, profit=0.0, modified=D(2024, 7, 15, 9), login=1001):
    return ("live1", login, ticket, symbol, cmd, volume, opened, closed, swaps, commission, 0.0, profit, modified)


def money(ticket, cmd, profit, comment, opened=D(2024, 7, 15, 8), modified=D(2024, 7, 15, 9), login=1001):
    return ("live1", login, ticket, cmd, profit, comment, opened, modified, modified, *JULY_15)


def account(id, type, external, user, parent=None, ib=0, sales="TA", deleted=None, known=D(2024, 7, 15)):
    return (id, type, external, user, parent, ib, sales, 77.0, D(2022, 1, id), known, deleted, known)


def user(id, country, sales="SC1", jurisdiction="Zone", known=D(2024, 7, 15)):
    return (id, known, known, country, "std", jurisdiction, sales, "lead", D(2020, 1, id))


INPUTS = {
    "crm_servers": (
        "server string, crm_server_id int, crm_server_name string, type string",
        [("live1", 1, "Live One", "Live"), ("wal", 3, "Wallet", "CRM Internal"), ("demo", 2, "Demo", "demo")],
    ),
    "report_server_users_history": (
        f"server string, login bigint, name string, group string, comment string, utc_now {NTZ}, credit double, "
        "equity double, balance double, margin double, margin_free double, margin_level double, leverage double, "
        f"currency string, regdate {NTZ}, lead_source string, {YMD}",
        [
            snapshot(1001, D(2024, 7, 15, 12), equity=100.0),
            # 00:10 local falls into the bucket of midnight, 00:35 does not
            snapshot(1001, D(2024, 7, 15, 21, 10), credit=50.0, equity=150.0, balance=90.0),
            snapshot(1001, D(2024, 7, 15, 21, 35), equity=999.0),
            snapshot(1002, D(2024, 7, 15, 12)),
            snapshot(1002, D(2024, 7, 15, 13), name="a test"),
            snapshot(1003, D(2024, 7, 15, 12), comment=None),
            snapshot(1004, D(2024, 7, 15, 12), credit=50.0, equity=-10.0, balance=-60.0, currency="EUR"),
            snapshot(1005, D(2024, 7, 15, 12), name="TM77 iress", equity=500.126, balance=500.0, currency="JPY"),
            snapshot(1006, D(2024, 7, 15, 12), equity=10.0, balance=20.0, currency="XXX", group="va\\one"),
            snapshot(1007, D(2024, 7, 15, 12), server="demo"),
            snapshot(728888, D(2024, 7, 15, 12)),
            snapshot(1008, D(2024, 7, 14, 12)),
            snapshot(1009, D(2024, 7, 15, 12), name="upper TEST stays", currency="EUR", equity=30.0, balance=30.0),
        ],
    ),
    "crm_users_history": (
        f"id bigint, rtz_now {NTZ}, updated_at {NTZ}, country string, member_account_type string, "
        f"jurisdiction string, sales_code string, lead_source string, created_at {NTZ}",
        [
            user(1, "uk"),
            user(1, "usa", known=D(2024, 7, 16, 0, 10)),
            user(1, "tw", known=D(2024, 7, 16, 0, 20)),
            user(2, "77"),
            user(3, None, sales=None),
            user(4, "au", jurisdiction="my Test"),
        ],
    ),
    "crm_member_account_has_languages": (
        "member_account_type_id string, language string, name string",
        [("std", "en", "Standard"), ("std", "zh", "x")],
    ),
    "accounting_equity_report_jurisdiction": (
        "user_jurisdiction string, accounting_equity_report_jurisdiction string",
        [("Zone", "Zone report")],
    ),
    "crm_trading_accounts_history": (
        f"id bigint, type int, external_id string, user_id bigint, parent_ta_id bigint, is_ib int, "
        f"salescode string, balance double, created_at {NTZ}, updated_at {NTZ}, deleted_at {NTZ}, rtz_now {NTZ}",
        [
            account(1, 1, "1001", 1, parent=0),
            account(4, 1, "1004", 2, parent=1),
            account(5, 1, "1005", 1),
            account(6, 1, "1006", 3, ib=1),
            account(7, 1, "1009", 4),
            account(9, 3, "W1", 1),
            account(10, 3, "W2", 1, deleted=D(2024, 7, 1)),
            account(11, 2, "1001", 1),
        ],
    ),
    "crm_trading_accounts_daily": (
        f"external_id string, type int, balance double, deleted_at {NTZ}, utc_now {NTZ}",
        [("W1", 3, 321.0, None, D(2024, 7, 15, 23, 59)), ("W1", 3, 9.0, None, DAY)],
    ),
    "crm_trading_servers": ("id int, name string", [(1, "Live One"), (3, "Wallet")]),
    "crm_trading_server_groups": (
        "id bigint, trading_server_id int, group string",
        [(50, 1, "real\\std"), (51, 3, "real\\std")],
    ),
    "crm_trading_server_group_has_commission_limits": (
        "trading_server_group_id bigint, external_symbol_group_id int, rbc double",
        [(50, g, 3.0 if g == 6 else 1.0) for g in VARIANT_A.rate_groups],
    ),
    "crm_external_symbols": (
        f"name string, trading_server_id int, external_symbol_group_id int, updated_at {NTZ}",
        [("EURUSD", 1, 2, D(2020, 1, 1)), ("EURUSD", 1, 1, D(2021, 1, 1))],
    ),
    "crm_external_symbol_groups": ("id int, name string", [(1, "Forex"), (2, "Oil")]),
    "report_server_trades_open": (
        f"{TRADE}, {YMD}",
        [(*trade(2), *JULY_15), (*trade(10), *JULY_15), (*trade(10, modified=D(2024, 7, 15, 10)), *JULY_15)],
    ),
    "report_server_trades_closed": (
        f"{TRADE}, {YMD}",
        [
            (*trade(1, volume=200.0, closed=DAY, swaps=1.0, commission=-2.0, profit=10.0), *JULY_15),
            (*trade(2, volume=900.0, closed=D(2024, 7, 15, 9)), *JULY_15),
            (*trade(3, volume=900.0, closed=D(2024, 7, 15, 9)), *JULY_15),
            (*trade(3, closed=D(2024, 7, 14, 9), modified=D(2024, 7, 15, 11)), *JULY_15),
            (*trade(4, symbol="none", cmd=6, closed=D(2024, 7, 15, 8, 0, 10), swaps=1.0, commission=None, profit=5.0), *JULY_15),
        ],
    ),
    "report_server_trades_pending_history": (TRADE, [trade(20, cmd=2)]),
    "report_server_trades_open_history": (
        f"{TRADE}, utc_now {NTZ}, {YMD}",
        [
            (*trade(10), D(2024, 7, 15, 21, 10), *JULY_15),
            (*trade(10), D(2024, 7, 15, 21, 20), *JULY_15),
            (*trade(11), D(2024, 7, 15, 21, 40), *JULY_15),
        ],
    ),
    "report_server_trades_transactions": (
        f"server string, login bigint, ticket bigint, cmd int, profit double, comment string, open_time {NTZ}, "
        f"modify_time {NTZ}, utc_now {NTZ}, {YMD}",
        [
            money(100, 6, 100.0, "Deposit bonus"),
            money(101, 6, 7.0, "credit", modified=D(2024, 7, 15, 8)),
            money(101, 7, 9.0, "credit"),
            money(102, 6, 5.0, None),
            money(103, 6, -30.0, "WITHDRAW", opened=EVE),
            money(104, 6, 1000.0, "Deposit", opened=D(2024, 7, 14, 23, 59)),
            money(105, 6, 1.0, "Copy from Master trade 7"),
        ],
    ),
    "crm_transactions": (
        f"id bigint, user_id bigint, external_id string, type int, status int, fund_amount double, "
        f"trading_server_comment string, completed_at {NTZ}, updated_at {NTZ}, deleted_at {NTZ}",
        [
            (1, 1, "W1", 1, 2, 40.0, "no template", D(2024, 7, 15, 5), EVE, None),
            (2, 1, "W1", 3, 2, 15.0, "sent from ib", D(2024, 7, 15, 5), EVE, None),
            (3, 1, "W1", 1, 1, 500.0, "deposit", D(2024, 7, 15, 5), EVE, None),
            (4, 1, "W1", 1, 2, 500.0, "deposit", DAY, EVE, None),
            (5, 3, "W1", 1, 2, 500.0, "deposit", D(2024, 7, 15, 5), EVE, None),
        ],
    ),
    "transaction_comment_mapping": (
        "comment_template string, report_type string, sales_type string",
        [
            ("%deposit%", "Deposit-Bank", None),
            ("%BONUS%", "Promo", None),
            ("withdraw%", "Withdrawal", None),
            ("%from ib", "Internal_Transfer-INTERNAL_TRANSFER_DEPOSIT_FROM_IB", None),
        ],
    ),
    "pricing_ohlc_minute": (
        f"core_symbol string, timereceived_server {NTZ}, close double",
        [
            ("EUR/USD", D(2024, 7, 14, 12), 1.1),
            ("EUR/USD", D(2024, 7, 15, 12), 1.15),
            ("EUR/USD", D(2024, 7, 15, 23, 59), 1.2),
            ("USD/JPY", D(2024, 7, 15, 12), 150.0),
            ("XAU/USD", D(2024, 7, 15, 12), 2000.0),
        ],
    ),
    "symbol_settings": (
        "symbol string, start_date date, last_active date, contractsize double, basecurrency string, type string",
        [
            ("EURUSD", date(2024, 7, 1), date(2024, 7, 15), 1.0, "EUR", "fx"),
            ("USDJPY", date(2024, 7, 1), date(2024, 7, 31), 1.0, "USD", "fx"),
        ],
    ),
    "accounting_t_1_equity_report": (
        f"user_id bigint, login string, trading_server string, dt_report {NTZ}, positive_equity double, "
        "used_credit double, negative_balance double",
        [
            (1, "1001", "Live One", EVE, 80.0, -5.0, -1.0),
            (1, "1001", "Live One", D(2024, 1, 1), 50.0, 0.0, 0.0),
            (None, "1005", "Live One", D(2024, 1, 1), 9.0, 0.0, 0.0),
        ],
    ),
}


@pytest.fixture(scope="module")
def tables(spark):
    return {
        name: spark.createDataFrame(data, T.StructType.fromDDL(ddl)) for name, (ddl, data) in INPUTS.items()
    }


@pytest.fixture(scope="module")
def report(tables):
    found = final.equity_report(tables, CFG).collect()
    return {row["login"]: row.asDict() for row in found}


def test_population(report):
    assert set(report) == {"1001", "1004", "1005", "1006", "W1"}


def test_usd_account(report):
    row = report["1001"]
    expected = dict(
        dt_report=DAY,
        dt_report_insert="2024-07-16 04:07:03",
        user_id=1,
        country="UNITED STATES",
        member_type="Clients With IB",
        agent=None,
        equity=150.0,
        credit=50.0,
        used_credit=0.0,
        positive_equity=100.0,
        deposit=100.0,
        withdraw=-30.0,
        net_deposit=70.0,
        promo=100.0,
        credit_change=9.0,
        swap=2.0,
        commission=-2.0,
        profit=15.0,
        pnl=9.0,
        forex_vol=2.0,
        oil_vol=0.0,
        forex_rebate=3.0,
        trade_cost=6.0,
        equity_change=100.0 - 170.0 - 80.0,
        cost_to_loss=100.0 - 80.0 - 170.0 + 6.0,
        used_credit_change=5.0,
        negative_balance_change=1.0,
        count_open_orders=1,
        count_pending_orders=1,
        count_closed_orders=2,
        # sixteen hours of the market trade over two settled ones
        average_trade_duration=8 * 3600.0,
        # lifetime profit reaches further back than the day: 100, -30 and 1000
        lifetime_equity_change_usd=100.0 - 50.0 - 1070.0,
        year="2024",
        month="07",
        day="16",
        is_cimb=0,
        cimb_cfd="",
        member_account_type="Standard",
        member_first_ta_registration_date=D(2022, 1, 1),
        member_first_ib_ta_registration_date=None,
        rebate=0,
    )
    assert {k: row[k] for k in expected} == expected


def test_underwater_account(report):
    row = report["1004"]
    assert (row["used_credit"], row["positive_equity"], row["negative_balance"]) == (-50.0, 0.0, -60.0)
    assert (row["positive_balance"], row["last_balance"], row["agent"]) == (0.0, -60.0, "1001")
    assert row["country"] == "UNKNOWN OR INVALID REGION"
    assert row["member_type"] == "Clients With IB"


def test_quote_currency_and_partner_name(report):
    row = report["1005"]
    assert row["positive_equity"] == 500.13
    assert row["lifetime_equity_change_usd"] == round(500.13 / 150.0, 2)
    assert (row["is_cimb"], row["cimb_name"], row["cimb_cfd"]) == (1, "iress", "TM77 iress")
    assert row["member_type"] == "Retail Client"


def test_unknown_currency_and_va_group(report):
    row = report["1006"]
    assert row["lifetime_equity_change_usd"] == 0.0
    assert (row["final_jurisdiction"], row["jurisdiction"], row["is_ib"]) == ("Vanuatu", "Zone", "True")
    assert row["member_first_ib_ta_registration_date"] == D(2022, 1, 6)
    # no group rates: the cost is unknown and reported as zero
    assert row["trade_cost"] == 0.0


def test_wallet(report):
    row = report["W1"]
    expected = dict(
        currency="POINTS",
        sales_deposit=40.0,
        deposit=0.0,
        internal_transfer=15.0,
        internal_transfer_deposit_from_ib=15.0,
        last_balance=321.0,
        used_credit=0.0,
        used_credit_change=321.0,
        trading_server="Wallet",
        lifetime_equity_change_usd=0.0,
    )
    assert {k: row[k] for k in expected} == expected


def test_base_currency_uses_newest_rate(tables):
    euro = dict(tables)
    users = tables["crm_users_history"]
    euro["crm_users_history"] = users.replace("my Test", "Zone", ["jurisdiction"])
    row = {r["login"]: r for r in final.equity_report(euro, CFG).collect()}["1009"]
    assert row["lifetime_equity_change_usd"] == 36.0


def test_no_rate_off_midnight(tables):
    late = replace(CFG, report_time=D(2024, 7, 16, 0, 40))
    found = {r["login"]: r for r in final.equity_report(tables, late).collect()}
    assert found["1005"]["lifetime_equity_change_usd"] == 0.0
    assert found["1001"]["dt_report"] == D(2024, 7, 16, 0, 30)


def test_staged_report_is_the_same(spark, tables, report):
    staged = final.equity_report(tables, CFG, stored_stage(spark)).collect()
    assert {r["login"]: r.asDict() for r in staged} == report


def test_variant_b(tables):
    cfg = replace(CFG, variant=VARIANT_B)
    found = {r["login"]: r for r in final.equity_report(tables, cfg).collect()}
    assert found["1001"]["shares_vol"] == 0.0
    # the label is compared with its case there
    assert found["1001"]["forex_vol"] == 0.0
    # a wallet of type 3 is an ordinary account there
    assert found["W1"]["currency"] is None


def test_append_by_position(spark, tables, report):
    df = final.equity_report(tables, CFG)
    columns = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(df.schema))
    spark.sql(f"CREATE TABLE report_target ({columns}) USING parquet")
    final.append_report(df, "report_target", CFG)
    back = spark.table("report_target")
    assert back.count() == len(report)
    assert {r["c3"] for r in back.collect()} == set(report)


def test_daily_run_over_warehouse_tables(spark, tables, report):
    spark.sql("CREATE DATABASE IF NOT EXISTS land")
    spark.sql("CREATE DATABASE IF NOT EXISTS rep")
    assert set(final.LANDING_INPUTS) | set(final.REPORTING_INPUTS) == set(INPUTS)
    for name, df in tables.items():
        schema = "land" if name in final.LANDING_INPUTS else "rep"
        df.write.mode("overwrite").saveAsTable(f"{schema}.{name}")
    house = Warehouse(landing="land", reporting="rep")
    empty = final.equity_report(final.load_inputs(spark, house), CFG).where("false")
    empty.write.mode("overwrite").saveAsTable(f"rep.{final.REPORT_TABLE}")
    final.run_daily_report(spark, house, CFG, stored_stage(spark))
    saved = spark.table(f"rep.{final.REPORT_TABLE}").collect()
    assert {r["login"]: r.asDict() for r in saved} == report


def test_rows_unique(tables):
    df = final.equity_report(tables, CFG)
    key = ["dt_report", "user_id", "login", "trading_server", "currency"]
    assert df.groupBy(*key).count().where("count > 1").isEmpty()

"""Report inputs derived from the given tables.

The report reads brokerage tables that are not among the given ones. Each is derived
here by SQL that Spark and the checking engine both accept: customers become users,
accounts and snapshots, line items become trades, orders become transactions and events
become prices. Spark stores the result in the shared folder. ``[ts]`` and ``[str]`` stand for the engine's names of two types. Amounts
are quarters, so sums do not depend on their order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eodledger.config import VARIANT_A, VARIANT_B, ReportConfig
from eodledger.session import scratch_path
from eodledger.sources.tables import DAY_SPLIT

REPORT = dict(
    report_time=datetime(2024, 1, 16),
    excluded_servers=("srv4",),
    report_tz="+02:00",
    run_time=datetime(2024, 1, 16, 3, 45, 10),
)
CONFIG_A = ReportConfig(variant=VARIANT_A, wallet_types=(3,), **REPORT)
CONFIG_B = ReportConfig(variant=VARIANT_B, wallet_types=(9,), other_types=(7,), **REPORT)

SERVER_ID = "CASE c_nationkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 7 ELSE 2 END"
SERVER = "'srv' || CAST(c_nationkey % 5 AS [str])"


def at(moment: str) -> str:
    return f"CAST('{moment}' AS [ts])"


def stacked(*selects: str) -> str:
    return " UNION ALL ".join(selects)


def split_date(ts: str) -> str:
    return f"year({ts}) AS year, month({ts}) AS month, day({ts}) AS day"


def _snapshot(utc_now: str, version: int) -> str:
    return f"""
    SELECT {SERVER} AS server, c_custkey + 100000 AS login,
      CASE c_custkey % 9 WHEN 0 THEN 'TM' || CAST(c_custkey AS [str]) || ' iress'
        WHEN 1 THEN 'tm' || CAST(c_custkey AS [str]) || ' by insight'
        WHEN 2 THEN 'a test name' ELSE c_name END AS name,
      CASE WHEN c_custkey % 29 = 0 THEN 'real' || chr(92) || 'hf one'
        WHEN c_custkey % 31 = 0 THEN 'Mam' || chr(92) || 'pool'
        WHEN c_custkey % 37 = 0 THEN 'va' || chr(92) || 'system'
        WHEN c_custkey % 7 = 0 THEN 'va' || chr(92) || lower(c_mktsegment)
        ELSE 'real' || chr(92) || lower(c_mktsegment) END AS group,
      CASE WHEN c_custkey % 41 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN 'ALLOC=7'
        WHEN c_custkey % 47 = {version} THEN 'IA:0;x' ELSE 'ordinary' END AS comment,
      {utc_now} AS utc_now,
      CASE WHEN c_custkey % 4 = 0 THEN CAST(4000 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS credit,
      CAST(floor(c_acctbal) + {version} AS DOUBLE) AS equity,
      CAST(floor(c_acctbal) - 20 AS DOUBLE) AS balance,
      CAST(c_custkey % 100 AS DOUBLE) AS margin, CAST(c_custkey % 90 AS DOUBLE) AS margin_free,
      CAST(c_custkey % 80 AS DOUBLE) AS margin_level, CAST(100 AS DOUBLE) AS leverage,
      CASE c_custkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'JPY' WHEN 3 THEN 'AUD'
        ELSE 'XYZ' END AS currency,
      {at('2021-01-01 00:00:00')} + c_custkey * INTERVAL '1' HOUR AS regdate, 'web' AS lead_source,
      {split_date(utc_now)}
    FROM {{customer}}"""


def _user(rtz_now: str, version: int) -> str:
    return f"""
    SELECT c_custkey AS id, {at(rtz_now)} AS rtz_now, {at(rtz_now)} AS updated_at,
      CASE c_nationkey % 7 WHEN 0 THEN 'au' WHEN 1 THEN 'Hongkong' WHEN 2 THEN 'UK' WHEN 3 THEN '12345'
        WHEN 4 THEN 'Land 1' WHEN 5 THEN NULL ELSE '中国' END AS country,
      c_mktsegment AS member_account_type,
      CASE WHEN (c_custkey + {version}) % 53 = 0 THEN 'Test zone'
        WHEN c_custkey % 15 = 0 THEN NULL ELSE 'Zone ' || CAST(c_nationkey % 5 AS [str]) END AS jurisdiction,
      CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN 'A Test'
        WHEN c_custkey % 61 = 0 THEN 'S9999' ELSE 'SC' || CAST(c_custkey % 7 AS [str]) END AS sales_code,
      'lead' || CAST({version} AS [str]) AS lead_source,
      {at('2020-01-01 00:00:00')} + c_custkey * INTERVAL '1' HOUR AS created_at
    FROM {{customer}}"""


def _account(rtz_now: str, version: int, wallet: bool) -> str:
    identity = (
        "c_custkey * 10 + 1 AS id, CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 9 END AS type, "
        "'W' || CAST(c_custkey AS [str]) AS external_id"
        if wallet
        else f"c_custkey * 10 AS id, {SERVER_ID} AS type, CAST(c_custkey + 100000 AS [str]) AS external_id"
    )
    return f"""
    SELECT {identity}, c_custkey AS user_id,
      CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 0
        ELSE (c_custkey % 20) * 10 END AS parent_ta_id,
      CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 0 END AS is_ib,
      CASE WHEN c_custkey % 67 = 0 THEN 'T9999' ELSE 'TA' || CAST(c_custkey % 5 AS [str]) END AS salescode,
      CAST(floor(c_acctbal) + {version} AS DOUBLE) AS balance,
      {at('2022-01-01 00:00:00')} + c_custkey * INTERVAL '1' HOUR AS created_at,
      {at(rtz_now)} AS updated_at,
      CASE WHEN c_custkey % 71 = {version} THEN {at(rtz_now)} ELSE NULL END AS deleted_at,
      {at(rtz_now)} AS rtz_now
    FROM {{customer}}"""


def _trades(where: str, cmd: str, close_time: str, extra: str = "") -> str:
    return f"""
    SELECT server, login, ticket, symbol, {cmd} AS cmd, volume, open_time, {close_time} AS close_time,
      swaps, commission, CAST(0 AS DOUBLE) AS commission_agent, profit, modify_time,
      {extra or split_date('open_time')}
    FROM {{all_trades}} WHERE {where}"""


def _transaction(version: int, where: str) -> str:
    cmd = (
        "7"
        if version
        else "CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 7 ELSE 6 END"
    )
    return f"""
    SELECT {SERVER} AS server, c_custkey + 100000 AS login, o_orderkey AS ticket, {cmd} AS cmd,
      CAST(CAST(floor(o_totalprice) AS BIGINT) % 4000 - 2000 + {version} AS DOUBLE) / 4 AS profit,
      {COMMENT.format(pick="o_orderkey % 21")} AS comment,
      {at('2024-01-14 12:00:00')} + ((o_orderkey * 53) % 4320) * INTERVAL '1' MINUTE AS open_time,
      {at('2024-01-15 12:00:00')} + ((o_orderkey * 53) % 600 + {version}) * INTERVAL '1' MINUTE AS modify_time,
      {at('2024-01-15 13:00:00')} + ((o_orderkey * 53) % 600 + {version}) * INTERVAL '1' MINUTE AS utc_now,
      2024 AS year, 1 AS month, CAST(14 + (o_orderkey % 3) AS INT) AS day
    FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey WHERE {where}"""


def _wallet_transaction(version: int, where: str) -> str:
    return f"""
    SELECT o_orderkey AS id, o_custkey AS user_id, 'W' || CAST(o_custkey AS [str]) AS external_id,
      CAST(o_orderkey % 14 AS INT) AS type, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS status,
      CAST(CAST(floor(o_totalprice) AS BIGINT) % 3000 - 1000 + {version} AS DOUBLE) / 4 AS fund_amount,
      {COMMENT.format(pick="CAST(floor(o_orderkey / 14) AS BIGINT) % 21")} AS trading_server_comment,
      {at('2024-01-14 12:00:00')} + ((o_orderkey * 71) % 4320) * INTERVAL '1' MINUTE AS completed_at,
      {at('2024-01-15 00:00:00')} + {version} * INTERVAL '1' MINUTE AS updated_at,
      CASE WHEN o_orderkey % 73 = 0 THEN {at('2024-01-15 00:00:00')} ELSE NULL END AS deleted_at
    FROM {{orders}} WHERE {where}"""


def _earlier_report(day: str, version: int, wallet: bool) -> str:
    login = "'W' || CAST(c_custkey AS [str])" if wallet else "CAST(c_custkey + 100000 AS [str])"
    server = "'Wallet'" if wallet else "'Server ' || r_name"
    return f"""
    SELECT CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey END AS user_id, {login} AS login,
      {server} AS trading_server, {at(day)} AS dt_report,
      CAST(floor(abs(c_acctbal)) + {version} AS DOUBLE) AS positive_equity,
      CAST(-{version} AS DOUBLE) AS used_credit, CAST(-(c_custkey % 3) AS DOUBLE) AS negative_balance
    FROM {{customer}} JOIN {{region}} ON r_regionkey = c_nationkey % 5"""


COMMENT = """CASE {pick} WHEN 0 THEN 'Deposit by card #' || CAST(o_orderkey % 100 AS [str])
        WHEN 1 THEN 'bank WITHDRAW' WHEN 2 THEN 'Transfer from IB 55' WHEN 3 THEN 'transfer to friend'
        WHEN 4 THEN 'IB rebate' WHEN 5 THEN 'auto rebate May' WHEN 6 THEN 'CPA rebate' WHEN 7 THEN 'points 12'
        WHEN 8 THEN 'promo gift' WHEN 9 THEN 'copied from master trade 12' WHEN 10 THEN NULL
        WHEN 11 THEN 'credit in' WHEN 12 THEN 'misc op 3' WHEN 13 THEN 'cfd dividend' WHEN 14 THEN 'rollover'
        WHEN 15 THEN 'funding fee'
        WHEN 16 THEN 'stock split' WHEN 17 THEN 'clear old' WHEN 18 THEN 'TR 8'
        WHEN 19 THEN 'moved from own account' ELSE 'transfer back to IB' END"""

TEMPLATES = [
    ("%deposit%", "Deposit-Card", None),
    ("%withdraw%", "Withdrawal-Bank", None),
    ("%transfer from ib%", "Internal_Transfer-INTERNAL_TRANSFER_DEPOSIT_FROM_IB", None),
    ("transfer to%", "Internal_Transfer-INTERNAL_TRANSFER_TO_SAME_CATEGORY", "Withdrawal"),
    ("%back to ib", "Internal_Transfer-INTERNAL_TRANSFER_WITHDRAWAL_TO_IB", None),
    ("%ib rebate%", "Rebate-IB Rebate", "Deposit"),
    ("%auto rebate%", "Rebate-Auto Rebate", None),
    ("cpa rebate%", "Rebate-CPA Rebate", None),
    ("points%", "Points", None),
    ("%promo%", "Promo", None),
    ("%gift%", "Promo-Gift", None),
    ("credit%", "Credit", None),
    ("misc op%", "MISC OP", None),
    ("%cfd%", "CFD", None),
    ("roll_ver", "Rollover", None),
    ("%funding%", "MISC FUNDING", None),
    ("%fee", "Compensation", None),
    ("%split", "Split", None),
    ("clear%", "MISC Clear", None),
    ("tr _", "MISC TR", None),
    ("moved from%", "Internal_Transfer-INTERNAL_TRANSFER_FROM_SAME_CATEGORY", "Deposit"),
]

LIVE_SERVER_IDS = (1, 4, 5, 7)
RATE_GROUP_IDS = VARIANT_A.rate_groups + VARIANT_B.rate_groups
GROUP_OF_TYPE = (
    "CASE p_type WHEN 'ECONOMY' THEN 6 WHEN 'SMALL' THEN 7 WHEN 'MEDIUM' THEN 8 WHEN 'PROMO' THEN 10 "
    "WHEN 'STANDARD' THEN 11 ELSE CASE WHEN p_partkey % 2 = 0 THEN 13 ELSE 17 END END"
)


def _text(value: str | None) -> str:
    return "CAST(NULL AS [str])" if value is None else f"'{value}'"


DERIVED: dict[str, str] = {
    "crm_servers": f"""
    SELECT 'srv' || CAST(r_regionkey AS [str]) AS server,
      CASE r_regionkey WHEN 0 THEN 1 WHEN 1 THEN 4 WHEN 2 THEN 5 WHEN 3 THEN 7 ELSE 2 END AS crm_server_id,
      'Server ' || r_name AS crm_server_name,
      CASE WHEN r_regionkey = 4 THEN 'Demo' ELSE 'Live' END AS type FROM {{region}}
    UNION ALL SELECT 'wallet3', 3, 'Wallet', 'CRM internal'
    UNION ALL SELECT 'wallet9', 9, 'Wallet', 'CRM internal'""",
    "crm_trading_servers": "SELECT crm_server_id AS id, crm_server_name AS name FROM {crm_servers}",
    "report_server_users_history": stacked(
        _snapshot(at("2024-01-14 20:00:00"), 0),
        _snapshot(f"{at('2024-01-15 12:00:00')} + (c_custkey % 60) * INTERVAL '1' MINUTE", 1),
        _snapshot(at("2024-01-15 22:10:00"), 2) + " WHERE c_custkey % 2 = 0",
        _snapshot(at("2024-01-15 22:40:00"), 3),
    ),
    "crm_users_history": stacked(
        _user("2024-01-15 00:00:00", 0), _user("2024-01-16 00:10:00", 1), _user("2024-01-16 01:00:00", 2)
    ),
    "crm_member_account_has_languages": stacked(
        "SELECT DISTINCT c_mktsegment AS member_account_type_id, 'en' AS language, "
        "'Type ' || c_mktsegment AS name FROM {customer}",
        "SELECT DISTINCT c_mktsegment, 'zh', 'other' FROM {customer}",
    ),
    "accounting_equity_report_jurisdiction": """
    SELECT 'Zone ' || CAST(r_regionkey AS [str]) AS user_jurisdiction,
      r_name AS accounting_equity_report_jurisdiction FROM {region}""",
    "crm_trading_accounts_history": stacked(
        *[
            _account(rtz_now, version, wallet)
            for wallet in (False, True)
            for version, rtz_now in enumerate(
                ("2024-01-15 00:00:00", "2024-01-16 00:15:00", "2024-01-16 02:00:00")
            )
        ]
    ),
    "crm_trading_accounts_daily": f"""
    SELECT 'W' || CAST(c_custkey AS [str]) AS external_id,
      CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 9 END AS type, CAST(floor(c_acctbal) AS DOUBLE) AS balance,
      CASE WHEN c_custkey % 79 = 0 THEN {at('2024-01-15 00:00:00')} ELSE NULL END AS deleted_at,
      {at('2024-01-15 06:00:00')} + (c_custkey % 3) * INTERVAL '12' HOUR AS utc_now FROM {{customer}}""",
    "crm_trading_server_groups": f"""
    SELECT DISTINCT {SERVER_ID} * 100 + ascii(c_mktsegment) AS id, {SERVER_ID} AS trading_server_id,
      'real' || chr(92) || lower(c_mktsegment) AS group FROM {{customer}}""",
    "crm_trading_server_group_has_commission_limits": stacked(
        *[
            f"SELECT id AS trading_server_group_id, {g} AS external_symbol_group_id, "
            f"CAST(1 + (id + {g}) % 3 AS DOUBLE) AS rbc FROM {{crm_trading_server_groups}} "
            f"WHERE (id + {g}) % 17 <> 0"
            for g in RATE_GROUP_IDS
        ]
    ),
    "crm_external_symbols": stacked(
        *[
            f"SELECT 'SYM' || CAST(p_partkey AS [str]) AS name, {server} AS trading_server_id, "
            f"{GROUP_OF_TYPE} AS external_symbol_group_id, {at('2023-01-01 00:00:00')} AS updated_at FROM {{part}}"
            for server in LIVE_SERVER_IDS
        ],
        f"SELECT 'SYM' || CAST(p_partkey AS [str]), 1, 6, {at('2023-02-01 00:00:00')} FROM {{part}} WHERE p_size = 1",
    ),
    "crm_external_symbol_groups": f"""
    SELECT DISTINCT {GROUP_OF_TYPE} AS id,
      CASE {GROUP_OF_TYPE} WHEN 6 THEN 'forex' WHEN 7 THEN 'bullion' WHEN 8 THEN 'Oil' WHEN 10 THEN 'cfd'
        WHEN 11 THEN 'crypto' WHEN 13 THEN 'FX Exotics' ELSE 'shares' END AS name FROM {{part}}""",
    "all_trades": f"""
    SELECT {SERVER} AS server, c_custkey + 100000 AS login, l_orderkey * 10 + l_linenumber AS ticket,
      'SYM' || CAST(l_partkey AS [str]) AS symbol, l_quantity AS volume, l_linestatus, l_returnflag,
      l_linenumber, l_suppkey,
      {at('2024-01-14 12:00:00')} + ((l_orderkey * 37 + l_linenumber * 101) % 4320) * INTERVAL '1' MINUTE
        AS open_time,
      {at('2024-01-14 12:00:00')} + ((l_orderkey * 37 + l_linenumber * 101) % 4320) * INTERVAL '1' MINUTE
        + (CAST(l_quantity AS BIGINT) * 1237) * INTERVAL '1' SECOND AS end_time,
      {at('2024-01-15 00:00:00')} + ((l_partkey * 7 + l_suppkey) % 1000) * INTERVAL '1' SECOND AS modify_time,
      CAST(CAST(floor(l_discount * 1000) AS BIGINT) AS DOUBLE) / 4 AS swaps,
      CASE WHEN l_partkey % 83 = 0 THEN NULL ELSE CAST(-l_linenumber AS DOUBLE) END AS commission,
      CAST(CAST(floor(l_extendedprice) AS BIGINT) % 2000 - 1000 AS DOUBLE) / 4 AS profit
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{customer}} ON o_custkey = c_custkey""",
    "report_server_trades_open": _trades(
        "l_linestatus = 'O' AND l_returnflag <> 'R'", "l_linenumber % 2", at("1970-01-01 00:00:00")
    ),
    "report_server_trades_pending_history": _trades(
        "l_linestatus = 'O' AND l_returnflag = 'R'", "2 + l_linenumber % 4", at("1970-01-01 00:00:00")
    ),
    "report_server_trades_closed": _trades(
        "l_linestatus = 'F'",
        "CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 6 ELSE 7 END",
        "end_time",
    ),
    "report_server_trades_open_history": _trades(
        "l_linestatus = 'O'",
        "l_linenumber % 2",
        at("1970-01-01 00:00:00"),
        f"{at('2024-01-15 22:10:00')} + (l_suppkey % 3) * INTERVAL '10' MINUTE AS utc_now, "
        "2024 AS year, 1 AS month, 15 AS day",
    ),
    "report_server_trades_transactions": stacked(
        _transaction(0, "1 = 1"), _transaction(1, "o_orderkey % 5 = 0")
    ),
    "crm_transactions": stacked(
        _wallet_transaction(0, "1 = 1"), _wallet_transaction(1, "o_orderkey % 6 = 0")
    ),
    "transaction_comment_mapping": stacked(
        *[
            f"SELECT {_text(t)} AS comment_template, {_text(r)} AS report_type, {_text(s)} AS sales_type"
            for t, r, s in TEMPLATES
        ]
    ),
    "pricing_ohlc_minute": """
    SELECT CASE user_id % 10 WHEN 0 THEN 'EUR/USD' WHEN 1 THEN 'AUD/USD' WHEN 2 THEN 'GBP/USD'
      WHEN 3 THEN 'USD/CAD' WHEN 4 THEN 'USD/HKD' WHEN 5 THEN 'NZD/USD' WHEN 6 THEN 'USD/CNH'
      WHEN 7 THEN 'USD/CHF' WHEN 8 THEN 'USD/JPY' ELSE 'XAU/USD' END AS core_symbol,
      ts AS timereceived_server, CAST(floor(value) + 1 AS DOUBLE) / 2 AS close FROM {events}""",
    "symbol_settings": """
    SELECT DISTINCT replace(core_symbol, '/', '') AS symbol, CAST('2024-01-03' AS DATE) AS start_date,
      CAST('2024-01-20' AS DATE) AS last_active, CAST(100000 AS DOUBLE) AS contractsize,
      substring(core_symbol, 1, 3) AS basecurrency, 'fx' AS type FROM {pricing_ohlc_minute}""",
    "accounting_t_1_equity_report": stacked(
        *[
            _earlier_report(day, version, wallet)
            for wallet in (False, True)
            for version, day in enumerate(("2024-01-15 00:00:00", "2024-01-12 00:00:00"))
        ]
    ),
}


GIVEN = ("region", "customer", "part", "orders", "lineitem", "events")
BY_DAY = (
    "report_server_users_history",
    "report_server_trades_open",
    "report_server_trades_closed",
    "report_server_trades_open_history",
    "report_server_trades_transactions",
)
_STORED: dict[tuple, tuple[str, StructType]] = {}


def _version(tables) -> tuple:
    """What identifies the given tables: a listing of their files, contents unread."""
    paths = [f"{tables.folder}/{name}.parquet" for name in GIVEN]
    files = tables.spark.read.format("binaryFile").load(paths)
    listing = files.agg(F.max("modificationTime").cast("string"), F.sum("length"), F.count("path"))
    return (tables.spark.sparkContext.applicationId, tables.folder, *listing.first())


class Derived(dict):
    """Derived inputs, each written once per session as the table the report would read.

    Tables with a day split are partitioned by it; there are only four such days.
    """

    def __init__(self, tables):
        super().__init__()
        self._tables = tables
        self._key = _version(tables)

    def _compute(self, name: str) -> DataFrame:
        text = DERIVED[name].replace("[ts]", "TIMESTAMP_NTZ").replace("[str]", "STRING")
        sources = {
            source: self[source] if source in DERIVED else self._tables[source]
            for source in (*DERIVED, *GIVEN)
            if "{" + source + "}" in text
        }
        return self._tables.spark.sql(text, **sources)

    def __missing__(self, name: str) -> DataFrame:
        spark = self._tables.spark
        stored = (*self._key, name)
        if stored not in _STORED:
            path = scratch_path(spark, name)
            rows = self._compute(name)
            writer = rows.write.partitionBy(*DAY_SPLIT) if name in BY_DAY else rows.write
            writer.parquet(path)
            _STORED[stored] = path, rows.schema
        path, schema = _STORED[stored]
        self[name] = spark.read.schema(schema).parquet(path)
        return self[name]


def derived_ctes() -> str:
    """The same inputs as leading common table expressions of a checking query."""
    same = {name: name for name in (*DERIVED, *GIVEN)}
    parts = [
        f"{name} AS ({text.replace('[ts]', 'TIMESTAMP').replace('[str]', 'VARCHAR').format_map(same)})"
        for name, text in DERIVED.items()
    ]
    return ",\n".join(parts)

"""Checking SQL of the report parts, written for the checking engine on its own terms."""

from __future__ import annotations

from eodledger.catalog.inputs import derived_ctes
from eodledger.config import ReportConfig

NEWEST_TRADE = (
    "PARTITION BY server, login, ticket ORDER BY modify_time DESC NULLS FIRST, close_time DESC, "
    "open_time DESC, cmd DESC, volume DESC, profit DESC, swaps DESC, commission DESC NULLS FIRST, symbol DESC"
)
TRADE = (
    "server, login::VARCHAR AS login, ticket, symbol, cmd, volume, open_time, close_time, swaps, commission, "
    "commission_agent, profit, modify_time"
)
CLIENT = """NOT regexp_matches(lower("group"), '{groups}')
  AND string_split("group", chr(92))[-1] NOT IN ('system', 'datacenter', 'oz-cbook-pr-u')
  AND NOT starts_with(string_split("group", chr(92))[-1], 'hf')
  AND NOT contains(comment, 'ALLOC=') AND NOT contains(name, 'test') AND login NOT IN (728888, 718888)
  AND NOT regexp_matches(lower(comment), 'test|ia:0;|trademax hedge|[(]gcgau[)]|[[]webapi[]]|tst')"""

FIRST = (
    ("credit", "Credit", "4"),
    ("points", "Points", "{points}"),
    ("cfd", "CFD", "{cfd}"),
    ("rollover", "Rollover", "9"),
    ("misc_op", "MISC OP", "10"),
    ("split", "Split", "10"),
    ("compensation", "Compensation", "10"),
    ("misc_clear", "MISC Clear", "10"),
    ("misc_tr", "MISC TR", "10"),
    ("misc_funding", "MISC FUNDING", "10"),
    ("promo", "Promo", "10"),
)
SECOND = (("ib_rebate", "IB Rebate"), ("auto_rebate", "Auto Rebate"), ("cpa_rebate", "CPA Rebate"))
TAILS = ("deposit_from_ib", "withdrawal_to_ib", "from_same_category", "to_same_category")


def _codes(values) -> str:
    return ", ".join(str(v) for v in values)


def _measure_query(source: str, key: str, amount: str, rules: dict[str, str], extra: str = "") -> str:
    sums = ", ".join(
        f"coalesce(round(sum({amount}) FILTER (WHERE {rule}), 2), 0) AS {name}" for name, rule in rules.items()
    )
    rebates = " + ".join(n for n, _ in SECOND)
    everything = " + ".join(["net_deposit", "internal_transfer", *[n for n, *_ in FIRST], rebates])
    return f"""SELECT *, {rebates} AS tot_rebate, {everything} AS tot_txn{extra} FROM (
      SELECT {key}, {sums}
      FROM (SELECT s.*, m.sales_type, string_split(m.report_type, '-') AS seg FROM {source} s
            LEFT JOIN transaction_comment_mapping m ON s.txt ILIKE m.comment_template) GROUP BY {key})"""


def _trade_rules() -> dict[str, str]:
    rules = {
        "deposit": "cmd = 6 AND seg[1] = 'Deposit'",
        "withdrawal": "cmd = 6 AND seg[1] = 'Withdrawal'",
        "net_deposit": "cmd = 6 AND seg[1] IN ('Deposit', 'Withdrawal')",
        "sales_deposit": "cmd = 6 AND 'Deposit' IN (seg[1], sales_type)",
        "sales_withdrawal": "cmd = 6 AND 'Withdrawal' IN (seg[1], sales_type)",
        "sales_net_deposit": "cmd = 6 AND (seg[1] IN ('Deposit', 'Withdrawal') OR sales_type IN ('Deposit', 'Withdrawal'))",
        "credit_change": "cmd = 7",
        "internal_transfer": "cmd = 6 AND seg[1] = 'Internal_Transfer'",
    }
    rules |= {f"internal_transfer_{t}": f"cmd = 6 AND seg[-1] = upper('internal_transfer_{t}')" for t in TAILS}
    rules |= {n: f"cmd = 6 AND seg[1] = '{label}'" for n, label, _ in FIRST}
    rules |= {n: f"cmd = 6 AND seg[2] = '{label}'" for n, label in SECOND}
    return rules


def _wallet_rules(cfg: ReportConfig) -> dict[str, str]:
    v = cfg.variant
    into, out = _codes(v.deposit_codes), _codes(v.withdrawal_codes)
    other = "seg[1] <> 'Internal_Transfer'"
    moved = f"type IN (3, {cfg.extra_transfer_type})"
    rules = {
        "deposit": f"type IN ({into}) AND {other}",
        "withdrawal": f"type IN ({out}) AND {other}",
        "net_deposit": f"type IN ({into}, {out}) AND {other}",
        "sales_deposit": f"type IN ({into})",
        "sales_withdrawal": f"type IN ({out})",
        "sales_net_deposit": f"type IN ({into}, {out})",
        "credit_change": "type = 4",
        "internal_transfer": moved,
    }
    rules |= {
        f"internal_transfer_{t}": f"{moved if t.endswith('_ib') else 'type = 3'} AND seg[-1] = upper('internal_transfer_{t}')"
        for t in TAILS
    }
    rules |= {
        n: f"type = {code.format(points=v.points_code, cfd=v.cfd_code)} AND seg[1] = '{label}'"
        for n, label, code in FIRST
    }
    rules |= {n: f"type = 11 AND seg[2] = '{label}'" for n, label in SECOND}
    return rules


def _parts(cfg: ReportConfig) -> dict[str, str]:
    v = cfg.variant
    day = f"TIMESTAMP '{cfg.day_start}'"
    eve = f"TIMESTAMP '{cfg.previous_start}'"
    month = f"make_date(year, month, day) BETWEEN DATE '{cfg.month_back}' AND DATE '{cfg.day}'"
    servers = "server NOT IN ('" + "', '".join(cfg.excluded_servers) + "')"
    local = "time_bucket(INTERVAL '30 minutes', utc_now + INTERVAL 2 HOUR)"
    label = "lower(symbol_group)" if v.lower_product_label else "symbol_group"
    lots = ", ".join(
        f"coalesce(sum(volume) FILTER (WHERE {label} = '{text}') / 100.0, 0) AS {name}"
        for name, text in v.products.items()
    )
    (base, base_group), *_ = v.rebate_groups.items()
    rates = ", ".join(
        f"max(rbc) FILTER (WHERE external_symbol_group_id = {g}) AS {n}" for n, g in v.rebate_groups.items()
    )
    wallet_texts = "regexp_matches(external_id, 'W')"
    recent = "test|manager|mam" if v.recent_names_skip_mam else "test|manager"
    return {
        "account_state": f"""SELECT server, login::VARCHAR AS login, name, "group", comment, utc_now, credit, equity,
            balance, margin, margin_free, margin_level, leverage, currency, regdate, lead_source
          FROM (SELECT * FROM report_server_users_history WHERE {servers}
              AND make_date(year, month, day) BETWEEN DATE '{cfg.day_before}' AND DATE '{cfg.day}' AND {local} <= {day}
            QUALIFY row_number() OVER (PARTITION BY server, login ORDER BY utc_now DESC) = 1)
          WHERE {CLIENT.format(groups='test|manager|mam')}""",
        "partner_names": f"""SELECT name, server, login::VARCHAR AS login, crm_server_id AS rs_type
          FROM report_server_users_history LEFT JOIN crm_servers USING (server)
          WHERE {servers} AND {CLIENT.format(groups=recent)}
            AND contains(lower(name), 'tm') AND regexp_matches(lower(name), 'iress|insight')
          QUALIFY row_number() OVER (PARTITION BY server, login ORDER BY utc_now DESC) = 1""",
        "known_users": f"""SELECT id, rtz_now, updated_at, country, member_account_type, jurisdiction, sales_code,
            lead_source, created_at
          FROM crm_users_history WHERE rtz_now < TIMESTAMP '{cfg.known_before}'
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY rtz_now DESC) = 1""",
        "member_rows": """SELECT u.*, CASE upper(country) WHEN 'AU' THEN 'AUSTRALIA' WHEN 'HONGKONG' THEN 'HONG KONG SAR CHINA'
              WHEN 'UK' THEN 'UNITED KINGDOM' WHEN '中国' THEN 'CHINA'
              ELSE coalesce(nullif(upper(translate(country, '0123456789', '')), ''),
                            CASE WHEN country IS NOT NULL THEN 'UNKNOWN OR INVALID REGION' END) END AS adj_country,
            l.name AS member_acct_type, j.accounting_equity_report_jurisdiction AS report_jurisdiction
          FROM known_users u
          LEFT JOIN crm_member_account_has_languages l ON l.language = 'en' AND l.member_account_type_id = member_account_type
          LEFT JOIN accounting_equity_report_jurisdiction j ON j.user_jurisdiction = jurisdiction""",
        "trading_accounts": f"""SELECT h.id, h.type, external_id, user_id, parent_ta_id, is_ib, salescode, balance, created_at,
            n.id AS trading_server_id, n.name AS trading_server_name, s.server,
            CASE WHEN is_ib = 1 THEN 'IB' WHEN parent_ta_id IS NULL THEN 'Retail Client' ELSE 'Clients With IB' END AS member_type
          FROM (SELECT * FROM crm_trading_accounts_history
                WHERE type IN (SELECT crm_server_id FROM crm_servers WHERE regexp_matches(lower(type), 'live|internal'))
                  AND rtz_now < TIMESTAMP '{cfg.known_before}'
                QUALIFY row_number() OVER (PARTITION BY id ORDER BY rtz_now DESC) = 1) h
          LEFT JOIN crm_trading_servers n ON n.id = h.type LEFT JOIN crm_servers s ON s.crm_server_id = h.type
          WHERE h.type NOT IN ({_codes(cfg.excluded_types)}) AND deleted_at IS NULL""",
        "first_dates": """SELECT coalesce(a.id, b.id) AS user_id, a.d AS member_first_ta_registration_date,
            b.d AS member_first_ib_ta_registration_date
          FROM (SELECT u.id, min(t.created_at) AS d FROM known_users u JOIN trading_accounts t ON t.user_id = u.id
                WHERE is_ib = 0 AND NOT regexp_matches(lower(salescode), '9999|test') AND NOT contains(external_id, 'W')
                GROUP BY u.id) a
          FULL JOIN (SELECT u.id, min(t.created_at) AS d FROM known_users u JOIN trading_accounts t ON t.user_id = u.id
                WHERE is_ib = 1 AND NOT regexp_matches(lower(salescode), '9999|test') AND NOT contains(external_id, 'W')
                GROUP BY u.id) b ON a.id = b.id""",
        "rebate_rates": f"""SELECT trading_server_group_id, {rates}
          FROM crm_trading_server_group_has_commission_limits GROUP BY trading_server_group_id
          HAVING count(*) FILTER (WHERE external_symbol_group_id = {base_group}) > 0""",
        "wallet_balances": f"""SELECT external_id, type, balance AS wallet_balance FROM crm_trading_accounts_daily
          WHERE {wallet_texts} AND deleted_at IS NULL AND utc_now::DATE = DATE '{cfg.day_before}'""",
        "all_accounts": f"""SELECT CASE WHEN starts_with(p.login, 'W') THEN t.server ELSE p.server END AS server, p.login,
            CASE WHEN starts_with(p.login, 'W') THEN t.trading_server_name ELSE s.crm_server_name END AS trading_server_name,
            coalesce(s.crm_server_id, t.type) AS type, r."group", t.user_id, t.salescode, t.balance AS points_balance,
            CASE WHEN t.is_ib = 1 THEN 'True' ELSE 'False' END AS is_ib, u.sales_code AS member_sales_code,
            u.lead_source AS member_lead_source, pt.external_id AS agent, u.jurisdiction,
            u.created_at AS member_registration_date, f.member_first_ta_registration_date,
            f.member_first_ib_ta_registration_date, r.credit,
            CASE WHEN r.credit > 0 AND r.equity < r.credit THEN greatest(r.equity, 0) - r.credit ELSE 0 END AS used_credit,
            r.equity,
            CASE WHEN r.equity < r.balance AND r.balance < 0 THEN 0 ELSE greatest(round(r.equity - r.credit, 2), CASE WHEN r.equity IS NOT NULL THEN 0 END) END
              AS positive_equity,
            r.balance, coalesce(greatest(r.balance, 0), 0) AS positive_balance,
            CASE WHEN r.balance < 0 THEN r.balance ELSE 0 END AS negative_balance, r.currency, u.adj_country AS country,
            r.regdate AS ta_registration_date, r.margin, r.margin_free, r.margin_level, r.leverage, r.comment,
            r.lead_source AS ta_lead_source, {", ".join("q." + n for n in v.rebate_groups)},
            u.member_acct_type AS member_account_type, t.member_type,
            CASE WHEN contains(r."group", 'va') THEN 'Vanuatu' ELSE u.report_jurisdiction END AS report_jurisdiction
          FROM (SELECT DISTINCT server, login FROM account_state
                UNION ALL SELECT NULL, external_id FROM trading_accounts WHERE type IN ({_codes(cfg.wallet_types)})) p
          LEFT JOIN crm_servers s ON s.server = p.server
          LEFT JOIN trading_accounts t ON t.external_id = p.login AND (t.server = p.server OR starts_with(p.login, 'W'))
          LEFT JOIN trading_accounts pt ON pt.id = t.parent_ta_id
          LEFT JOIN account_state r ON r.login = p.login AND r.server = p.server
          LEFT JOIN crm_trading_server_groups g ON g.trading_server_id = t.trading_server_id AND g."group" = r."group"
          LEFT JOIN member_rows u ON u.id = t.user_id
          LEFT JOIN rebate_rates q ON q.trading_server_group_id = g.id
          LEFT JOIN first_dates f ON f.user_id = t.user_id
          WHERE coalesce(NOT regexp_matches(lower(u.sales_code), 'test|hedge|nosales|9999'), true)""",
        "opened_trades": f"""SELECT {TRADE} FROM report_server_trades_open WHERE {servers} AND {month}
            AND open_time >= {eve} AND open_time <= {day} QUALIFY row_number() OVER ({NEWEST_TRADE}) = 1""",
        "pending_trades": f"""SELECT {TRADE} FROM report_server_trades_pending_history WHERE {servers}
            AND open_time >= {eve} AND open_time <= {day} QUALIFY row_number() OVER ({NEWEST_TRADE}) = 1""",
        "closed_trades": f"""SELECT * FROM (SELECT {TRADE} FROM report_server_trades_closed
              WHERE {servers} AND {month} AND ticket::VARCHAR || server NOT IN
                (SELECT ticket::VARCHAR || server FROM report_server_trades_open WHERE {servers} AND ticket IS NOT NULL)
              QUALIFY row_number() OVER ({NEWEST_TRADE}) = 1)
          WHERE close_time >= {eve} AND close_time <= {day}""",
        "open_at_report": f"""SELECT {TRADE} FROM report_server_trades_open_history
          WHERE {servers} AND {month} AND {local} = date_trunc('hour', TIMESTAMP '{cfg.report_time}')""",
        "symbol_groups": """SELECT e.name AS symbol, g.name AS symbol_group, server
          FROM crm_external_symbols e LEFT JOIN crm_servers ON crm_server_id = trading_server_id
          LEFT JOIN crm_external_symbol_groups g ON g.id = external_symbol_group_id
          QUALIFY row_number() OVER (PARTITION BY e.name, trading_server_id ORDER BY e.updated_at DESC) = 1""",
        "trade_volumes": f"""SELECT c.server, c.login, round(sum(swaps), 2) AS swaps, round(sum(commission), 2) AS commissions,
            round(sum(profit), 2) AS profit, round(sum(swaps + commission + profit), 2) AS sum_pnl, {lots}
          FROM closed_trades c LEFT JOIN symbol_groups g ON g.symbol = c.symbol AND g.server = c.server
          WHERE NOT EXISTS (SELECT 1 FROM opened_trades o WHERE o.server = c.server AND o.ticket = c.ticket)
          GROUP BY c.server, c.login""",
        "order_counts": f"""SELECT server, login, count(ticket) FILTER (WHERE still AND cmd IN (0, 1)) AS count_open_orders,
            count(ticket) FILTER (WHERE still AND cmd BETWEEN 2 AND 5) AS count_pending_orders,
            count(ticket) FILTER (WHERE NOT still AND cmd IN (0, 1, 6, 7)) AS count_closed_orders,
            sum(datediff('second', open_time, close_time)) FILTER (WHERE NOT still AND cmd IN (0, 1))
              / nullif(count(ticket) FILTER (WHERE NOT still AND cmd IN (0, 1, 6, 7)), 0) AS average_trade_duration
          FROM (SELECT *, close_time = TIMESTAMP '1970-01-01' AS still
                FROM (FROM opened_trades UNION ALL FROM closed_trades UNION ALL FROM pending_trades)
                QUALIFY row_number() OVER ({NEWEST_TRADE}) = 1)
          GROUP BY server, login""",
        "open_order_counts": """SELECT server, login, count(DISTINCT ticket) AS open_order_count
          FROM open_at_report GROUP BY ALL""",
        "lifetime_profit": f"""SELECT server, login, sum(profit) AS profit_sum, max(open_time)::DATE AS dt_report
          FROM (SELECT server, login::VARCHAR AS login, profit, open_time, cmd FROM report_server_trades_transactions
                WHERE {servers} AND make_date(year, month, day) <= DATE '{cfg.day}' AND open_time <= {day}
                  AND comment NOT ILIKE '%from master trade%'
                QUALIFY row_number() OVER (PARTITION BY server, ticket ORDER BY utc_now DESC) = 1)
          WHERE cmd <> 7 GROUP BY server, login""",
        "day_transactions": f"""SELECT server, login::VARCHAR AS login, ticket, cmd, profit, comment, open_time, modify_time
          FROM report_server_trades_transactions WHERE {servers} AND {month} AND open_time >= {eve} AND open_time <= {day}
          QUALIFY row_number() OVER (PARTITION BY login, server, ticket ORDER BY modify_time DESC) = 1""",
        "transactions": _measure_query(
            "(SELECT *, comment AS txt FROM day_transactions)", "server, login", "profit", _trade_rules()
        ),
        "wallet_rows": f"""SELECT * EXCLUDE (status, deleted_at, completed_at) FROM crm_transactions
          WHERE {wallet_texts} AND status = 2 AND deleted_at IS NULL AND completed_at::DATE = DATE '{cfg.day_before}'
            AND user_id IN (SELECT id FROM known_users WHERE NOT regexp_matches(lower(sales_code), '9999|test'))
          QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1""",
        "wallet_transactions": _measure_query(
            "(SELECT *, external_id AS login, trading_server_comment AS txt FROM wallet_rows)",
            "login",
            "fund_amount",
            _wallet_rules(cfg),
            ", 'wallet' AS server",
        ),
        "exchange_rates": f"""SELECT d AS dt_report, core_symbol, symbol, CASE WHEN core_symbol LIKE 'USD%' THEN right(symbol, 3)
            ELSE left(symbol, 3) END AS ac, close, contractsize, basecurrency, type
          FROM (SELECT core_symbol, timereceived_server::DATE AS d, arg_max(close, {{'at': timereceived_server, 'price': close}}) AS close
                FROM pricing_ohlc_minute
                WHERE core_symbol <> 'XAU/USD' AND timereceived_server >= DATE '{cfg.day}' - {cfg.price_days} GROUP BY ALL)
          JOIN symbol_settings ON symbol = replace(core_symbol, '/', '') AND d BETWEEN start_date AND last_active""",
        "last_report": f"SELECT * FROM accounting_t_1_equity_report WHERE dt_report = {eve}",
        "first_report": """SELECT user_id, login, trading_server, min(dt_report) AS dt_report,
            arg_min(positive_equity, dt_report) AS positive_equity
          FROM accounting_t_1_equity_report WHERE user_id IS NOT NULL GROUP BY ALL""",
        "report_local": _local(cfg),
        "report_usd": _usd(cfg),
    }


def _local(cfg: ReportConfig) -> str:
    v = cfg.variant
    w = f"a.type = {v.wallet_code}"
    cost = " + ".join(f"vo.{vol} * a.{rate}" for vol, rate in zip(v.products, v.rebate_groups))
    lines = [
        f"TIMESTAMP '{cfg.bucket}' AS dt_report",
        "'2024-01-16 05:01:10' AS dt_report_insert",
        "a.jurisdiction AS report_jurisdiction",
        "a.jurisdiction AS jurisdiction",
        "CASE WHEN contains(a.\"group\", 'va') THEN 'Vanuatu' ELSE a.jurisdiction END AS final_jurisdiction",
        "coalesce(a.credit, 0) AS credit",
        "coalesce(t.credit_change, wt.credit_change, 0) AS credit_change",
        "coalesce(vo.swaps, 0) AS swap",
        "coalesce(vo.commissions, 0) AS commission",
        f"CASE WHEN {w} THEN 0 ELSE coalesce(round({cost}, 2), 0) END AS trade_cost",
        f"CASE WHEN {w} THEN 0 ELSE coalesce(round(a.positive_equity - coalesce(l.positive_equity, 0) - "
        f"coalesce(t.tot_txn, 0) + coalesce({cost}, 0), 2), 0) END AS cost_to_loss",
        "coalesce(vo.profit, 0) AS profit",
        f"CASE WHEN {w} THEN 0 ELSE coalesce(vo.sum_pnl, 0) END AS pnl",
        "coalesce(a.equity, 0) AS equity",
        "coalesce(a.positive_equity, 0) AS positive_equity",
        f"CASE WHEN {w} THEN 0 ELSE coalesce(round(a.positive_equity - coalesce(t.tot_txn, 0) - "
        "coalesce(l.positive_equity, 0), 2), 0) END AS equity_change",
        f"coalesce(CASE WHEN {w} THEN b.wallet_balance ELSE a.balance END, 0) AS last_balance",
        f"coalesce(CASE WHEN {w} THEN b.wallet_balance ELSE a.positive_balance END, 0) AS positive_balance",
        f"CASE WHEN {w} THEN 0 ELSE coalesce(a.used_credit, 0) END AS used_credit",
        f"CASE WHEN {w} THEN 0 ELSE coalesce(a.negative_balance, 0) END AS negative_balance",
        f"CASE WHEN {w} THEN 'POINTS' ELSE a.currency END AS currency",
        f"coalesce(CASE WHEN {w} THEN b.wallet_balance ELSE a.used_credit END, 0) - coalesce(l.used_credit, 0) "
        "AS used_credit_change",
        f"coalesce(CASE WHEN {w} THEN b.wallet_balance ELSE a.negative_balance END, 0) - "
        "coalesce(l.negative_balance, 0) AS negative_balance_change",
        "a.trading_server_name AS trading_server",
        "a.salescode AS ta_sales_code",
        "a.member_registration_date AS member_register_date",
        "a.ta_registration_date AS ta_register_date",
        "coalesce(oo.open_order_count, 0) AS count_open_orders",
        "coalesce(o.count_pending_orders, 0) AS count_pending_orders",
        "coalesce(o.count_closed_orders, 0) AS count_closed_orders",
        "coalesce(o.average_trade_duration, 0) AS average_trade_duration",
        "coalesce(a.member_account_type, '') AS member_account_type",
        "coalesce(a.member_type, '') AS member_type",
        "CAST(n.name IS NOT NULL AS INT) AS is_cimb",
        "CASE WHEN n.name IS NULL THEN '' WHEN contains(n.name, 'iress') THEN 'iress' "
        "WHEN contains(n.name, 'insight') THEN 'insights' END AS cimb_name",
        "coalesce('TM' || string_split(lower(n.name), 'tm')[2], '') AS cimb_cfd",
        "'2024' AS year, '01' AS month, '16' AS day",
        "0 AS rebate, 0 AS instant_rebate, 0 AS adjustment, 0 AS misc",
        "coalesce(a.positive_equity, 0) - coalesce(f.positive_equity, 0) - coalesce(p.profit_sum, 0) "
        "AS lifetime_equity_change_lc",
        "coalesce(f.positive_equity, 0) AS ta_open_positive_equity",
        "coalesce(p.profit_sum, 0) AS profit_sum",
    ]
    lines += [f"a.{c}" for c in ("login", "is_ib", '"group"', "user_id", "agent", "country", "comment")]
    lines += [f"a.{c}" for c in ("member_sales_code", "member_lead_source", "ta_lead_source")]
    lines += [f"a.member_first_{c}ta_registration_date" for c in ("", "ib_")]
    lines += [f"coalesce(a.{c}, 0) AS {c}" for c in ("margin", "margin_free", "margin_level", "leverage")]
    lines += [f"coalesce(a.{c}, 0) AS {c}" for c in v.rebate_groups]
    lines += [f"coalesce(vo.{c}, 0) AS {c}" for c in v.products]
    base = {n: n for n in ("deposit", "net_deposit", "internal_transfer", "sales_deposit", "sales_net_deposit")}
    base |= {"withdraw": "withdrawal", "sales_withdraw": "sales_withdrawal"}
    base |= {f"internal_transfer_{t}": f"internal_transfer_{t}" for t in TAILS}
    lines += [f"coalesce(CASE WHEN {w} THEN wt.{m} ELSE t.{m} END, 0) AS {n}" for n, m in base.items()]
    category = {("credit_txn" if n == "credit" else n): n for n, *_ in FIRST} | {n: n for n, _ in SECOND}
    category |= {"total_rebate": "tot_rebate"}
    lines += [
        f"coalesce(CASE WHEN a.type = 9 THEN wt.{m} ELSE t.{m} END, 0) AS {n}" for n, m in category.items()
    ]
    return f"""SELECT DISTINCT {", ".join(lines)} FROM all_accounts a
      LEFT JOIN trade_volumes vo USING (server, login) LEFT JOIN order_counts o USING (server, login)
      LEFT JOIN open_order_counts oo USING (server, login) LEFT JOIN transactions t USING (server, login)
      LEFT JOIN lifetime_profit p USING (server, login)
      LEFT JOIN wallet_transactions wt ON wt.login = a.login
      LEFT JOIN wallet_balances b ON b.external_id = a.login AND b.type = a.type
      LEFT JOIN partner_names n ON n.login = a.login AND n.rs_type = a.type
      LEFT JOIN last_report l ON l.login = a.login AND l.trading_server = a.trading_server_name
      LEFT JOIN first_report f ON f.login = a.login AND f.trading_server = a.trading_server_name
      WHERE coalesce(NOT contains(upper(a.jurisdiction), 'TEST'), true)"""


def _usd(cfg: ReportConfig) -> str:
    """Every rate day is joined here, and the newest kept afterwards."""
    return """SELECT * EXCLUDE (lifetime_equity_change_lc, ta_open_positive_equity, profit_sum, fx_day, pair, fx),
        round(CASE WHEN currency = 'USD' THEN lifetime_equity_change_lc
          WHEN left(pair, 3) = currency THEN lifetime_equity_change_lc * fx
          WHEN right(pair, 3) = currency THEN lifetime_equity_change_lc / fx ELSE 0 END, 2)
          AS lifetime_equity_change_usd
      FROM (SELECT e.*, x.dt_report AS fx_day, x.symbol AS pair, x.close AS fx FROM report_local e
            LEFT JOIN exchange_rates x ON x.ac = e.currency AND e.dt_report = date_trunc('day', e.dt_report)
            QUALIFY row_number() OVER (PARTITION BY e.dt_report, user_id, login, trading_server, currency
              ORDER BY x.dt_report DESC, ta_open_positive_equity DESC, positive_equity DESC, equity_change DESC,
                last_balance DESC, cimb_cfd DESC, member_account_type DESC, trade_cost DESC) = 1)"""


def check(cfg: ReportConfig, part: str) -> str:
    """SQL giving one part of the report over the derived inputs."""
    ctes = ",\n".join(f"{name} AS ({text})" for name, text in _parts(cfg).items())
    return f"WITH {derived_ctes()},\n{ctes}\nSELECT * FROM {part}"

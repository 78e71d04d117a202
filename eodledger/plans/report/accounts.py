"""Accounts, users and the wide account row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eodledger.config import ReportConfig
from eodledger.functions import amounts, texts
from eodledger.functions.times import local_bucket_at_most, ntz, ymd_window
from eodledger.operators.dedup import as_of_snapshot, latest_per_key
from eodledger.operators.joins import rate_pivot, residual_or_join
from eodledger.operators.skew import left_join_spread_nulls

Tables = Mapping[str, DataFrame]

# Accounts that never take part in the report.
HOUSE_LOGINS = ("728888", "718888")
HOUSE_GROUPS = ("system", "datacenter", "oz-cbook-pr-u")
HOUSE_GROUP_PATTERNS = ("%test%", "%manager%")
MAM_GROUP_PATTERN = "%mam%"
HEDGE_GROUP_PATTERN = "hf%"
ALLOCATION_COMMENT = "%ALLOC=%"
HOUSE_COMMENT_PATTERNS = (
    "%test%",
    "%ia:0;%",
    "%trademax hedge%",
    "%(gcgau)%",
    "%[webapi]%",
    "%tst%",
)
TEST_NAME = "%test%"
PARTNER_NAME = "%tm%"
PARTNER_PLATFORMS = ("%iress%", "%insight%")
HOUSE_SALES_CODES = ("%test%", "%hedge%", "%nosales%", "%9999%")
WALLET_LOGIN = "W%"
WALLET_ANYWHERE = "%W%"
VANUATU_GROUP = "%va%"
VANUATU = "Vanuatu"

SNAPSHOT_COLUMNS = (
    "name",
    "group",
    "comment",
    "utc_now",
    "credit",
    "equity",
    "balance",
    "margin",
    "margin_free",
    "margin_level",
    "leverage",
    "currency",
    "regdate",
    "lead_source",
)


def is_client(skip_mam: bool) -> Column:
    """A client account by login, group, comment and name. NULL texts do not pass.

    Only the name is compared with its case.
    """
    group, comment = F.col("group"), F.col("comment")
    leaf = texts.last_segment(group, "\\")
    groups = HOUSE_GROUP_PATTERNS + ((MAM_GROUP_PATTERN,) if skip_mam else ())
    return (
        ~F.col("login").isin(*HOUSE_LOGINS)
        & texts.none_like(F.lower(group), groups)
        & ~leaf.isin(*HOUSE_GROUPS)
        & ~leaf.like(HEDGE_GROUP_PATTERN)
        & ~comment.like(ALLOCATION_COMMENT)
        & texts.none_like(F.lower(comment), HOUSE_COMMENT_PATTERNS)
        & ~F.col("name").like(TEST_NAME)
    )


def account_state(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[server, login] Newest snapshot up to the report day's first half hour.

    Ranked before the client test: an account whose newest snapshot is excluded is out
    even if an older one would pass.
    """
    known = (
        tables["report_server_users_history"]
        .where(~F.col("server").isin(*cfg.excluded_servers))
        .where(ymd_window(cfg.day_before, cfg.day))
        .where(local_bucket_at_most(F.col("utc_now"), cfg.report_tz, cfg.day_start))
        .select("server", F.col("login").cast("string").alias("login"), *SNAPSHOT_COLUMNS)
    )
    newest = latest_per_key(known, ["server", "login"], "utc_now", ["equity", "balance"])
    return newest.where(is_client(skip_mam=True))


def partner_names(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[server, login] Newest name among snapshots that qualify as partner clients."""
    name = F.lower("name")
    qualifying = (
        tables["report_server_users_history"]
        .where(~F.col("server").isin(*cfg.excluded_servers))
        .select("server", F.col("login").cast("string").alias("login"), "name", "group", "comment", "utc_now")
        .where(is_client(cfg.variant.recent_names_skip_mam))
        .where(name.like(PARTNER_NAME) & texts.any_like(name, PARTNER_PLATFORMS))
        .select("server", "login", "name", "utc_now")
    )
    newest = latest_per_key(qualifying, ["server", "login"], "utc_now", ["name"])
    ids = tables["crm_servers"].groupBy("server").agg(F.min("crm_server_id").alias("rs_type"))
    return newest.join(ids, "server", "left").select("name", "server", "login", "rs_type")


def users_as_of(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[id] Users as known shortly after the report time."""
    columns = (
        "id",
        "rtz_now",
        "updated_at",
        "country",
        "member_account_type",
        "jurisdiction",
        "sales_code",
        "lead_source",
        "created_at",
    )
    history = tables["crm_users_history"].select(*columns)
    return as_of_snapshot(history, ["id"], "rtz_now", cfg.known_before, ["updated_at"])


def users(tables: Tables, known_users: DataFrame) -> DataFrame:
    """[id] Users with canonical country, account-type label and report jurisdiction."""
    labels = (
        tables["crm_member_account_has_languages"]
        .where(F.col("language") == "en")
        .select("member_account_type_id", F.col("name").alias("member_acct_type"))
    )
    jurisdictions = tables["accounting_equity_report_jurisdiction"].select(
        "user_jurisdiction",
        F.col("accounting_equity_report_jurisdiction").alias("report_jurisdiction"),
    )
    return (
        known_users.withColumn("adj_country", texts.canonical_name(F.col("country")))
        .join(labels, F.col("member_account_type") == F.col("member_account_type_id"), "left")
        .join(jurisdictions, F.col("jurisdiction") == F.col("user_jurisdiction"), "left")
        .drop("member_account_type_id", "user_jurisdiction")
    )


def trading_accounts_as_of(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[id] Accounts on live and internal servers, as known shortly after the report time."""
    live = tables["crm_servers"].where(
        texts.any_like(F.lower("type"), ("%live%", "%internal%"))
    ).select(F.col("crm_server_id").alias("live_type"))
    columns = (
        "id",
        "type",
        "external_id",
        "user_id",
        "parent_ta_id",
        "is_ib",
        "salescode",
        "balance",
        "created_at",
        "updated_at",
        "deleted_at",
        "rtz_now",
    )
    history = tables["crm_trading_accounts_history"].select(*columns)
    kept = history.join(live, F.col("type") == F.col("live_type"), "left_semi")
    return as_of_snapshot(kept, ["id"], "rtz_now", cfg.known_before, ["updated_at"])


def trading_accounts(tables: Tables, cfg: ReportConfig, known_accounts: DataFrame) -> DataFrame:
    """[id, server] Undeleted accounts of the wanted types, with server and member type.

    Any parent id, zero included, makes a client "with IB".
    """
    names = tables["crm_trading_servers"].groupBy("id").agg(F.min("name").alias("trading_server_name"))
    names = names.withColumnRenamed("id", "trading_server_id")
    servers = tables["crm_servers"].select("server", "crm_server_id")
    member_type = (
        F.when(F.col("is_ib") == 1, "IB")
        .when(F.col("parent_ta_id").isNotNull(), "Clients With IB")
        .otherwise("Retail Client")
    )
    return (
        known_accounts.where(~F.col("type").isin(*cfg.excluded_types) & F.col("deleted_at").isNull())
        .join(names, F.col("type") == F.col("trading_server_id"), "left")
        .join(servers, F.col("type") == F.col("crm_server_id"), "left")
        .drop("crm_server_id", "deleted_at", "rtz_now", "updated_at")
        .withColumn("member_type", member_type)
    )


def first_account_dates(known_users: DataFrame, accounts: DataFrame) -> DataFrame:
    """[user_id] First ordinary and first IB account date of each user.

    Two filtered minimums over the same rows: one aggregate gives what a full outer
    join of two would.
    """
    eligible = (
        accounts.where(
            ~F.col("salescode").like("%9999%")
            & ~F.lower("salescode").like("%test%")
            & ~F.col("external_id").like(WALLET_ANYWHERE)
            & F.col("is_ib").isin(0, 1)
        )
        .select("user_id", "is_ib", "created_at")
        .join(known_users.select(F.col("id").alias("user_id")), "user_id", "left_semi")
    )

    def first(ib: int, name: str) -> Column:
        return F.min(F.when(F.col("is_ib") == ib, F.col("created_at"))).alias(name)

    return eligible.groupBy("user_id").agg(
        first(0, "member_first_ta_registration_date"),
        first(1, "member_first_ib_ta_registration_date"),
    )


def rebate_rates(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[group id] Six rates of a trading-server group."""
    return rate_pivot(
        tables["crm_trading_server_group_has_commission_limits"],
        "trading_server_group_id",
        "external_symbol_group_id",
        "rbc",
        cfg.variant.rebate_groups,
    )


def wallet_balances(tables: Tables, cfg: ReportConfig) -> DataFrame:
    """[wallet, type] Balance on the day before the report."""
    return (
        tables["crm_trading_accounts_daily"]
        .where(F.col("external_id").like(WALLET_ANYWHERE) & F.col("deleted_at").isNull())
        .where((F.col("utc_now") >= ntz(cfg.previous_start)) & (F.col("utc_now") < ntz(cfg.day_start)))
        .select("external_id", "type", F.col("balance").alias("wallet_balance"))
    )


def all_accounts(
    tables: Tables,
    cfg: ReportConfig,
    state: DataFrame,
    accounts: DataFrame,
    known_users: DataFrame,
) -> DataFrame:
    """[server, login] The wide account row.

    The population is every account state plus every wallet. Account states carry their
    own columns into the union, so they need not be joined to themselves again. Parent
    and member are attached to the narrow trading account, not to the wide row.
    """
    wallets = accounts.where(F.col("type").isin(*cfg.wallet_types)).select(
        F.col("external_id").cast("string").alias("login")
    )
    population = state.drop("name", "utc_now").unionByName(wallets, allowMissingColumns=True)
    servers = tables["crm_servers"].select(
        F.col("server").alias("cs_server"), "crm_server_id", "crm_server_name"
    )
    ta = accounts.select(
        F.col("server").alias("ta_server"),
        "external_id",
        F.col("type").alias("ta_type"),
        "user_id",
        "parent_ta_id",
        "salescode",
        F.col("balance").alias("points_balance"),
        "is_ib",
        "member_type",
        "trading_server_name",
        "trading_server_id",
    )
    parents = accounts.select(F.col("id").alias("parent_id"), F.col("external_id").alias("agent"))
    groups = tables["crm_trading_server_groups"].select(
        F.col("id").alias("group_id"),
        F.col("trading_server_id").alias("group_server_id"),
        F.col("group").alias("group_name"),
    )
    user = users(tables, known_users).select(
        F.col("id").alias("member_id"),
        F.col("sales_code").alias("member_sales_code"),
        F.col("lead_source").alias("member_lead_source"),
        "jurisdiction",
        F.col("created_at").alias("member_registration_date"),
        F.col("adj_country").alias("country"),
        F.col("member_acct_type").alias("member_account_type"),
        "report_jurisdiction",
    )
    first_dates = first_account_dates(known_users, accounts).withColumnRenamed("user_id", "ft_user_id")
    member = user.join(first_dates, F.col("member_id") == F.col("ft_user_id"), "left").drop("ft_user_id")
    rates = rebate_rates(tables, cfg)

    ta = left_join_spread_nulls(ta, parents, "parent_ta_id", "parent_id", "external_id")
    ta = left_join_spread_nulls(ta, member, "user_id", "member_id", "external_id")

    is_wallet = F.col("login").like(WALLET_LOGIN)
    joined = population.join(servers, F.col("server") == F.col("cs_server"), "left")
    joined = residual_or_join(
        joined, ta, "login", "external_id", (F.col("server") == F.col("ta_server")) | is_wallet
    )
    joined = joined.join(
        groups,
        (F.col("trading_server_id") == F.col("group_server_id")) & (F.col("group") == F.col("group_name")),
        "left",
    )
    joined = left_join_spread_nulls(joined, rates, "group_id", "trading_server_group_id", "login")
    kept = joined.where(texts.none_like_or_null(F.lower("member_sales_code"), HOUSE_SALES_CODES))

    credit, equity, balance = F.col("credit"), F.col("equity"), F.col("balance")
    return kept.select(
        F.when(is_wallet, F.col("ta_server")).otherwise(F.col("server")).alias("server"),
        "login",
        F.when(is_wallet, F.col("trading_server_name"))
        .otherwise(F.col("crm_server_name"))
        .alias("trading_server_name"),
        F.coalesce("crm_server_id", "ta_type").alias("type"),
        "group",
        "user_id",
        "salescode",
        "points_balance",
        F.when(F.col("is_ib") == 1, "True").otherwise("False").alias("is_ib"),
        "member_sales_code",
        "member_lead_source",
        "agent",
        "jurisdiction",
        "member_registration_date",
        "member_first_ta_registration_date",
        "member_first_ib_ta_registration_date",
        "credit",
        amounts.used_credit(credit, equity).alias("used_credit"),
        "equity",
        amounts.positive_equity(equity, balance, credit).alias("positive_equity"),
        "balance",
        amounts.clip_positive(balance).alias("positive_balance"),
        amounts.clip_negative(balance).alias("negative_balance"),
        "currency",
        "country",
        F.col("regdate").alias("ta_registration_date"),
        "margin",
        "margin_free",
        "margin_level",
        "leverage",
        "comment",
        F.col("lead_source").alias("ta_lead_source"),
        *cfg.variant.rebate_groups,
        "member_account_type",
        "member_type",
        F.when(F.col("group").like(VANUATU_GROUP), VANUATU)
        .otherwise(F.col("report_jurisdiction"))
        .alias("report_jurisdiction"),
    )

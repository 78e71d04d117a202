"""Jobs around the report: adjustments, replication, usage search, lineage, long queries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eodledger.functions.times import ntz
from eodledger.operators.joins import semi_on
from eodledger.operators.naming import found_in
from eodledger.session import stored
from eodledger.sources.operational import TRANSACTION_COLUMNS
from eodledger.sources.shards import touched_shards
from eodledger.sources.tables import as_strings, full_refresh, preview

# Which queries of a history count as running, and whose are left alone.
RUNNING = "RUNNING"
SYSTEM_USER = "SNOWFLAKE"
LONG = timedelta(hours=1)
SUMMARY_HEAD = "Long-running queries cancelled: "

# The deal columns an adjustment delivers.
DEAL_COLUMNS = ("deal", "time", "timeMsc", "login", "server")

# Names after INSERT INTO, and after FROM or JOIN, in lowered texts.
TARGET_NAME = r"\binsert\s+into\s+(?:table\s+)?([\w.]+)"
SOURCE_NAME = r"\b(?:from|join)\s+([\w.]+)"
INSERT = "insert"
STATEMENT_START = r";|(?=\binsert\s+into\b)"


def keyed_extract(
    source: DataFrame, keys: DataFrame, key: str, columns: Sequence[str] = TRANSACTION_COLUMNS
) -> DataFrame:
    """Copy the named columns of the rows whose key is listed, without multiplying any."""
    return semi_on(source.select(*columns), keys, [key])


def adjusted_deals(
    adjustments: DataFrame, crm: DataFrame, trades: DataFrame, deals: DataFrame
) -> DataFrame:
    """Deal rows behind a file of transaction adjustments.

    adjustments: ``crm_transaction_no``. crm: ``no``, ``ticket``, ``external_id``,
    ``created_at``. trades: ``ticket``, ``login``, ``server``. deals: the sharded source
    as one frame with ``server`` and ``year`` tags.

    The deal list stays a frame: a semi join on the shard tags and the (deal, login)
    pair replaces one literal predicate list per shard. It is stored first, and only the
    shards it names are read.
    """
    listed = adjustments.select(F.col("crm_transaction_no").alias("no"))
    adjusted = semi_on(crm.select("no", "ticket", "external_id", "created_at"), listed, ["no"])
    wanted = (
        adjusted.join(
            trades.select(
                F.col("ticket").alias("trade_ticket"),
                F.col("login").cast("string").alias("trade_login"),
                "server",
            ),
            (F.col("ticket") == F.col("trade_ticket")) & (F.col("external_id") == F.col("trade_login")),
        )
        .where(F.col("server").isNotNull() & F.col("created_at").isNotNull())
        .select(
            "server",
            F.year("created_at").alias("year"),
            F.col("ticket").alias("deal"),
            F.col("external_id").alias("login_text"),
        )
    )
    wanted = stored(wanted.distinct(), "wanted")
    tagged = touched_shards(deals, wanted).withColumn("login_text", F.col("login").cast("string"))
    return semi_on(tagged, wanted, ["server", "year", "deal", "login_text"]).select(*DEAL_COLUMNS)


def save(df: DataFrame, table: str) -> DataFrame:
    """Replace a table by a frame and return a preview of it."""
    full_refresh(df, table)
    return preview(df.sparkSession.table(table))


def replicate(source: DataFrame, keys: DataFrame, table: str) -> DataFrame:
    """Copy the transactions with listed ids into a warehouse table."""
    return save(keyed_extract(source, keys, "id"), table)


def adjust_transactions(
    adjustment_file: DataFrame, crm: DataFrame, trades: DataFrame, deals: DataFrame, schema: str, suffix: str
) -> DataFrame:
    """Save an adjustment file, the CRM rows it names and the deals behind them.

    The CRM rows are read back from their table, so the deals step starts from what was
    saved.
    """
    save(as_strings(adjustment_file), f"{schema}.adj_transactions_{suffix}")
    listed = adjustment_file.select(F.col("crm_transaction_no").alias("no"))
    save(semi_on(crm.select(*TRANSACTION_COLUMNS), listed, ["no"]), f"{schema}.crm_transaction_adj_{suffix}")
    saved = adjustment_file.sparkSession.table(f"{schema}.crm_transaction_adj_{suffix}")
    found = adjusted_deals(adjustment_file, saved, trades, deals)
    return save(found, f"{schema}.rs_transaction_adj_{suffix}")


@dataclass(frozen=True)
class Usage:
    """A table and some of its columns to look for in texts."""

    table: str
    columns: tuple[str, ...] = ()


def usage_frame(spark: SparkSession, usages: Sequence[Usage]) -> DataFrame:
    """``table, columns`` of listed usages, for ``name_usage``."""
    return spark.createDataFrame([(u.table, list(u.columns)) for u in usages], "table string, columns array<string>")


def name_usage(corpus: DataFrame, text: str, usages: DataFrame, raw: bool = False) -> DataFrame:
    """One row per text and usage found, for any number of ``usages (table, columns)``.

    A usage is found where the lowered text holds the lowered table name and any of the lowered
    column names; ``raw`` looks for the table name alone, as written, so one with capitals is never
    found. Null texts hold nothing; a usage that is listed twice is found twice. Each text is lowered
    once and read once where it lies, without an exchange, whatever the number of names.
    """
    specs = usages.select(
        F.col("table").alias("used"),
        (F.col("table") if raw else F.lower("table")).alias("name"),
        F.transform("columns", F.lower).alias("columns"),
    )
    return found_in(corpus, text, specs, not raw)


def usage_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("used").agg(F.count(F.lit(1)).alias("texts"))


def _statements(text: str) -> Column:
    """The INSERT statements of a lowered text.

    Most texts hold the word once and no semicolon: those are cut at the word, without a pattern.
    """
    first = F.locate(INSERT, F.col(text))
    once = (F.locate(INSERT, F.substr(text, first + 1)) == 0) & ~F.contains(text, F.lit(";"))
    # With the character before it, so that a word boundary can be told.
    whole = F.substr(text, F.greatest(first - 1, F.lit(1)))
    return F.when(first == 0, None).when(once, F.array(whole)).otherwise(F.filter(F.split(text, STATEMENT_START), is_insert))


def statement_edges(statements: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """The keys of a text, the number of a statement in it, and each target and source of that statement.

    A statement begins at INSERT INTO and ends at a semicolon or at the next INSERT INTO.
    Names are taken from the text by pattern: quoted identifiers are not recognised, and
    names of common table expressions or in comments count as sources. The arrays are opened with
    their empty ones kept, because Spark would otherwise work them out a second time to test their size.
    """
    one = F.col("__statement")
    sources = F.regexp_extract_all(one, F.lit(SOURCE_NAME), F.lit(1))
    return (
        statements.select(*keys, F.lower(text).alias("__text"))
        .select(*keys, F.posexplode_outer(_statements("__text")).alias("statement", "__statement"))
        .select(*keys, "statement", F.regexp_extract(one, TARGET_NAME, 1).alias("target"), F.array_distinct(sources).alias("__sources"))
        .select(*keys, "statement", "target", F.explode_outer("__sources").alias("source"))
        .where("target <> '' AND source IS NOT NULL")
    )


def is_insert(statement: Column) -> Column:
    return F.rlike(statement, F.lit(TARGET_NAME))


def lineage_edges(statements: DataFrame, text: str) -> DataFrame:
    """Distinct (target, source) tables of INSERT … SELECT statements, with statement counts."""
    found = statement_edges(statements, text, ())
    return found.groupBy("target", "source").agg(F.count(F.lit(1)).alias("statements"))


def long_running(history: DataFrame, now: datetime) -> DataFrame:
    """Queries still running that started more than an hour before ``now``."""
    return history.where(
        (F.col("execution_status") == RUNNING)
        & (F.col("start_time") < ntz(now - LONG))
        & (F.col("user_name") != SYSTEM_USER)
    ).select("query_id", "start_time", "user_name")


def _id_text() -> Column:
    """The ids of a group, newest first, each followed by a comma."""
    ordered = F.sort_array(F.collect_list(F.struct("start_time", "query_id")), asc=False)
    ids = F.array_join(F.transform(ordered, lambda e: F.concat(e["query_id"], F.lit(", "))), "")
    return F.concat(F.lit(SUMMARY_HEAD), ids).alias("summary")


def long_running_summary(running: DataFrame) -> DataFrame:
    """For each hour of start the ids as text, newest first, each followed by a comma.

    The lines depend on the rows alone, not on how many there are. A line holds an hour: where
    an hour can hold more ids than one task, take ``long_running_lines``.
    """
    return running.groupBy(F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("queries"), _id_text()
    )


def long_running_lines(running: DataFrame) -> DataFrame:
    """The same text in lines of one minute and one part, the first digit of the id's MD5.

    Minute and part follow from the row, so lines do not depend on the number of rows, and an
    hour with most of them is dealt over 960 groups. ``queries`` counts the hour, which the lines
    are joined to by a count that is combined before it is exchanged.
    """
    dealt = running.select(
        "*",
        F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour"),
        F.minute("start_time").alias("minute"),
        F.substring(F.md5(F.col("query_id").cast("binary")), 1, 1).alias("part"),
    )
    lines = dealt.groupBy("hour", "minute", "part").agg(F.count(F.lit(1)).alias("line_queries"), _id_text())
    hours = lines.groupBy("hour").agg(F.sum("line_queries").alias("queries"))
    return lines.join(hours, "hour").select("hour", "minute", "part", "queries", "line_queries", "summary")

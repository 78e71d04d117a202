"""Jobs around the report over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eodledger.catalog.registry import registered
from eodledger.plans import jobs
from eodledger.plans.jobs import Usage, usage_frame
from eodledger.session import scratch_path
from eodledger.sources.shards import read_shard_tree, write_shard_tree

USAGES = (Usage("Then", ("the ", "and")), Usage("eaux", ("MENT", "zzzz")), Usage("hand", ("nowhere",)))


def _usage(t, raw=False):
    texts = t.documents.select("doc_id", "text")
    return jobs.name_usage(texts, "text", usage_frame(texts.sparkSession, USAGES), raw)


@registered(
    "name_usage",
    """SELECT doc_id, used FROM documents, LATERAL (SELECT unnest([
            CASE WHEN contains(lower(text), 'then') AND regexp_matches(lower(text), 'the |and') THEN 'Then' END,
            CASE WHEN contains(lower(text), 'eaux') AND regexp_matches(lower(text), 'ment|zzzz') THEN 'eaux' END,
            CASE WHEN contains(lower(text), 'hand') AND contains(lower(text), 'nowhere') THEN 'hand' END]) AS used)
        WHERE used IS NOT NULL""",
)
def name_usage(t):
    return _usage(t)


@registered(
    "name_usage_raw",
    """SELECT doc_id, used FROM documents, LATERAL (SELECT unnest([
            CASE WHEN contains(lower(text), 'Then') THEN 'Then' END,
            CASE WHEN contains(lower(text), 'eaux') THEN 'eaux' END,
            CASE WHEN contains(lower(text), 'hand') THEN 'hand' END]) AS used)
        WHERE used IS NOT NULL""",
)
def name_usage_raw(t):
    return _usage(t, raw=True)


@registered(
    "name_usage_counts",
    """SELECT used, count(*) AS texts FROM (
          SELECT CASE WHEN contains(lower(text), 'then') AND regexp_matches(lower(text), 'the |and') THEN 'Then' END AS used FROM documents
          UNION ALL
          SELECT CASE WHEN contains(lower(text), 'eaux') AND regexp_matches(lower(text), 'ment|zzzz') THEN 'eaux' END FROM documents
          UNION ALL
          SELECT CASE WHEN contains(lower(text), 'hand') AND contains(lower(text), 'nowhere') THEN 'hand' END FROM documents)
        WHERE used IS NOT NULL GROUP BY used""",
)
def name_usage_counts(t):
    return jobs.usage_counts(_usage(t))


@registered(
    "table_lineage_edges",
    """WITH s AS (SELECT 'mart.' || event_type || '_daily' AS target, 'stage.' || event_type AS a,
            'dim.segment_' || (user_id % 7) AS b FROM events)
        SELECT target, unnest([a, b]) AS source, count(*) AS statements FROM s GROUP BY 1, 2""",
)
def table_lineage_edges(t):
    segment = (F.col("user_id") % 7).cast("string")
    statement = F.concat(
        F.lit("INSERT INTO mart."),
        F.col("event_type"),
        F.lit("_daily (user_id, total)\nSELECT e.user_id, SUM(e.value) AS from_value\nFROM stage."),
        F.col("event_type"),
        F.lit(" e\nLEFT JOIN DIM.segment_"),
        segment,
        F.lit(" s ON s.user_id = e.user_id GROUP BY e.user_id"),
    )
    return jobs.lineage_edges(t.events.select(statement.alias("statement")), "statement")


@registered(
    "txn_adjustment",
    """WITH adj AS (SELECT DISTINCT 'T' || l_orderkey AS no FROM lineitem WHERE l_returnflag = 'R'),
          pairs AS (SELECT DISTINCT o_orderstatus AS server, year(o_orderdate) AS y, o_orderkey, o_custkey
                    FROM orders JOIN adj ON adj.no = 'T' || o_orderkey)
        SELECT l_orderkey AS deal, l_shipdate AS time, l_shipdate AS "timeMsc", o.o_custkey AS login,
          o.o_orderstatus AS server
        FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey
        WHERE year(l_shipdate) = year(o_orderdate)
          AND (o.o_orderstatus, year(l_shipdate), l_orderkey, o.o_custkey) IN (SELECT (server, y, o_orderkey, o_custkey) FROM pairs)""",
)
def txn_adjustment(t):
    """Returned line items stand for adjusted transactions, orders for CRM and trade rows.

    A deal's shard is its own status and shipping year, which need not be the year the
    transaction was created in.
    """
    number = F.concat(F.lit("T"), F.col("l_orderkey").cast("string"))
    adjustments = t.lineitem.where(F.col("l_returnflag") == "R").select(number.alias("crm_transaction_no"))
    crm = t.orders.select(
        F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("no"),
        F.col("o_orderkey").alias("ticket"),
        F.col("o_custkey").cast("string").alias("external_id"),
        F.col("o_orderdate").alias("created_at"),
    )
    trades = t.orders.select(
        F.col("o_orderkey").alias("ticket"),
        F.col("o_custkey").alias("login"),
        F.col("o_orderstatus").alias("server"),
    )
    deals = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("deal"),
        F.col("l_shipdate").alias("time"),
        F.col("l_shipdate").alias("timeMsc"),
        F.col("o_custkey").alias("login"),
        F.col("o_orderstatus").alias("server"),
        F.year("l_shipdate").alias("year"),
    )
    return jobs.adjusted_deals(adjustments, crm, trades, _shards(t, deals))


_TREES: dict[tuple[str, str], str] = {}


def _shards(t, deals):
    """The deals as a tree of shards, written once a session, since that is how they lie."""
    own = t.spark.sparkContext.applicationId, t.folder
    if own not in _TREES:
        path = scratch_path(t.spark, "deals")
        write_shard_tree(deals, path)
        _TREES[own] = path
    return read_shard_tree(t.spark, _TREES[own])


NOW = datetime(2024, 1, 30, 12)


def _history(t):
    return t.events.select(
        F.col("event_id").cast("string").alias("query_id"),
        F.when(F.col("event_type") == "click", "RUNNING").otherwise("SUCCESS").alias("execution_status"),
        F.col("ts").alias("start_time"),
        F.when(F.col("user_id") % 10 == 0, "SNOWFLAKE")
        .otherwise(F.concat(F.lit("user"), F.col("user_id").cast("string")))
        .alias("user_name"),
    )


RUNNING_SQL = """SELECT event_id::VARCHAR AS query_id, ts AS start_time, 'user' || user_id AS user_name FROM events
    WHERE event_type = 'click' AND user_id % 10 <> 0 AND ts < TIMESTAMP '2024-01-30 11:00:00'"""


@registered("long_running", RUNNING_SQL)
def long_running(t):
    return jobs.long_running(_history(t), NOW)


@registered(
    "long_running_summary",
    f"""SELECT date_trunc('hour', start_time) AS hour, count(*) AS queries,
          'Long-running queries cancelled: ' || string_agg(query_id || ', ', '' ORDER BY start_time DESC, query_id DESC) AS summary
        FROM ({RUNNING_SQL}) GROUP BY 1""",
)
def long_running_summary(t):
    return jobs.long_running_summary(jobs.long_running(_history(t), NOW))


@registered(
    "long_running_lines",
    f"""WITH r AS (
          SELECT date_trunc('hour', start_time) AS hour, minute(start_time)::INT AS minute, md5(query_id)[1] AS part, *
          FROM ({RUNNING_SQL}))
        SELECT hour, minute, part, (sum(count(*)) OVER (PARTITION BY hour))::BIGINT AS queries, count(*) AS line_queries,
          'Long-running queries cancelled: ' || string_agg(query_id || ', ', '' ORDER BY start_time DESC, query_id DESC) AS summary
        FROM r GROUP BY hour, minute, part""",
)
def long_running_lines(t):
    return jobs.long_running_lines(jobs.long_running(_history(t), NOW))

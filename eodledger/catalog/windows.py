"""Ranking, snapshots and time buckets over the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from eodledger.catalog.registry import registered
from eodledger.functions.times import day_literal, half_hour_floor, seconds_between
from eodledger.operators import dedup
from eodledger.operators.rates import daily_close as closes
from eodledger.operators.rates import latest_rate_lookup as with_latest_rate

NEWEST_EVENT = "PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC"


@registered(
    "latest_per_key", f"SELECT * FROM events QUALIFY row_number() OVER ({NEWEST_EVENT}) = 1"
)
def latest_per_key(t):
    return dedup.latest_per_key(t.events, ["user_id"], "ts", ["event_id"])


@registered(
    "first_per_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) = 1",
)
def first_per_key(t):
    return dedup.first_per_key(t.events, ["user_id"], "ts", ["event_id"])


@registered(
    "as_of_snapshot",
    f"""SELECT * FROM events WHERE time_bucket(INTERVAL '30 minutes', ts) <= TIMESTAMP '2024-01-15'
        QUALIFY row_number() OVER ({NEWEST_EVENT}) = 1""",
)
def as_of_snapshot(t):
    return dedup.as_of_snapshot(
        t.events, ["user_id"], "ts", datetime(2024, 1, 15), ["event_id"], bucketed=True
    )


@registered(
    "as_of_with_grace",
    f"""SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:20:00'
        QUALIFY row_number() OVER ({NEWEST_EVENT}) = 1""",
)
def as_of_with_grace(t):
    return dedup.as_of_snapshot(t.events, ["user_id"], "ts", datetime(2024, 1, 15, 0, 20), ["event_id"])


@registered(
    "rank_then_filter",
    f"""SELECT * FROM (SELECT * FROM events QUALIFY row_number() OVER ({NEWEST_EVENT}) = 1)
        WHERE event_type <> 'error'""",
)
def rank_then_filter(t):
    return dedup.rank_then_keep(t.events, ["user_id"], "ts", F.col("event_type") != "error", ["event_id"])


@registered(
    "filter_then_rank",
    f"""SELECT * FROM events WHERE event_type <> 'error' QUALIFY row_number() OVER ({NEWEST_EVENT}) = 1""",
)
def filter_then_rank(t):
    return dedup.keep_then_rank(t.events, ["user_id"], "ts", F.col("event_type") != "error", ["event_id"])


@registered(
    "union_dedup",
    """SELECT * FROM (FROM orders WHERE o_orderstatus = 'F' UNION ALL FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F')
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def union_dedup(t):
    filled = F.col("o_orderstatus").eqNullSafe(F.lit("F"))
    sets = [t.orders.where(filled), t.orders.where(~filled)]
    return dedup.union_latest(sets, ["o_custkey"], "o_orderdate", ["o_orderkey"])


@registered(
    "daily_close",
    """SELECT DISTINCT event_type, ts::DATE AS day,
          first_value(value) OVER (PARTITION BY event_type, ts::DATE ORDER BY ts DESC) AS close
        FROM events""",
)
def daily_close(t):
    return closes(t.events, "event_type", "ts", "value")


@registered(
    "half_hour_floor",
    """SELECT CASE WHEN minute(ts) >= 30 THEN date_trunc('hour', ts) + INTERVAL 30 MINUTE
          ELSE date_trunc('hour', ts) END AS bucket, count(*) AS events FROM events GROUP BY 1""",
)
def half_hour_buckets(t):
    return t.events.groupBy(half_hour_floor(F.col("ts")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("events")
    )


@registered(
    "seconds_between",
    "SELECT user_id, datediff('second', min(ts), max(ts)) AS seconds FROM events GROUP BY user_id",
)
def user_seconds(t):
    spans = t.events.groupBy("user_id").agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
    return spans.select("user_id", seconds_between(F.col("first"), F.col("last")).alias("seconds"))


SEGMENT_TYPE = {
    "AUTOMOBILE": "click",
    "BUILDING": "view",
    "FURNITURE": "purchase",
    "MACHINERY": "signup",
}


@registered(
    "latest_rate_lookup",
    """WITH closes AS (SELECT event_type, ts::DATE AS day, arg_max(value, ts) AS close FROM events GROUP BY ALL)
        SELECT c_custkey, kind, event_type, day, close
        FROM (SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'click' WHEN 'BUILDING' THEN 'view'
                WHEN 'FURNITURE' THEN 'purchase' WHEN 'MACHINERY' THEN 'signup' END AS kind FROM customer)
        LEFT JOIN closes ON event_type = kind AND DATE '2024-01-30' <= DATE '2024-01-30'
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY day DESC) = 1""",
)
def latest_rate_lookup(t):
    kinds = F.create_map(*[F.lit(x) for pair in SEGMENT_TYPE.items() for x in pair])
    customers = t.customer.select("c_custkey", F.try_element_at(kinds, F.col("c_mktsegment")).alias("kind"))
    report_day = day_literal(datetime(2024, 1, 30).date())
    return with_latest_rate(
        customers,
        closes(t.events, "event_type", "ts", "value"),
        "kind",
        "event_type",
        "day",
        only_if=report_day <= report_day,
    )

"""Projections, predicates and value normalisation over the given tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from eodledger.catalog.registry import registered
from eodledger.functions import texts
from eodledger.functions.times import ntz, ymd_window
from eodledger.operators.skew import left_join_hot_right

URGENT = ("1-URGENT", "2-HIGH")


@registered(
    "in_list_filter",
    """SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('F')""",
)
def in_list_filter(t):
    return t.orders.where(
        F.col("o_orderpriority").isin(*URGENT) & ~F.col("o_orderstatus").isin("F")
    ).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@registered(
    "name_exclusion",
    """SELECT p_partkey, p_name, p_type FROM part
        WHERE NOT regexp_matches(lower(p_name), 'ring|bolt') AND NOT starts_with(p_name, 'small')
          AND NOT contains(p_type, 'ECON')""",
)
def name_exclusion(t):
    return t.part.where(
        texts.none_like(F.lower("p_name"), ("%ring%", "%bolt%"))
        & texts.none_like(F.col("p_name"), ("small%",))
        & texts.none_like(F.col("p_type"), ("%ECON%",))
    ).select("p_partkey", "p_name", "p_type")


@registered(
    "exclude_or_null",
    """SELECT c_custkey, o_orderkey, o_orderpriority FROM customer LEFT JOIN orders ON o_custkey = c_custkey
        WHERE (lower(o_orderpriority) NOT LIKE '%urgent%' AND lower(o_orderpriority) NOT LIKE '%low%')
          OR o_orderpriority IS NULL""",
)
def exclude_or_null(t):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderpriority")
    joined = left_join_hot_right(t.customer.select("c_custkey"), orders, "c_custkey", "o_custkey")
    kept = texts.none_like_or_null(F.lower("o_orderpriority"), ("%urgent%", "%low%"))
    return joined.where(kept).drop("o_custkey")


@registered(
    "last_segment_filter",
    """SELECT page_id, split_part(url, '/', -1) AS last_segment FROM pages
        WHERE split_part(url, '/', -1) NOT IN ('index.html', '') AND split_part(url, '/', -1) NOT LIKE '1%'""",
)
def last_segment_filter(t):
    last = texts.last_segment(F.col("url"), "/")
    return (
        t.pages.select("page_id", last.alias("last_segment"))
        .where(~F.col("last_segment").isin("index.html", ""))
        .where(~F.col("last_segment").like("1%"))
    )


@registered(
    "date_window_filter",
    """SELECT l_orderkey, l_linenumber, l_partkey, year(l_shipdate)::INT AS year,
          month(l_shipdate)::INT AS month, day(l_shipdate)::INT AS day
        FROM lineitem WHERE l_shipdate::DATE BETWEEN DATE '1996-02-29' AND DATE '1996-03-31'""",
)
def date_window_filter(t):
    parts = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.dayofmonth("l_shipdate").alias("day"),
    )
    return parts.where(ymd_window(date(1996, 2, 29), date(1996, 3, 31)))


@registered(
    "between_inclusive",
    """SELECT o_orderkey, o_orderdate FROM orders
        WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-03-01'""",
)
def between_inclusive(t):
    within = F.col("o_orderdate").between(ntz(datetime(1996, 1, 1)), ntz(datetime(1996, 3, 1)))
    return t.orders.where(within).select("o_orderkey", "o_orderdate")


@registered(
    "soft_delete_filter",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_linestatus FROM lineitem
        WHERE l_linestatus = 'O' AND nullif(l_returnflag, 'N') IS NULL""",
)
def soft_delete_filter(t):
    deleted = F.nullif(F.col("l_returnflag"), F.lit("N"))
    return t.lineitem.where((F.col("l_linestatus") == "O") & deleted.isNull()).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus"
    )


@registered(
    "country_normalise",
    """SELECT CASE upper(raw) WHEN 'USA' THEN 'UNITED STATES' WHEN 'UK' THEN 'UNITED KINGDOM' WHEN 'TW' THEN 'TAIWAN'
          ELSE coalesce(nullif(upper(translate(raw, '0123456789', '')), ''),
            CASE WHEN raw IS NOT NULL THEN 'UNKNOWN OR INVALID REGION' END) END AS country,
          count(*) AS customers
        FROM (SELECT CASE n_nationkey WHEN 0 THEN 'usa' WHEN 1 THEN 'Uk' WHEN 2 THEN 'TW' WHEN 3 THEN '123'
                WHEN 4 THEN NULL ELSE lower(n_name) END AS raw
              FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)
        GROUP BY 1""",
)
def country_normalise(t):
    key = F.col("n_nationkey")
    raw = (
        F.when(key == 0, "usa")
        .when(key == 1, "Uk")
        .when(key == 2, "TW")
        .when(key == 3, "123")
        .when(key == 4, None)
        .otherwise(F.lower("n_name"))
    )
    nations = t.nation.select("n_nationkey", texts.canonical_name(raw).alias("country"))
    return (
        t.customer.join(nations, F.col("c_nationkey") == key, "left")
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("customers"))
    )

"""Joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from eodledger.catalog.registry import registered
from eodledger.operators import joins, skew
from eodledger.plans.jobs import keyed_extract as extract

TEMPLATES = [("%RING", "jewel"), ("%bolt%", "metal"), ("small%", "size"), ("s____ %", "five"), ("%", "any")]


@registered(
    "dim_left_join",
    """SELECT c_custkey, c_name, n_name, r_name FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def dim_left_join(t):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "c_name", "n_name", "r_name")
    )


@registered(
    "cast_key_join",
    """SELECT o_orderkey, c_custkey, c_name FROM orders
        LEFT JOIN customer ON c_custkey::VARCHAR = o_custkey::VARCHAR AND c_nationkey = o_orderkey % 25""",
)
def cast_key_join(t):
    orders = t.orders.select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 25).alias("nation"))
    joined = joins.cast_key_join(orders, t.customer, {"o_custkey": "c_custkey", "nation": "c_nationkey"})
    return joined.select("o_orderkey", "c_custkey", "c_name")


@registered(
    "inner_cast_join",
    """SELECT o_orderkey, c_mktsegment, year(o_orderdate)::INT AS year_num FROM orders
        JOIN customer ON c_custkey::VARCHAR = o_custkey::VARCHAR""",
)
def inner_cast_join(t):
    joined = joins.cast_key_join(t.orders, t.customer, {"o_custkey": "c_custkey"}, "inner")
    return joined.select("o_orderkey", "c_mktsegment", F.year("o_orderdate").alias("year_num"))


@registered(
    "salted_inner_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey""",
)
def salted_inner_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return skew.salted_join(lines, parts, ["l_partkey"], "inner", share=0.0005, salts=8)


@registered(
    "semi_distinct_keys",
    "SELECT o_custkey FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1",
)
def semi_distinct_keys(t):
    keys = t.orders.select("o_custkey").distinct()
    return keys.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@registered(
    "first_dates_full_outer",
    """SELECT coalesce(f.o_custkey, o.o_custkey) AS o_custkey, first_f, first_o
        FROM (SELECT o_custkey, min(o_orderdate) AS first_f FROM orders
              WHERE o_orderstatus = 'F' GROUP BY 1) f
        FULL JOIN (SELECT o_custkey, min(o_orderdate) AS first_o FROM orders
              WHERE o_orderstatus = 'O' GROUP BY 1) o ON f.o_custkey = o.o_custkey""",
)
def first_dates_full_outer(t):
    def first(status, name):
        rows = t.orders.where(F.col("o_orderstatus") == status)
        return rows.groupBy("o_custkey").agg(F.min("o_orderdate").alias(name))

    return joins.first_or_either(first("F", "first_f"), first("O", "first_o"), "o_custkey")


@registered(
    "or_residual_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus, o_orderkey, o_orderstatus, o_orderpriority
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
          AND (o_orderstatus = l_linestatus OR o_orderpriority LIKE '1%')""",
)
def or_residual_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    loose = (F.col("o_orderstatus") == F.col("l_linestatus")) | F.col("o_orderpriority").like("1%")
    return joins.residual_or_join(lines, orders, "l_orderkey", "o_orderkey", loose)


@registered(
    "anti_join",
    """SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'O'
          AND o_orderpriority = '1-URGENT'
        WHERE o_orderkey IS NULL""",
)
def anti_join(t):
    urgent = t.orders.where((F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "1-URGENT"))
    return t.customer.select("c_custkey", "c_name").join(
        urgent.select("o_custkey").distinct(), F.col("c_custkey") == F.col("o_custkey"), "left_anti"
    )


@registered(
    "not_in_null_aware",
    """SELECT 'without null' AS list, o_orderkey FROM orders
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
        UNION ALL SELECT 'with null', o_orderkey FROM orders
        WHERE o_custkey NOT IN (SELECT CASE WHEN c_acctbal < 0 THEN c_custkey END FROM customer)
        UNION ALL SELECT 'empty', o_orderkey FROM orders
        WHERE nullif(o_orderkey % 3, 0) NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal IS NULL)
        UNION ALL SELECT 'null probe', o_orderkey FROM orders
        WHERE nullif(o_orderkey % 3, 0) NOT IN (SELECT c_custkey FROM customer WHERE c_custkey <> 1)""",
)
def not_in_null_aware(t):
    key = F.col("c_custkey")
    owner = F.col("o_custkey")
    probe = F.nullif(F.col("o_orderkey") % 3, F.lit(0))
    negative = F.col("c_acctbal") < 0
    cases = {
        "without null": (owner, t.customer.where(negative), key),
        "with null": (owner, t.customer, F.when(negative, key)),
        "empty": (probe, t.customer.where(F.col("c_acctbal").isNull()), key),
        "null probe": (probe, t.customer.where(key != 1), key),
    }
    parts = [
        joins.not_in(t.orders, probe_key, listed, listed_key).select(F.lit(name).alias("list"), "o_orderkey")
        for name, (probe_key, listed, listed_key) in cases.items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


LIKE_SQL = """SELECT p_partkey, p_name, pattern, kind FROM part
    LEFT JOIN (VALUES ('%RING', 'jewel'), ('%bolt%', 'metal'), ('small%', 'size'), ('s____ %', 'five'), ('%', 'any'))
      v(pattern, kind) ON p_name ILIKE pattern"""


def _templates(t):
    return t.spark.createDataFrame(TEMPLATES, "pattern string, kind string")


@registered("like_template_join", LIKE_SQL)
def like_template_join(t):
    return joins.like_template_join(t.part.select("p_partkey", "p_name"), "p_name", _templates(t), "pattern")


@registered("like_template_join_by_token", LIKE_SQL)
def like_template_join_by_token(t):
    parts = t.part.select("p_partkey", "p_name")
    return joins.like_template_join(parts, "p_name", _templates(t), "pattern")


@registered(
    "validity_range_join",
    """SELECT event_id, e.event_type, ts::DATE AS day, first_day, last_day FROM events e
        JOIN (SELECT event_type, min(ts)::DATE + 5 AS first_day, max(ts)::DATE - 5 AS last_day
              FROM events GROUP BY 1) p
          ON p.event_type = e.event_type AND ts::DATE BETWEEN first_day AND last_day""",
)
def validity_range_join(t):
    periods = t.events.groupBy(F.col("event_type").alias("period_type")).agg(
        F.date_add(F.to_date(F.min("ts")), 5).alias("first_day"),
        F.date_sub(F.to_date(F.max("ts")), 5).alias("last_day"),
    )
    facts = t.events.select("event_id", "event_type", F.to_date("ts").alias("day"))
    return joins.validity_join(
        facts, periods, "event_type", "day", "period_type", "first_day", "last_day"
    ).drop("period_type")


@registered(
    "self_join_parent",
    """SELECT c.c_custkey, nullif(c.c_custkey // 10, 0) AS parent, p.c_name AS agent
        FROM customer c LEFT JOIN customer p ON p.c_custkey = nullif(c.c_custkey // 10, 0)""",
)
def self_join_parent(t):
    parent = F.nullif(F.floor(F.col("c_custkey") / 10), F.lit(0)).cast("bigint")
    children = t.customer.select("c_custkey", parent.alias("parent"))
    parents = t.customer.select(F.col("c_custkey").alias("parent_key"), F.col("c_name").alias("agent"))
    return skew.left_join_spread_nulls(children, parents, "parent", "parent_key", "c_custkey").drop(
        "parent_key"
    )


RATE_TYPES = {n.lower(): n for n in ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE")}


@registered(
    "rate_pivot",
    """WITH r AS (SELECT p_brand, p_size, p_type, max(p_retailprice) AS rate FROM part GROUP BY ALL)
        SELECT e.p_brand, e.p_size, e.rate AS economy, s.rate AS small, m.rate AS medium, p.rate AS promo,
          t.rate AS standard, l.rate AS large
        FROM r e
        LEFT JOIN r s ON (s.p_brand, s.p_size, s.p_type) = (e.p_brand, e.p_size, 'SMALL')
        LEFT JOIN r m ON (m.p_brand, m.p_size, m.p_type) = (e.p_brand, e.p_size, 'MEDIUM')
        LEFT JOIN r p ON (p.p_brand, p.p_size, p.p_type) = (e.p_brand, e.p_size, 'PROMO')
        LEFT JOIN r t ON (t.p_brand, t.p_size, t.p_type) = (e.p_brand, e.p_size, 'STANDARD')
        LEFT JOIN r l ON (l.p_brand, l.p_size, l.p_type) = (e.p_brand, e.p_size, 'LARGE')
        WHERE e.p_type = 'ECONOMY'""",
)
def rate_pivot(t):
    rates = t.part.groupBy(F.struct("p_brand", "p_size").alias("id"), "p_type").agg(
        F.max("p_retailprice").alias("rate")
    )
    wide = joins.rate_pivot(rates, "id", "p_type", "rate", RATE_TYPES, unique=True)
    return wide.select("id.p_brand", "id.p_size", *RATE_TYPES)


@registered(
    "rate_pivot_repeats",
    """WITH r AS (SELECT p_brand || '/' || (p_size % 25) AS id, p_type, p_retailprice AS rate FROM part)
        SELECT e.id, e.rate AS economy, s.rate AS small, m.rate AS medium
        FROM r e LEFT JOIN r s ON s.id = e.id AND s.p_type = 'SMALL' LEFT JOIN r m ON m.id = e.id AND m.p_type = 'MEDIUM'
        WHERE e.p_type = 'ECONOMY'""",
)
def rate_pivot_repeats(t):
    """Several rates for one (id, group) pair: the pairs multiply."""
    rates = t.part.select(
        F.concat_ws("/", "p_brand", (F.col("p_size") % 25).cast("string")).alias("id"), "p_type", F.col("p_retailprice").alias("rate")
    )
    return joins.rate_pivot(rates, "id", "p_type", "rate", {n: RATE_TYPES[n] for n in ("economy", "small", "medium")})


@registered(
    "keyed_extract",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
        WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def keyed_extract(t):
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return extract(t.orders, returned, "o_orderkey", t.orders.columns)


@registered(
    "pair_semi_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM lineitem
        WHERE (l_orderkey, l_linenumber) IN
          (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O')""",
)
def pair_semi_join(t):
    pairs = t.lineitem.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return joins.semi_on(rows, pairs, ["l_orderkey", "l_linenumber"])

"""Aggregates, unions and limits over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from eodledger.catalog.registry import registered
from eodledger.operators import measures
from eodledger.operators.measures import Measure, sum_measures
from eodledger.operators.unions import union_populations as populations
from eodledger.operators.unions import union_shards
from eodledger.sources.tables import preview

PRODUCTS = {f"{n.lower()}_vol": n for n in ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE")}


@registered(
    "product_volumes",
    "SELECT l_suppkey, "
    + ", ".join(
        f"coalesce(sum(l_quantity) FILTER (WHERE p_type = '{label}') / 100.0, 0) AS {name}"
        for name, label in PRODUCTS.items()
    )
    + " FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_suppkey",
)
def product_volumes(t):
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_quantity")
    rows = lines.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"), "left")
    return rows.groupBy("l_suppkey").agg(
        *measures.product_volumes(F.col("p_type"), "l_quantity", PRODUCTS)
    )


@registered(
    "txn_measures",
    """SELECT *, deposit + withdrawal AS net, deposit + withdrawal + transfer + credit AS total FROM (
          SELECT o_custkey,
            coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority[1] = '1'), 2), 0) AS deposit,
            coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority[1] = '2'), 2), 0) AS withdrawal,
            coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'O' AND o_orderpriority[1] IN ('1', '2')), 2), 0) AS transfer,
            coalesce(round(sum(o_totalprice) FILTER (WHERE o_orderstatus = 'P'), 2), 0) AS credit
          FROM orders GROUP BY o_custkey)""",
)
def txn_measures(t):
    status, head = F.col("o_orderstatus"), F.left("o_orderpriority", F.lit(1))
    rules = [
        Measure("deposit", (status == "F") & (head == "1")),
        Measure("withdrawal", (status == "F") & (head == "2")),
        Measure("transfer", (status == "O") & head.isin("1", "2")),
        Measure("credit", status == "P"),
    ]
    totals = {"net": ("deposit", "withdrawal"), "total": ("deposit", "withdrawal", "transfer", "credit")}
    return sum_measures(t.orders, ["o_custkey"], "o_totalprice", rules, totals)


EVENT_TYPES = ("view", "click", "signup", "purchase", "error")


@registered(
    "wallet_measures",
    "SELECT *, "
    + " + ".join(EVENT_TYPES)
    + " AS total FROM (SELECT user_id, "
    + ", ".join(
        f"coalesce(round(sum(CASE WHEN event_type = '{e}' THEN value ELSE 0 END), 2), 0) AS {e}"
        for e in EVENT_TYPES
    )
    + " FROM events GROUP BY user_id)",
)
def wallet_measures(t):
    rules = [Measure(e, F.col("event_type") == e) for e in EVENT_TYPES]
    return sum_measures(t.events, ["user_id"], "value", rules, {"total": EVENT_TYPES})


@registered(
    "pnl_rollup",
    """SELECT l_suppkey, round(sum(l_extendedprice), 2) AS price,
          round(sum(l_extendedprice + l_discount + nullif(l_tax, 0)), 2) AS pnl,
          round(sum(CASE WHEN l_linenumber = 9 THEN l_tax END), 2) AS never
        FROM lineitem GROUP BY l_suppkey""",
)
def pnl_rollup(t):
    tax = F.nullif(F.col("l_tax"), F.lit(0.0))
    return t.lineitem.groupBy("l_suppkey").agg(
        measures.rounded_sum(F.col("l_extendedprice")).alias("price"),
        measures.rounded_sum(F.col("l_extendedprice") + F.col("l_discount") + tax).alias("pnl"),
        measures.rounded_sum(F.when(F.col("l_linenumber") == 9, F.col("l_tax"))).alias("never"),
    )


@registered(
    "order_state_counts",
    """SELECT o_custkey, count(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS open_orders,
          count(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS pending_orders,
          count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS closed_orders,
          sum(CASE WHEN o_orderstatus = 'F' THEN month(o_orderdate) END)
            / nullif(count(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END), 0) AS mean_month
        FROM orders GROUP BY o_custkey""",
)
def order_state_counts(t):
    status = F.col("o_orderstatus")
    states = {"open_orders": status == "O", "pending_orders": status == "P", "closed_orders": status == "F"}
    counts = measures.state_counts(states, "o_orderkey")
    months = F.sum(F.when(status == "F", F.month("o_orderdate"))).alias("months")
    return (
        t.orders.groupBy("o_custkey")
        .agg(*counts, months)
        .withColumn("mean_month", F.try_divide("months", "closed_orders"))
        .drop("months")
    )


@registered(
    "open_order_count",
    """SELECT l_suppkey, count(DISTINCT l_orderkey) AS open_orders FROM lineitem
        WHERE l_linestatus = 'O' GROUP BY l_suppkey""",
)
def open_order_count(t):
    rows = t.lineitem.where(F.col("l_linestatus") == "O")
    return rows.groupBy("l_suppkey").agg(F.count_distinct("l_orderkey").alias("open_orders"))


@registered(
    "lifetime_profit",
    """SELECT o_custkey, 'wallet' AS server, round(sum(o_totalprice), 2) AS profit_sum,
          max(o_orderdate)::DATE AS last_day FROM orders GROUP BY 1, 2""",
)
def lifetime_profit(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(
            measures.rounded_sum(F.col("o_totalprice")).alias("profit_sum"),
            F.to_date(F.max("o_orderdate")).alias("last_day"),
        )
        .withColumn("server", F.lit("wallet"))
    )


@registered("distinct_rows", "SELECT DISTINCT p_brand, p_type, p_size FROM part")
def distinct_rows(t):
    return t.part.select("p_brand", "p_type", "p_size").distinct()


@registered(
    "union_populations",
    """SELECT DISTINCT c_nationkey AS nation, c_name AS name FROM customer
        UNION ALL SELECT NULL, s_name FROM supplier""",
)
def union_populations(t):
    customers = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name")).distinct()
    return populations(customers, t.supplier.select(F.col("s_name").alias("name")), "nation")


@registered(
    "shard_union",
    """SELECT o_orderkey, o_totalprice, year(o_orderdate)::INT AS year, o_orderstatus AS server FROM orders
        WHERE o_orderstatus IS NOT NULL AND o_orderdate IS NOT NULL""",
)
def shard_union(t):
    rows = t.orders.where(F.col("o_orderdate").isNotNull()).select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), "o_orderstatus"
    )
    found = rows.where(F.col("o_orderstatus").isNotNull()).groupBy("o_orderstatus").count().collect()
    names = sorted(r["o_orderstatus"] for r in found)  # one for each server there is
    shards = {s: rows.where(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in names}
    return union_shards(shards, "server")


@registered(
    "preview_limit", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
)
def preview_limit(t):
    return preview(t.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey"))

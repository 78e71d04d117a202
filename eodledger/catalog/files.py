"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from eodledger.catalog.inputs import CONFIG_A, Derived
from eodledger.catalog.registry import registered
from eodledger.catalog.report_checks import check
from eodledger.plans.report.final import equity_report, output_columns
from eodledger.session import scratch_path, stored_stage
from eodledger.sources import null_marker
from eodledger.sources.corpus import scan_corpus
from eodledger.sources.tables import (
    append_by_position,
    append_path,
    as_strings,
    full_refresh_path,
    load_csv_strings,
    load_csv_typed,
    replace_days_by_position,
)


@registered(
    "csv_all_string",
    """SELECT p_partkey::VARCHAR AS p_partkey, p_name, p_brand, p_type, p_size::VARCHAR AS p_size,
          p_retailprice::VARCHAR AS p_retailprice FROM part""",
)
def csv_all_string(t):
    path = scratch_path(t.spark, "part.csv")
    null_marker.write_csv(t.part, path)
    return load_csv_strings(t.spark, path)


@registered(
    "csv_typed",
    """SELECT l_orderkey AS trading_server_transaction_no, l_suppkey AS trading_server_login,
          CASE WHEN l_returnflag = 'N' THEN '' ELSE 'flag, "' || l_returnflag || '"' END AS comment,
          CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS fund_amount FROM lineitem""",
)
def csv_typed(t):
    path = scratch_path(t.spark, "adjustments.csv")
    flag = F.concat(F.lit('flag, "'), F.col("l_returnflag"), F.lit('"'))
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("no"),
        F.col("l_suppkey").alias("login"),
        F.when(F.col("l_returnflag") == "N", "").otherwise(flag).alias("text"),
        F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice")).cast("decimal(18,2)").alias("amount"),
    )
    null_marker.write_csv(rows, path)
    typed = load_csv_typed(t.spark, path)
    return typed.withColumn("fund_amount", F.col("fund_amount").cast("double"))


@registered(
    "null_marker_roundtrip",
    """SELECT c_custkey::VARCHAR AS c_custkey,
          CASE WHEN c_nationkey = 1 THEN NULL WHEN c_nationkey = 2 THEN '' ELSE c_mktsegment END AS segment
        FROM customer""",
)
def null_marker_roundtrip(t):
    path = scratch_path(t.spark, "customer.csv")
    segment = (
        F.when(F.col("c_nationkey") == 1, None)
        .when(F.col("c_nationkey") == 2, "")
        .otherwise(F.col("c_mktsegment"))
    )
    null_marker.write_csv(t.customer.select("c_custkey", segment.alias("segment")), path)
    return null_marker.read_csv(t.spark, path)


@registered("overwrite_roundtrip", "SELECT * FROM supplier")
def overwrite_roundtrip(t):
    path = scratch_path(t.spark, "supplier")
    full_refresh_path(t.supplier.select("s_suppkey"), path)
    full_refresh_path(t.supplier, path)
    return t.spark.read.parquet(path)


@registered(
    "all_string_cast",
    """SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
          c_acctbal::VARCHAR AS c_acctbal, c_mktsegment FROM customer""",
)
def all_string_cast(t):
    return as_strings(t.customer)


@registered(
    "corpus_scan",
    "SELECT page_id, (length(html) + 1)::INT AS characters, md5(html || chr(10)) AS digest FROM pages",
)
def corpus_scan(t):
    """Pages become a tree of one file each, which is then scanned as a corpus; the writer's checksum files are left out."""
    root = scratch_path(t.spark, "corpus")
    t.pages.select("html", "page_id").write.partitionBy("page_id").text(root)
    return scan_corpus(t.spark, root).where(F.col("path").endswith(".txt")).select(
        F.regexp_extract("path", r"page_id=(\d+)", 1).cast("bigint").alias("page_id"),
        F.length("text").alias("characters"),
        F.md5(F.col("text").cast("binary")).alias("digest"),
    )


@registered(
    "report_append",
    check(CONFIG_A, "report_usd"),
)
def report_append(t):
    """The report appended as a day's partition, and that day read back."""
    path = scratch_path(t.spark, "report")
    report = equity_report(Derived(t), CONFIG_A, stored_stage(t.spark))
    append_path(report, path, output_columns(CONFIG_A), ["year", "month", "day"])
    saved = t.spark.read.schema(report.schema).parquet(path)
    return saved.where("year = '2024' and month = '01' and day = '16'").select(*output_columns(CONFIG_A))


@registered("report_append_by_position", check(CONFIG_A, "report_usd"))
def report_append_by_position(t):
    """The report inserted by position into a table of the catalog, and its files read back."""
    path, name = scratch_path(t.spark, "report_table"), f"report_{uuid.uuid4().hex}"
    report = equity_report(Derived(t), CONFIG_A, stored_stage(t.spark))
    t.spark.catalog.createTable(name, path=path, source="parquet", schema=report.schema)
    append_by_position(report, name, output_columns(CONFIG_A))
    t.spark.sql(f"DROP TABLE {name}")
    return t.spark.read.schema(report.schema).parquet(path)


@registered(
    "append_same_day_twice",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' THEN -o_totalprice ELSE o_totalprice END AS total, year(o_orderdate)::INT AS year
        FROM orders""",
)
def append_same_day_twice(t):
    """Orders inserted by position; the later years run again with other values and replace theirs."""
    path, name = scratch_path(t.spark, "orders_table"), f"orders_{uuid.uuid4().hex}"
    rows = t.orders.select("o_orderkey", F.col("o_totalprice").alias("total"), F.year("o_orderdate").alias("year"))
    t.spark.sql(f"CREATE TABLE {name} (k BIGINT, amount DOUBLE, y INT) USING parquet PARTITIONED BY (y) LOCATION '{path}'")
    replace_days_by_position(rows, name, rows.columns, ["year"])
    again = rows.where("year >= 1996").withColumn("total", -F.col("total"))
    replace_days_by_position(again, name, rows.columns, ["year"])
    t.spark.sql(f"DROP TABLE {name}")
    saved = t.spark.read.schema("k bigint, amount double, y int").parquet(path)
    return saved.select(F.col("k").alias("o_orderkey"), F.col("amount").alias("total"), F.col("y").alias("year"))

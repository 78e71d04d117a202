"""Time the headline queries: one JSON line with the seconds of each and their sum."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "report_usd",
    "report_usd_b",
    "report_lc",
    "all_accounts_info",
    "account_state",
    "trades_closed",
    "trades_volume",
    "orders_count",
    "open_orders_count",
    "trades_txn",
    "transactions",
    "wallet_transactions",
    "exchange_rates",
    "first_report",
    "latest_per_key",
    "as_of_snapshot",
    "rank_then_filter",
    "union_dedup",
    "daily_close",
    "half_hour_floor",
    "latest_rate_lookup",
    "date_window_filter",
    "exclude_or_null",
    "cast_key_join",
    "or_residual_join",
    "first_dates_full_outer",
    "anti_join",
    "not_in_null_aware",
    "like_template_join",
    "like_template_join_by_token",
    "validity_range_join",
    "self_join_parent",
    "rate_pivot",
    "keyed_extract",
    "pair_semi_join",
    "salted_inner_join",
    "product_volumes",
    "txn_measures",
    "wallet_measures",
    "pnl_rollup",
    "order_state_counts",
    "open_order_count",
    "lifetime_profit",
    "distinct_rows",
    "shard_union",
    "name_usage",
    "table_lineage_edges",
    "txn_adjustment",
    "long_running",
    "long_running_summary",
    "csv_all_string",
    "csv_typed",
)
RUNS = 3


def seconds(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from pyspark.sql import SparkSession

    from eodledger.catalog import load_all
    from eodledger.catalog.registry import QUERIES
    from eodledger.session import with_startup_settings

    load_all()
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        with_startup_settings(SparkSession.builder)
        .master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINES:
        seconds(QUERIES[name], spark, folder)
        timings[name] = round(
            statistics.median(seconds(QUERIES[name], spark, folder) for _ in range(RUNS)), 3
        )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median query seconds, after one warm-up run each",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

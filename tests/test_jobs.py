"""Jobs around the report."""

from collections import Counter
from datetime import datetime

from conftest import plan_of
from pyspark.sql import functions as F

from eodledger.operators import naming
from eodledger.plans import jobs
from eodledger.sources import shards

D = datetime
NOW = D(2024, 1, 2, 12)


def test_long_running(rows):
    history = rows(
        [
            ("a", "RUNNING", D(2024, 1, 2, 10), "u"),
            ("b", "RUNNING", D(2024, 1, 2, 11), "u"),
            ("c", "RUNNING", D(2024, 1, 2, 10, 59), "SNOWFLAKE"),
            ("d", "SUCCESS", D(2024, 1, 2, 10), "u"),
            ("e", "RUNNING", D(2024, 1, 2, 10, 59, 59), "v"),
            ("f", "RUNNING", D(2024, 1, 2, 10), None),
        ],
        "query_id string, execution_status string, start_time timestamp_ntz, user_name string",
    )
    running = jobs.long_running(history, NOW)
    assert sorted(r["query_id"] for r in running.collect()) == ["a", "e"]
    summary = jobs.long_running_summary(running).collect()
    assert {r["hour"]: r["queries"] for r in summary} == dict(Counter(r["start_time"].replace(minute=0, second=0) for r in running.collect()))
    assert sum(r["queries"] for r in summary) == 2


def test_summary_lines_do_not_depend_on_the_number(spark):
    running = spark.range(5000).select(
        F.col("id").cast("string").alias("query_id"), F.lit("2024-01-01").cast("timestamp_ntz").alias("start_time")
    )
    lines = jobs.long_running_summary(running).collect()
    assert len(lines) == 1
    ids = [i for i in lines[0]["summary"].removeprefix(jobs.SUMMARY_HEAD).split(", ") if i]
    assert sorted(ids, key=int) == [str(i) for i in range(5000)]


def test_lineage(rows):
    statements = rows(
        [
            ("INSERT INTO Analytics.Sales_Summary (region, total_sales)\nSELECT region, SUM(sales)\n"
             "FROM staging.sales_data\nGROUP BY region",),
            ("insert into a select * from B join c on b.x = c.x left join B on 1 = 1",),
            ("insert into a select * from b",),
            ("select 1 from lonely",),
        ],
        "s string",
    )
    found = sorted((r["target"], r["source"], r["statements"]) for r in jobs.lineage_edges(statements, "s").collect())
    assert found == [("a", "b", 2), ("a", "c", 1), ("analytics.sales_summary", "staging.sales_data", 1)]


def test_lineage_of_several_statements_in_a_text(rows):
    texts = rows(
        [
            (1, "select 1 from x; insert into a select * from b; INSERT INTO c select * from a join A on 1 = 1"),
            (2, "insert into d select * from e\ninsert into f select * from g; select 1 from h"),
            (3, None),
            (4, "insert into k values (1)"),
            (5, "reinsert into z select * from y"),
            (6, "select 1 from b INSERT  INTO w select * from v"),
            (7, "inserts; insert into u select * from t"),
            (8, "insert"),
        ],
        "id int, s string",
    )
    found = [tuple(r) for r in jobs.statement_edges(texts, "s", ["id"]).collect()]
    assert sorted(found) == [(1, 0, "a", "b"), (1, 1, "c", "a"), (2, 0, "d", "e"), (2, 1, "f", "g"), (6, 0, "w", "v"), (7, 0, "u", "t")]


def test_adjusted_deals(rows):
    adjustments = rows([("T1",), ("T1",), ("T2",), ("T9",)], "crm_transaction_no string")
    crm = rows(
        [("T1", 11, "500", D(2023, 5, 1)), ("T2", 12, "600", D(2024, 5, 1)), ("T3", 13, "500", D(2024, 5, 1))],
        "no string, ticket bigint, external_id string, created_at timestamp_ntz",
    )
    trades = rows(
        [(11, 500, "s1"), (11, 501, "s2"), (12, 600, "s2"), (12, 600, None), (13, 500, "s1")],
        "ticket bigint, login bigint, server string",
    )
    deals = rows(
        [
            (11, 500, "s1", 2023),
            (11, 500, "s1", 2024),
            (11, 501, "s2", 2023),
            (12, 600, "s2", 2024),
            (13, 500, "s1", 2024),
        ],
        "deal bigint, login bigint, server string, year int",
    ).withColumns({"time": F.lit("2024-01-01").cast("timestamp_ntz"), "timeMsc": F.lit("2024-01-01").cast("timestamp_ntz")})
    found = jobs.adjusted_deals(adjustments, crm, trades, deals)
    assert found.columns == list(jobs.DEAL_COLUMNS)
    assert sorted((r["deal"], r["login"], r["server"]) for r in found.collect()) == [(11, 500, "s1"), (12, 600, "s2")]


def test_only_touched_shards_are_read(spark, rows, tmp_path):
    when = "timestamp_ntz"
    deals = rows([(d, 500 + s, f"s{s}", y) for d in range(3) for s in range(4) for y in (2022, 2023, 2024)], "deal bigint, login bigint, server string, year int")
    deals = deals.withColumns({"time": F.lit("2024-01-01").cast(when), "timeMsc": F.lit("2024-01-01").cast(when)})
    tree = str(tmp_path / "tree")
    shards.write_shard_tree(deals, tree)
    source = shards.read_shard_tree(spark, tree)
    crm = rows([("T1", 1, "501", D(2023, 5, 1)), ("T2", 2, "502", D(2024, 5, 1)), ("T3", 2, "503", D(2022, 5, 1))], f"no string, ticket bigint, external_id string, created_at {when}")
    trades = rows([(1, 501, "s1"), (2, 502, "s2"), (2, 503, "s3")], "ticket bigint, login bigint, server string")
    adjustments = rows([("T1",), ("T2",)], "crm_transaction_no string")
    # every shard that no adjustment touches is broken: reading one would fail
    touched = {("s1", 2023), ("s2", 2024)}
    for s in range(4):
        for y in (2022, 2023, 2024):
            if (f"s{s}", y) not in touched:
                for file in (tmp_path / "tree" / f"server=s{s}" / f"year={y}").glob("*.parquet"):
                    file.write_bytes(b"broken")
    found = jobs.adjusted_deals(adjustments, crm, trades, source)
    assert sorted((r["deal"], r["login"], r["server"]) for r in found.collect()) == [(1, 501, "s1"), (2, 502, "s2")]
    plan = plan_of(found)
    assert "PartitionFilters" in plan and "s1" in plan.split("PartitionFilters")[1] and "s3" not in plan
    assert jobs.adjusted_deals(adjustments.limit(0), crm, trades, source).collect() == []
    tables = {("s1", 2023): rows([(1, 501)], "deal bigint, login bigint"), ("s3", 2022): rows([(2, 503)], "deal bigint, login bigint")}
    union = shards.read_shards(lambda n: tables[n.split(".")[0], int(n[-4:])], tables)
    assert [r["deal"] for r in shards.touched_shards(union, rows([("s1", 2023), (None, 1)], "server string, year int")).collect()] == [1]


def test_lines_of_a_full_hour(spark):
    running = spark.range(9000).select(
        F.col("id").cast("string").alias("query_id"),
        F.expr("timestampadd(SECOND, CAST(IF(id % 3 = 0, 7, id * 40) AS INT), TIMESTAMP_NTZ'2024-01-01')").alias("start_time"),
    )
    lines = jobs.long_running_lines(running).collect()
    first = [r for r in lines if r["hour"] == D(2024, 1, 1)]
    assert {r["queries"] for r in first} == {sum(r["line_queries"] for r in first)} and max(r["line_queries"] for r in lines) < 400
    ids = [i for r in lines for i in r["summary"].removeprefix(jobs.SUMMARY_HEAD).split(", ") if i]
    assert sorted(ids, key=int) == [str(i) for i in range(9000)]


def test_keyed_extract_keeps_duplicate_rows(rows):
    source = rows([(1, "a"), (1, "a"), (2, "b")], "id int, v string")
    keys = rows([(1,), (1,)], "id int")
    assert jobs.keyed_extract(source, keys, "id", ["id", "v"]).count() == 2


def test_jobs_save_tables(spark, rows):
    when = "timestamp_ntz"
    crm = rows(
        [(1, 11, "T1", 5, "500", None, None, D(2023, 5, 1), None), (2, 12, "T2", 5, "600", None, None, D(2024, 5, 1), None)],
        f"id bigint, ticket bigint, no string, user_id bigint, external_id string, processed_at {when}, "
        f"completed_at {when}, created_at {when}, updated_at {when}",
    )
    shown = jobs.replicate(crm, rows([(2,), (7,)], "id bigint"), "default.copied")
    assert [r["no"] for r in shown.collect()] == ["T2"]
    trades = rows([(11, 500, "s1")], "ticket bigint, login bigint, server string")
    deals = rows([(11, 500, "s1", 2023)], "deal bigint, login bigint, server string, year int").withColumns(
        {"time": F.lit("2023-05-01").cast(when), "timeMsc": F.lit("2023-05-01").cast(when)}
    )
    file = rows([("T1", 3)], "crm_transaction_no string, amount int")
    assert jobs.adjust_transactions(file, crm, trades, deals, "default", "x").count() == 1
    assert dict(spark.table("default.adj_transactions_x").dtypes)["amount"] == "string"
    assert spark.table("default.crm_transaction_adj_x").count() == 1


def test_name_usage_of_thousands_of_specs(spark, rows, monkeypatch):
    texts = [(i, f"select Col_{i} from Table_{i}, t\nwhere x_{i % 7} = 1" if i % 10 else None) for i in range(300)]
    texts += [(300, ""), (301, "a"), (1, texts[1][1]), (302, "table_9 " * 20_000 + "col_9")]
    specs = [(f"Table_{i}", [f"COL_{i}", "nowhere"]) for i in range(5000)] + [("t", ["x_3"]), ("Table_1", ["x_1"]), ("", ["a"]), ("t", None), (None, ["a"])]
    corpus = rows(texts, "id int, body string")
    usages = rows(specs, "table string, columns array<string>")
    want = Counter(
        (i, table)
        for i, body in texts
        if body is not None
        for table, columns in specs
        if table is not None and columns and table.lower() in body.lower() and any(c.lower() in body.lower() for c in columns)
    )
    assert Counter((r["id"], r["used"]) for r in jobs.name_usage(corpus, "body", usages).collect()) == want
    raw = Counter((i, t) for i, body in texts if body is not None for t, _ in specs if t is not None and t in body.lower())
    assert Counter((r["id"], r["used"]) for r in jobs.name_usage(corpus, "body", usages, raw=True).collect()) == raw
    monkeypatch.setattr(naming, "LIST_BYTES", 40_000)
    in_parts = jobs.name_usage(corpus, "body", usages)
    assert in_parts._jdf.queryExecution().executedPlan().toString().count("MapInArrow") > 1
    assert Counter((r["id"], r["used"]) for r in in_parts.collect()) == want

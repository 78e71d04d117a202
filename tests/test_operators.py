"""Operator semantics on small frames."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from eodledger.functions import texts, times
from eodledger.operators import dedup, joins, measures, rates, skew, unions

D = datetime


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def same(a, b):
    assert values(a, *sorted(a.columns)) == values(b, *sorted(a.columns))


def test_half_hour_buckets(rows):
    df = rows(
        [(D(2024, 1, 1, 5, 29, 59, 999999),), (D(2024, 1, 1, 5, 30),), (D(2024, 1, 1, 0, 0),), (None,)],
        "t timestamp_ntz",
    )
    found = df.select("t", times.half_hour_floor(F.col("t")).alias("b")).collect()
    assert {r["b"] for r in found} == {D(2024, 1, 1, 5), D(2024, 1, 1, 5, 30), D(2024, 1, 1), None}
    assert found[0].asDict()["b"] == times.half_hour_floor_of(found[0]["t"])
    at_most = df.where(times.bucket_at_most(F.col("t"), D(2024, 1, 1, 5, 10)))
    assert at_most.count() == 2
    assert df.where(times.bucket_is(F.col("t"), D(2024, 1, 1, 5, 30))).count() == 1


def test_bucket_tests_agree_with_the_floor(spark):
    df = spark.range(0, 3000, 7).select(
        (F.lit("2024-03-01 00:00:00").cast("timestamp_ntz") + F.col("id") * F.expr("interval '1' second") * 31).alias("t")
    )
    for cutoff in (D(2024, 3, 1, 3, 0), D(2024, 3, 1, 3, 10), D(2024, 3, 1, 3, 59, 59)):
        slow = df.where(times.half_hour_floor(F.col("t")) <= times.ntz(cutoff))
        same(df.where(times.bucket_at_most(F.col("t"), cutoff)), slow)


def test_seconds_between_counts_boundaries(rows):
    df = rows(
        [(D(2024, 1, 1, 0, 0, 0, 900000), D(2024, 1, 1, 0, 0, 1, 100000)), (D(2024, 1, 1), D(2023, 12, 31))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    found = df.select(times.seconds_between(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r["s"] for r in found] == [1, -86400]


def test_report_zone_does_not_depend_on_the_session(spark, rows):
    df = rows([(D(2024, 7, 1, 21, 30),), (D(2024, 1, 1, 22, 30),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        local = times.to_report_tz(F.col("t"), "Europe/Athens")
        assert values(df, local) == [(D(2024, 1, 2, 0, 30),), (D(2024, 7, 2, 0, 30),)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("zone", ["UTC", "Europe/Athens", "America/New_York", "Pacific/Kiritimati", "+02:00"])
def test_local_buckets_agree_with_the_floor(spark, zone):
    # two days around a clock change, a row every seven minutes and some
    df = spark.range(0, 420).select(
        (F.lit("2024-10-26 00:00:00").cast("timestamp_ntz") + F.col("id") * F.expr("interval '421' second")).alias("t")
    )
    floor = times.half_hour_floor(times.to_report_tz(F.col("t"), zone))
    for bucket in (D(2024, 10, 26), D(2024, 10, 27, 3, 30), D(2024, 10, 27)):
        same(df.where(times.local_bucket_is(F.col("t"), zone, bucket)), df.where(floor == times.ntz(bucket)))
        same(df.where(times.local_bucket_at_most(F.col("t"), zone, bucket)), df.where(floor <= times.ntz(bucket)))


def test_day_window_prunes_partitions(spark, tmp_path):
    days = spark.range(0, 90).select(
        "id", F.date_add(F.lit("2023-12-01").cast("date"), F.col("id").cast("int")).alias("d")
    )
    split = days.select("id", F.year("d").alias("year"), F.month("d").alias("month"), F.day("d").alias("day"))
    split.write.partitionBy("year", "month", "day").parquet(str(tmp_path / "t"))
    kept = spark.read.parquet(str(tmp_path / "t")).where(times.ymd_window(date(2023, 12, 31), date(2024, 1, 2)))
    assert values(kept, "id") == [(30,), (31,), (32,)]
    scan = plan_of(kept)
    # all of the window is a partition filter: nothing is left to test on rows
    assert "DataFilters: []" in scan and "PartitionFilters: [isnotnull(year" in scan
    assert not re.search(r"\bFilter \(", scan)


def test_newest_row_puts_null_time_first(rows):
    df = rows([(1, None, "a"), (1, D(2024, 1, 1), "b"), (2, D(2024, 1, 1), "c")], "k int, t timestamp_ntz, v string")
    assert values(dedup.latest_per_key(df, ["k"], "t"), "v") == [("a",), ("c",)]
    assert values(dedup.first_per_key(df, ["k"], "t"), "v") == [("b",), ("c",)]


def test_latest_row_is_a_credit(rows):
    df = rows([(1, 1, 6), (1, 2, 7), (2, 1, 6)], "k int, t int, cmd int")
    keep = F.col("cmd") != 7
    assert values(dedup.rank_then_keep(df, ["k"], "t", keep), "k") == [(2,)]
    assert values(dedup.keep_then_rank(df, ["k"], "t", keep), "k") == [(1,), (2,)]


def test_ranking_limits_rows_before_the_exchange(spark):
    plan = plan_of(dedup.latest_per_key(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], "id"))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_bucketed_snapshot_reaches_the_scan(spark, rows, tmp_path):
    rows([(1, D(2024, 1, 1)), (1, D(2024, 1, 2))], "k int, t timestamp_ntz").write.parquet(str(tmp_path / "t"))
    df = dedup.as_of_snapshot(spark.read.parquet(str(tmp_path / "t")), ["k"], "t", D(2024, 1, 1), bucketed=True)
    assert values(df, "t") == [(D(2024, 1, 1),)]
    assert "LessThan(t,2024-01-01T00:30)" in plan_of(df)


@pytest.mark.parametrize("listed", [[], [1], [1, None], [None]])
def test_not_in_like_sql(spark, rows, listed):
    probe = rows([(1,), (2,), (None,)], "p int")
    values_ = rows([(v,) for v in listed], "v int")
    probe.createOrReplaceTempView("probe_rows")
    values_.createOrReplaceTempView("listed_rows")
    expected = spark.sql("SELECT p FROM probe_rows WHERE p NOT IN (SELECT v FROM listed_rows)")
    same(joins.not_in(probe, F.col("p"), values_, F.col("v")), expected)


def test_concatenated_keys_may_collide(rows):
    probe = rows([(12, "3x"), (5, "y")], "n int, s string")
    key = F.concat(F.col("n").cast("string"), F.col("s"))
    assert values(joins.not_in(probe, key, rows([("123x",)], "k string"), F.col("k")), "n") == [(5,)]


def _like(pattern, text):
    body = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern.lower())
    return re.fullmatch(body, text.lower(), re.S) is not None


def test_like_templates(spark, rows):
    rng = random.Random(7)
    texts_ = ["", "A", "line\nbreak", "back\\slash", "Deposit 12", None] + [
        "".join(rng.choice("abC% _\\") for _ in range(rng.randint(0, 9))) for _ in range(150)
    ]
    patterns = ["", "%", "_", "__", "%_%", "%deposit%", "back\\%", None] + [
        "".join(rng.choice("abc%%_ \\") for _ in range(rng.randint(1, 6))) for _ in range(60)
    ]
    df = rows(list(enumerate(texts_)), "i int, text string")
    templates = rows([(p, j) for j, p in enumerate(patterns)], "pattern string, j int")
    expected = []
    for i, text in enumerate(texts_):
        hits = [j for j, p in enumerate(patterns) if p is not None and text is not None and _like(p, text)]
        expected += [(i, j) for j in hits] or [(i, None)]
    found = joins.like_template_join(df, "text", templates, "pattern")
    assert values(found, "i", "j") == sorted(expected, key=str)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_like_templates_on_long_and_wide_characters(rows):
    """Twenty thousand words, and characters outside the basic plane, end within seconds."""
    long = " ".join(f"w{i}" for i in range(20_000)) + " \U0001f600 tail"
    df = rows([(0, long), (1, "\U0001f600\U0001f601x"), (2, "\U0001f600")], "i int, text string")
    patterns = ["%w19999 %", "%\U0001f600 TAIL", "\U0001f600_x", "\U0001f600%", "_", "%nowhere%"]
    templates = rows([(p, j) for j, p in enumerate(patterns)], "pattern string, j int")
    found = joins.like_template_join(df, "text", templates, "pattern")
    assert values(found, "i", "j") == [(0, 0), (0, 1), (1, 2), (1, 3), (2, 3), (2, 4)]


def test_template_join_multiplies_rows(rows):
    df = rows([("gift deposit", 5.0)], "c string, a double")
    templates = rows([("%gift%",), ("%deposit%",)], "pattern string")
    assert joins.like_template_join(df, "c", templates, "pattern").agg(F.sum("a")).first()[0] == 10.0


def test_rate_pivot(rows):
    data = [(1, 6, 3.0), (1, 7, 1.0), (2, 7, 1.0), (3, 6, None)]
    df = rows(data, "id int, g int, r double")
    groups = {"fx": 6, "bul": 7, "oil": 8}
    joined = joins.rate_pivot(df, "id", "g", "r", groups)
    same(joined, joins.rate_pivot(df, "id", "g", "r", groups, unique=True))
    assert values(joined, "id", "fx", "bul", "oil") == [(1, 3.0, 1.0, None), (3, None, None, None)]
    doubled = joins.rate_pivot(df.union(df), "id", "g", "r", groups)
    assert doubled.where("id = 1").count() == 4


def test_rate_pivot_multiplies_like_joins(spark, rows):
    data = [(i, g, float(i * g + k)) for i in range(6) for g in (6, 7, 8, 9) for k in range((i * g) % 4)]
    data += [(None, 6, 1.0), (None, 6, 2.0), (None, 7, 3.0), (1, 6, None), (1, 8, None), (1, 8, None), (9, 7, 1.0)]
    rows(data, "id int, g int, r double").createOrReplaceTempView("group_rates")
    expected = spark.sql(
        "SELECT a.id, a.r AS fx, b.r AS bul, c.r AS oil FROM group_rates a LEFT JOIN group_rates b ON b.id = a.id AND b.g = 7 "
        "LEFT JOIN group_rates c ON c.id = a.id AND c.g = 8 WHERE a.g = 6"
    )
    found = joins.rate_pivot(spark.table("group_rates"), "id", "g", "r", {"fx": 6, "bul": 7, "oil": 8})
    same(found, expected)
    assert plan_of(found).count("Exchange hashpartitioning") == 1 and "Join" not in plan_of(found)


@pytest.mark.parametrize("piece_rows", [1, 20, 1 << 17])
def test_rate_pivot_pieces_multiply_like_joins(spark, rows, piece_rows):
    data = [(i, g, float(k % 3) if k else None) for i in range(6) for g in (6, 7, 8, 9) for k in range((i * g) % 8)]
    data += [(None, g, float(k)) for g in (6, 7) for k in range(5)] + [(9, 6, float(k)) for k in range(5)]
    rows(data, "id int, g int, r double").createOrReplaceTempView("cut_rates")
    expected = spark.sql(
        "SELECT a.id, a.r AS fx, b.r AS bul, c.r AS oil FROM cut_rates a LEFT JOIN cut_rates b ON b.id = a.id AND b.g = 7 "
        "LEFT JOIN cut_rates c ON c.id = a.id AND c.g = 8 WHERE a.g = 6"
    )
    found = joins.rate_pivot(spark.table("cut_rates"), "id", "g", "r", {"fx": 6, "bul": 7, "oil": 8}, piece_rows=piece_rows)
    same(found, expected)


def test_rate_pivot_never_holds_the_product_of_an_id(rows):
    data = [("hot", g, float(k)) for g in (6, 7, 8) for k in range(60)]
    found = joins.rate_pivot(rows(data, "id string, g int, r double"), "id", "g", "r", {"fx": 6, "bul": 7, "oil": 8})
    assert found.count() == 60**3
    assert found.select(F.spark_partition_id()).distinct().count() > 1
    first = found.limit(1)
    first.collect()
    made, nodes = [], [first._jdf.queryExecution().executedPlan().executedPlan()]
    while nodes:
        node = nodes.pop()
        node = node.plan() if node.nodeName() == "ResultQueryStage" else node
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Generate":
            made.append(node.metrics().apply("numOutputRows").value())
    assert made and max(made) <= 1 << 17  # what is made before the first row leaves is in memory at once


def test_or_residual_and_cast_keys(rows):
    left = rows([("10", "s1"), ("W1", None), ("10", "s2")], "login string, server string")
    right = rows([("10", "s1", 1), ("W1", "w", 2)], "external string, ta_server string, n int")
    loose = (F.col("server") == F.col("ta_server")) | F.col("login").like("W%")
    found = joins.residual_or_join(left, right, "login", "external", loose)
    assert values(found, "login", "n") == [("10", 1), ("10", None), ("W1", 2)]
    numbers = rows([(10,)], "k bigint")
    assert joins.cast_key_join(numbers, right, {"k": "external"}).first()["n"] == 1


def test_validity_ends_are_inclusive(rows):
    facts = rows([("a", date(2024, 1, d)) for d in (1, 2, 3, 4)], "s string, d date")
    periods = rows([("a", date(2024, 1, 2), date(2024, 1, 3))], "p string, f date, l date")
    found = joins.validity_join(facts, periods, "s", "d", "p", "f", "l")
    assert found.count() == 2 and found.columns == ["s", "d", "p", "f", "l"]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_validity_bins_equal_the_range_join(spark, rows, how):
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    facts = rows([("hot" if i % 3 else f"k{i % 5}", day(i % 90)) for i in range(400)] + [("hot", None), (None, day(3))], "s string, d date")
    spans = [("hot", 3, 3), ("hot", 3, 60), ("hot", 50, 40), ("k1", -9000, 900000), ("k2", 7, 8), ("k0", 80, 200), ("none", 0, 9)]
    periods = rows(
        [(k, day(a), day(b)) for k, a, b in spans] + [("k4", None, day(9)), ("k4", day(1), None), (None, day(0), day(9))], "p string, f date, l date"
    )
    on = (F.col("s") == F.col("p")) & (F.col("d") >= F.col("f")) & (F.col("d") <= F.col("l"))
    found = joins.validity_join(facts, periods, "s", "d", "p", "f", "l", how)
    same(found, facts.join(periods, on, how))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = joins.validity_join(facts, periods, "s", "d", "p", "f", "l", how, width=2)
        assert re.search(r"hashpartitioning\(s#\d+, __bin#\d+L?", plan_of(moved))
        same(moved, facts.join(periods, on, how))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_full_outer_key(rows):
    a, b = rows([(1, 5), (2, 6)], "k int, x int"), rows([(2, 7), (3, 8)], "k int, y int")
    assert values(joins.first_or_either(a, b, "k"), "k", "x", "y") == [(1, 5, None), (2, 6, 7), (3, None, 8)]


def test_measures(rows):
    df = rows([(1, 6, 1.005), (1, 6, 2.0), (1, 7, None), (2, 9, 4.0)], "k int, c int, a double")
    rules = [measures.Measure("six", F.col("c") == 6), measures.Measure("seven", F.col("c") == 7)]
    found = measures.sum_measures(df, ["k"], "a", rules, {"both": ("six", "seven")})
    assert values(found, "k", "six", "seven", "both") == [(1, 3.01, 0.0, 3.01), (2, 0.0, 0.0, 0.0)]


def test_latest_rate_equals_join_then_rank(rows):
    accounts = rows([(i, c) for i, c in enumerate(["A", "B", "C", None, "A"])], "id int, cur string")
    quotes = rows([(c, date(2024, 1, d), float(d)) for c in "AB" for d in (1, 2, 3)], "ac string, day date, rate double")
    fast = rates.latest_rate_lookup(accounts, quotes, "cur", "ac", "day")
    slow = dedup.latest_per_key(accounts.join(quotes, F.col("cur") == F.col("ac"), "left"), ["id"], "day")
    same(fast, slow)
    # the fact side stays where it is; a list that is too large moves instead
    assert "Exchange hashpartitioning" not in plan_of(fast) and "BroadcastHashJoin" in plan_of(fast)
    moved = rates.latest_rate_lookup(accounts, quotes, "cur", "ac", "day", most=10)
    same(moved, slow)
    assert "__salt" in plan_of(moved)
    only = rates.latest_rate_lookup(accounts, quotes, "cur", "ac", "day", only_if=F.col("id") < 1, most=10)
    assert values(only.where("rate is not null"), "id") == [(0,)] and only.count() == 5


def test_daily_close_is_a_hash_aggregate(spark):
    ticks = spark.range(10).select(
        F.lit("A").alias("s"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.col("id") * F.expr("interval '5' hour")).alias("t"),
        F.col("id").cast("double").alias("p"),
    )
    closes = rates.daily_close(ticks, "s", "t", "p")
    assert values(closes, "close") == [(4.0,), (9.0,)]
    assert "SortAggregate" not in plan_of(closes)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one key, a third hold none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 50)
    fact = spark.range(3000).select("id", key.cast("int").alias("k"))
    other = spark.createDataFrame([(k, f"v{k}") for k in range(5, 30)] + [(7, "again")], "k int, v string")
    return fact, other


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join(skewed, how):
    fact, other = skewed
    same(skew.salted_join(fact, other, ["k"], how, share=0.1, salts=8), fact.join(other, ["k"], how))


def test_salted_join_spreads_the_hot_key(spark, skewed):
    fact, other = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(fact, other, ["k"], "inner", share=0.1, salts=64)
        tasks = joined.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasks > 4


def test_hot_keys_are_bounded(skewed):
    assert values(skew.hot_keys(skewed[0], ["k"], 0.1).where("k is not null"), "k") == [(7,)]


def test_salted_join_refuses_to_preserve_the_other_side(skewed):
    with pytest.raises(ValueError):
        skew.salted_join(*skewed, ["k"], "full")


def test_left_joins_with_null_and_hot_keys(skewed):
    fact, other = skewed
    right = other.withColumnRenamed("k", "rk")
    plain = fact.join(right, F.col("k") == F.col("rk"), "left")
    same(skew.left_join_spread_nulls(fact, right, "k", "rk", "id"), plain)
    facts = fact.withColumnRenamed("k", "fk")
    same(
        skew.left_join_hot_right(other, facts, "k", "fk"),
        other.join(facts, F.col("k") == F.col("fk"), "left"),
    )


def test_semi_join_never_multiplies(rows):
    df = rows([(1, 1), (1, 2), (2, 1)], "a int, b int")
    assert values(joins.semi_on(df, df.union(df).where("a = 1"), ["a", "b"]), "a", "b") == [(1, 1), (1, 2)]


def test_unions(rows):
    a = rows([(1,)], "x int")
    assert values(unions.union_shards({"s1": a, "s2": a}, "server"), "x", "server") == [(1, "s1"), (1, "s2")]
    scoped = rows([("n", 1)], "scope string, x int")
    assert values(unions.union_populations(scoped, a, "scope"), "scope", "x") == [("n", 1), (None, 1)]


def test_text_predicates(rows):
    df = rows([("Test",), ("fine",), (None,)], "c string")
    assert values(df.where(texts.none_like(F.col("c"), ("%test%",))), "c") == [("Test",), ("fine",)]
    assert values(df.where(texts.none_like(F.lower("c"), ("%test%",))), "c") == [("fine",)]
    assert df.where(texts.none_like_or_null(F.lower("c"), ("%test%",))).count() == 2
    segments = rows([("a\\b\\system",), ("plain",), ("",)], "p string")
    assert values(segments, texts.last_segment(F.col("p"), "\\")) == [("",), ("plain",), ("system",)]
    parts = rows([("xtm12tm3",), ("none",)], "n string")
    assert values(parts, texts.part_after(F.col("n"), "tm")) == [("12",), (None,)]


def test_every_country_name(rows):
    given = list(texts.COUNTRY_NAMES) + ["New 1 Land", "123", "", None]
    found = rows([(g,) for g in given], "c string").select(texts.canonical_name(F.col("c")).alias("n")).collect()
    expected = list(texts.COUNTRY_NAMES.values()) + ["NEW  LAND", texts.UNKNOWN_COUNTRY, texts.UNKNOWN_COUNTRY, None]
    assert [r["n"] for r in found] == expected

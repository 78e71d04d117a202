"""Reading and writing."""

import os
import random
from urllib.parse import unquote

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eodledger.plans.jobs import Usage, name_usage, usage_frame
from eodledger.session import scratch_path, shared_folder
from eodledger.sources import null_marker, operational, shards, tables
from eodledger.sources.corpus import scan_corpus


def test_csv_all_strings(spark, tmp_path):
    path = tmp_path / "group_mapping.v2.csv"
    path.write_text('id,name,note\n007,"a, ""b""",\n8,\\N,x\n')
    found = [tuple(r) for r in tables.load_csv_strings(spark, str(path)).collect()]
    assert found == [("007", 'a, "b"', ""), ("8", None, "x")]
    assert tables.table_name_of(str(path)) == "group_mapping"


def test_upload_names_the_table_after_the_file(spark, tmp_path):
    path = tmp_path / "group_mapping.csv"
    path.write_text("id,name\n1,a\n2,\n")
    shown = tables.upload_csv(spark, str(path), "default")
    assert shown.count() == 2
    assert spark.table("group_mapping").dtypes == [("id", "string"), ("name", "string")]
    path.write_text("other\nx\n")
    tables.upload_csv(spark, str(path), "default")
    assert spark.table("group_mapping").columns == ["other"]


def test_csv_typed(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("w,x,y,z\n1,2,,3.1234567\n4,5,c,\\N\n")
    df = tables.load_csv_typed(spark, str(path))
    assert df.dtypes[3] == ("fund_amount", "decimal(38,6)")
    found = [tuple(r) for r in df.collect()]
    assert found[0][:3] == (1, 2, "") and str(found[0][3]) == "3.123457" and found[1][3] is None


@pytest.mark.parametrize("line", ["x,2,c,1", ",2,c,1"])
def test_bad_value_fails_the_load(spark, tmp_path, line):
    path = tmp_path / "bad.csv"
    path.write_text(f"w,x,y,z\n{line}\n")
    with pytest.raises(PySparkException):
        tables.load_csv_typed(spark, str(path)).collect()


def test_null_marker_roundtrip(spark, tmp_path):
    given = [(None, ""), ("", None), ('q"uote', "com,ma"), ("\\N x", " pad ")]
    df = spark.createDataFrame(given, "a string, b string")
    null_marker.write_csv(df, str(tmp_path / "c"))
    back = null_marker.read_csv(spark, str(tmp_path / "c"))
    assert sorted(map(str, (tuple(r) for r in back.collect()))) == sorted(map(str, given))


def test_line_breaks_inside_quotes(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", "c")], "a string, b string")
    null_marker.write_csv(df, str(tmp_path / "c"))
    back = null_marker.read_csv(spark, str(tmp_path / "c"))
    assert [tuple(r) for r in back.collect()] == [("a\nb", "c")]
    assert tables.load_csv_strings(spark, str(tmp_path / "c")).count() == 1
    with pytest.raises(Exception, match="MALFORMED"):
        null_marker.read_csv(spark, str(tmp_path / "c"), multi_line=False).collect()


def test_one_column_with_empty_strings_and_breaks(spark, tmp_path):
    given = ["x", "", None, "y", "line1\nline2", "a\rb", "c\r\nd", ' "q" ', "\\"]
    df = spark.createDataFrame([(v,) for v in given], "a string")
    null_marker.write_csv(df, str(tmp_path / "c"))
    back = [r["a"] for r in null_marker.read_csv(spark, str(tmp_path / "c")).collect()]
    assert sorted(map(repr, back)) == sorted(map(repr, given))


@pytest.mark.parametrize("size", [48, 300, 1 << 20])
def test_a_csv_file_is_split_anywhere(spark, tmp_path, size):
    rng = random.Random(6)
    fields = ["", "a", 'q"x', '5" pipe', "two\nlines", "\n\n", 'end"\n"', "c,d", "\r\n", " pad ", "ünï\n" * 30, "\\N", '"', "x\r"]
    rows = [[rng.choice(fields) for _ in range(3)] for _ in range(400)]
    def written(value):
        if value in ("a", "c", " pad ", "\\N", '5" pipe') or value == "" and rng.random() < 0.5:
            return value
        return '"' + value.replace('"', '""') + '"'
    head, body = '"first\nname",b,c', [",".join(map(written, r)) for r in rows]
    (tmp_path / "a.csv").write_text("\n".join([head, *body[:250], ""]))
    (tmp_path / "b.csv").write_text("\n\n" + "\n".join([head, "", *body[250:]]))
    (tmp_path / "dos").mkdir()
    (tmp_path / "dos" / "c.csv").write_bytes("\r\n".join([head, *body, ""]).encode())
    whole = spark.read.options(header=True, multiLine=True, escape='"', quote='"', mode="FAILFAST").csv(str(tmp_path))
    want = sorted(str(tuple(r)) for r in whole.select([null_marker.decode(F.col(f"`{c}`")) for c in whole.columns]).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        found = null_marker.read_csv(spark, str(tmp_path))
        assert found.columns == ["first\nname", "b", "c"]
        assert sorted(str(tuple(r)) for r in found.collect()) == want
        dos = null_marker.read_csv(spark, str(tmp_path / "dos"))
        assert sorted(str(tuple(r)) for r in dos.collect()) == sorted(str(tuple(None if v == "\\N" else v for v in r)) for r in rows)
        if size == 300:
            assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_append_by_day_can_run_again(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([(1, "2024", "07", "16"), (2, "2024", "07", "17")], "v int, year string, month string, day string")
    for part in (df, df.where("v = 1"), df.where("v = 1").withColumn("v", F.lit(9))):
        tables.append_path(part, path, ["v", "year", "month", "day"], tables.DAY_SPLIT)
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [2, 9]


def test_append_is_positional(spark):
    spark.sql("CREATE TABLE positional (a INT, b INT) USING parquet")
    tables.append_by_position(spark.createDataFrame([(1, 2)], "b int, a int"), "positional", ["b", "a"])
    assert tuple(spark.table("positional").first()) == (1, 2)


def test_refresh_replaces_rows_and_columns(spark):
    tables.full_refresh(spark.range(3), "refreshed")
    tables.full_refresh(spark.range(1).selectExpr("id AS other"), "refreshed")
    assert spark.table("refreshed").columns == ["other"] and spark.table("refreshed").count() == 1
    assert tables.preview(spark.range(30)).count() == 10


def test_named_tables_and_parameters(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lnd")
    tables.full_refresh(spark.range(5), "lnd.numbers")
    house = tables.Warehouse(landing="lnd", reporting="default")
    numbers = house.landing_table(spark, "numbers")
    found = tables.query(spark, "SELECT id FROM numbers WHERE id > :least", {"numbers": numbers}, least=2)
    assert sorted(r["id"] for r in found.collect()) == [3, 4]


def test_string_schema(spark):
    assert tables.string_schema(["a", "b"]).simpleString() == "struct<a:string,b:string>"
    assert tables.as_strings(spark.range(1)).dtypes == [("id", "string")]


def test_corpus(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "deep" / "er" / "q.sql").write_text("SELECT Usd_Pnl FROM Closed_Trades")
    (tmp_path / "image.png").write_bytes(b"\x89PNG\xff\xfe")
    (tmp_path / "README").write_text("closed_trades usd_pnl")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "other.txt").write_text("closed_trades only, ünï")
    (tmp_path / "__init__.py").write_text("a")
    (tmp_path / ".hidden.sql").write_text("b c")
    (tmp_path / "_private").mkdir()
    (tmp_path / "_private" / "x y.txt").write_text("d")
    (tmp_path / "_bad.bin").write_bytes(b"\xff\xfe")
    corpus = scan_corpus(spark, str(tmp_path))
    names = sorted(unquote(os.path.basename(r["path"])) for r in corpus.collect())
    assert names == [".hidden.sql", "__init__.py", "empty.txt", "other.txt", "q.sql", "x y.txt"]
    assert {r["text"] for r in corpus.collect()} >= {"", "a", "b c", "d"}
    usage = Usage("Closed_Trades", ("USD_PNL", "missing"))
    found = name_usage(corpus, "text", usage_frame(spark, [usage])).collect()
    assert [os.path.basename(r["path"]) for r in found] == ["q.sql"]
    assert name_usage(corpus, "text", usage_frame(spark, [usage]), raw=True).count() == 0
    assert name_usage(corpus, "text", usage_frame(spark, [Usage("closed_trades")]), raw=True).count() == 2
    assert name_usage(corpus, "text", usage_frame(spark, [Usage("closed_trades")])).count() == 0


def test_corpus_has_the_files_of_the_tree_each_once(spark, tmp_path, monkeypatch):
    from eodledger.sources import corpus

    names = ["_k=v.sql", "sub/_y=1.sql", "b.sql._COPYING_", ".x", ".dir/y.z", "_a/b.c", "_p=1/q.sql", "a b/ü%20 #?.txt", "x.", "dir.d/in.txt", "e/m/p/t/y.txt"]
    for i, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("" if "empty" in name or name == ".x" else f"{i} text")
    (tmp_path / "no_dot").write_text("z")
    (tmp_path / "many").mkdir()
    for i in range(40):
        (tmp_path / "many" / f"{i}" / "deep").mkdir(parents=True)
        (tmp_path / "many" / f"{i}" / "deep" / "f.sql").write_text(f"many {i}")
    want = sorted(str(p) for p in tmp_path.rglob("*.*") if p.is_file())
    for folders in (64, 5, 1):
        monkeypatch.setattr(corpus, "FOLDERS", folders)
        assert sorted(r["path"] for r in scan_corpus(spark, str(tmp_path)).collect()) == want
    by_address = scan_corpus(spark, tmp_path.as_uri() + "/").collect()
    assert sorted(r["path"].removeprefix("file://") for r in by_address) == want
    assert sorted(r["text"] for r in by_address) == sorted(open(p).read() for p in want)
    assert scan_corpus(spark, f"file:{tmp_path}").count() == len(want)


def test_shards(spark, tmp_path):
    assert shards.shard_table("srv", 2024) == "srv.mt5_deals_2024"
    names = []

    def read(name):
        names.append(name)
        return spark.createDataFrame([(len(names),)], "deal int")

    df = shards.read_shards(read, [("s1", 2023), ("s2", 2024)])
    assert names == ["s1.mt5_deals_2023", "s2.mt5_deals_2024"]
    assert sorted(map(tuple, df.collect())) == [(1, "s1", 2023), (2, "s2", 2024)]
    more = df.union(spark.createDataFrame([(3, None, 2024)], "deal int, server string, year int"))
    more.write.partitionBy("server", "year").parquet(str(tmp_path / "tree"))
    tree = shards.read_shard_tree(spark, str(tmp_path / "tree"))
    assert sorted(r["deal"] for r in tree.collect()) == [1, 2]


def test_operational_options():
    plain = operational.jdbc_options("jdbc:x", "SELECT 1")
    assert plain["query"] == "SELECT 1" and plain["queryTimeout"] == "780"
    split = operational.jdbc_options("jdbc:x", "SELECT id FROM t", operational.Split("id", 0, 100, 8))
    assert split["dbtable"] == "(SELECT id FROM t) source" and split["numPartitions"] == "8"
    assert "query" not in split


def test_scratch_paths_lie_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_folder(spark))

"""Compare registered queries with their checking SQL, value by value."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb
import pandas as pd


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (int, float)):
        if math.isnan(value):
            return None
        rounded = float(f"{float(value):.10g}")
        return "-0.0" if str(rounded) == "-0.0" else rounded
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return datetime.datetime.combine(value, datetime.time()).isoformat()
    if hasattr(value, "tolist"):
        return str(value.tolist())
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def spark_rows(df):
    return normal_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, text):
    cur = con.execute(text)
    columns = [d[0] for d in cur.description]
    return normal_rows(columns, cur.fetchall())


def difference(ours, theirs) -> str | None:
    (ca, ra), (cb, rb) = ours, theirs
    if ca != cb:
        return f"columns {sorted(set(ca) ^ set(cb))}"
    if len(ra) != len(rb):
        return f"rows {len(ra)} against {len(rb)}"
    for x, y in zip(ra, rb):
        if x != y:
            return "values " + str([(c, p, q) for c, p, q in zip(ca, x, y) if p != q][:6])
    return None


def main(folder: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    from eodledger.catalog import load_all
    from eodledger.catalog.registry import CHECKS, QUERIES
    from eodledger.session import with_startup_settings

    load_all()
    spark = (
        with_startup_settings(SparkSession.builder)
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            ours = spark_rows(QUERIES[name](spark, folder))
            took = time.time() - start
            if name not in CHECKS:
                print(f"{name}: rows only {len(ours[1])} {took:.2f}s", flush=True)
                continue
            problem = difference(ours, sql_rows(con, CHECKS[name]))
        except Exception as error:  # report every query, then fail
            problem, took = f"{type(error).__name__}: {str(error)[:1500]}", time.time() - start
        bad += problem is not None
        print(f"{name}: {problem or 'same'} {len(ours[1]) if not problem else ''} {took:.2f}s", flush=True)
    print("different:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))

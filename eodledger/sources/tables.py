"""Tables: naming, loading files into them, refreshing, appending, previewing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from posixpath import basename

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eodledger.sources.null_marker import read_csv

# Columns of a transaction adjustment file.
ADJUSTMENT_FILE = (
    "trading_server_transaction_no bigint, trading_server_login bigint, "
    "comment string, fund_amount decimal(38,6)"
)

# The columns a date is split into.
DAY_SPLIT = ("year", "month", "day")


@dataclass(frozen=True)
class Warehouse:
    """Names of one tenant's landing and reporting schemas."""

    landing: str
    reporting: str
    catalog: str | None = None

    def _name(self, schema: str, table: str) -> str:
        return ".".join(p for p in (self.catalog, schema, table) if p)

    def reporting_name(self, table: str) -> str:
        return self._name(self.reporting, table)

    def landing_table(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(self._name(self.landing, table))

    def reporting_table(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.table(self.reporting_name(table))


def table_name_of(path: str) -> str:
    """File name up to its first dot."""
    return basename(path).split(".")[0]


def as_strings(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def load_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Every column a string, named by the header; empty fields stay empty strings."""
    return read_csv(spark, path)


def load_csv_typed(spark: SparkSession, path: str, ddl: str = ADJUSTMENT_FILE) -> DataFrame:
    """Columns by position with given types; a value that does not convert fails the load."""
    schema = T.StructType.fromDDL(ddl)
    raw = read_csv(spark, path, schema.names)
    return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def upload_csv(spark: SparkSession, path: str, schema: str, ddl: str | None = None, table: str | None = None) -> DataFrame:
    """Load a CSV file into a table named after it and return a preview."""
    df = load_csv_strings(spark, path) if ddl is None else load_csv_typed(spark, path, ddl)
    name = f"{schema}.{table or table_name_of(path)}"
    full_refresh(df, name)
    return preview(spark.table(name))


def full_refresh(df: DataFrame, table: str) -> None:
    """Replace a table's rows and columns."""
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(table)


def full_refresh_path(df: DataFrame, path: str, days: Sequence[str] = ()) -> None:
    """Replace the rows below a path, split by the given columns."""
    writer = _balanced(df, days).write.mode("overwrite")
    (writer.partitionBy(*days) if days else writer).parquet(path)


def _balanced(df: DataFrame, days: Sequence[str]) -> DataFrame:
    """Files of even size: a large day is divided, small ones are not scattered."""
    return df.hint("rebalance", *days) if days else df


def append_by_position(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Append the named columns to a table, matched by position."""
    df.select(*columns).write.insertInto(table, overwrite=False)


def replace_days_by_position(df: DataFrame, table: str, columns: Sequence[str], days: Sequence[str]) -> None:
    """Insert the named columns by position into a table partitioned by ``days``, its last columns.

    The days that ``df`` holds are replaced and all others stay, so the same day can run again.
    """
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        _balanced(df.select(*[c for c in columns if c not in days], *days), days).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def append_path(df: DataFrame, path: str, columns: Sequence[str], days: Sequence[str]) -> None:
    """Write the day partitions of ``df``; running the same day again replaces it."""
    (
        _balanced(df.select(*columns), days)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*days)
        .parquet(path)
    )


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)


def query(spark: SparkSession, text: str, frames: dict[str, DataFrame], **parameters) -> DataFrame:
    """SQL over named frames with typed parameters; no text substitution of values."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=parameters)

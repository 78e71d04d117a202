r"""CSV interchange where ``\N`` is NULL and an empty field is an empty string."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eodledger.sources.quoted_csv import records

NULL_MARKER = "\\N"


def decode(field: Column) -> Column:
    """The reader gives NULL for an empty field, so NULL means empty here."""
    return F.when(field == NULL_MARKER, None).otherwise(F.coalesce(field, F.lit("")))


def encode(field: Column) -> Column:
    return F.coalesce(field.cast("string"), F.lit(NULL_MARKER))


def write_csv(df: DataFrame, path: str) -> None:
    text = df.select([encode(F.col(c)).alias(c) for c in df.columns])
    text.write.mode("overwrite").options(
        header=True,
        escape='"',
        quote='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


def read_csv(
    spark: SparkSession, path: str, names: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """All columns as strings.

    With ``names`` the header line is not consulted for the schema, which saves the
    driver a read of the first file. Line breaks inside quotes are part of a field; a
    large file is still read by many tasks. ``multi_line=False`` reads files where no
    field has a line break, without putting lines in order; one that has fails the load.
    """
    reader = spark.read.options(header=True, inferSchema=False, multiLine=multi_line, escape='"', quote='"', mode="FAILFAST")
    if names is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    raw = reader.csv(path)
    if multi_line:
        fields = F.from_csv("record", F.lit(raw.schema.toDDL()), {"escape": '"', "quote": '"', "mode": "FAILFAST"})
        raw = records(spark, path).filter(~F.col("header")).select(fields.alias("fields")).select("fields.*")
    return raw.select([decode(F.col(f"`{c}`")).alias(c) for c in raw.columns])

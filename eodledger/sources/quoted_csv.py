r"""CSV records of files of any size, with line breaks inside quoted fields.

Spark splits a file by lines, and whether a line break ends a record depends on all that stands before
it. What a line does to that is one of four: from inside or outside of quotes it leads inside or
outside. Lines that lead to the same side from both forget what was before; the others keep the side or
change it. So the side at the start of a line is that of the last line that forgets, changed once for
every change since: a running count within a block of a file. It is counted for a block that starts
outside and for one that starts inside; which of them holds follows from the few blocks before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eodledger.session import stored

# What a quoted field holds, a field, and fields up to the last comma. None of them steps back.
_HELD = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_HELD}"[^,]*+|[^",][^,]*+)?,)*+'
#: A line that starts outside of quotes, or inside, and ends inside.
OPENS = rf'^{_FIELDS}"{_HELD}\z'
STAYS = rf'^{_HELD}(?:\z|"[^,]*+,{_FIELDS}"{_HELD}\z)'


def _ended(found: DataFrame) -> DataFrame:
    """Records without the rest of their line end; empty ones are none."""
    cut = F.expr("IF(endswith(record, '\\r'), left(record, length(record) - 1), record)")
    return found.filter(~F.col("record").isin("", "\r")).withColumn("record", cut)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file, at, header, record`` of every record below ``path``; ``header`` marks the first of a file.

    Lines are read by many tasks. Where none of them ends inside of quotes each is a record, and stays
    where it is. Else the lines of a block are put in order and stored, and records of several lines
    are gathered. A quote inside a field that did not start with one is a character like
    any other. Empty lines outside of quotes are no records.
    """
    quoted = F.contains("value", F.lit('"'))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        (quoted & F.rlike("value", F.lit(OPENS))).cast("int").alias("opens"),
        (~quoted | F.rlike("value", F.lit(STAYS))).cast("int").alias("stays"),
    )
    filled = ~F.col("line").isin("", "\r")
    files = stored(
        lines.groupBy("file").agg(F.min(F.when(filled, F.struct("block", "at"))).alias("head"), F.max("opens").alias("opens")), "files"
    )
    heads = files.select("file", "head.at").withColumnRenamed("at", "head")
    header = F.col("at").eqNullSafe(F.col("head")).alias("header")
    if not files.filter("opens = 1").count():
        return _ended(lines.join(heads, "file", "left").select("file", "at", header, F.col("line").alias("record")))
    here = Window.partitionBy("file", "block").orderBy("at")
    before, to_here = here.rowsBetween(Window.unboundedPreceding, -1), here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    change = F.when((F.col("opens") == 1) & (F.col("stays") == 0), 1).otherwise(0)
    counted = lines.withColumn("changes", F.sum(change).over(to_here)).withColumn(
        "settles", F.when(F.col("opens") == F.col("stays"), F.struct(F.col("opens").alias("inside"), "changes"))
    )
    counted = counted.withColumns(
        {"settled": F.last("settles", ignorenulls=True).over(before), "changed": F.col("changes") - change}
    )
    settled = F.col("settled")

    def side(start: int) -> Column:
        since = F.when(settled.isNull(), F.col("changed")).otherwise(F.col("changed") - settled["changes"])
        return ((F.coalesce(settled["inside"], F.lit(start)) + since) % 2).cast("int")

    both = counted.withColumns({f"in{k}": side(k) for k in (0, 1)})
    both = both.withColumns({f"end{k}": F.when(F.col(f"in{k}") == 1, F.col("stays")).otherwise(F.col("opens")) for k in (0, 1)})
    both = both.withColumns({f"first{k}": F.last(F.when(F.col(f"in{k}") == 0, F.col("at")), ignorenulls=True).over(to_here) for k in (0, 1)})
    kept = ("file", "block", "at", "in0", "in1", "end0", "end1", "first0", "first1", "line")
    rows = stored(both.select(*kept), "lines")

    # What a block does as a whole, and from that the side on which each block starts.
    along = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(
        *[F.max_by(f"end{k}", "at").alias(f"end{k}") for k in (0, 1)], *[F.max(f"first{k}").alias(f"first{k}") for k in (0, 1)]
    )
    led = F.aggregate(
        F.collect_list(F.struct("end0", "end1")).over(along), F.lit(0), lambda at, done: F.when(at == 0, done["end0"]).otherwise(done["end1"])
    )
    chosen = lambda name: F.when(F.col("start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    starts = blocks.withColumn("start", led).withColumn("open", F.last(chosen("first"), ignorenulls=True).over(along))
    sided = rows.join(starts.select("file", "block", "start", "open").join(heads, "file"), ["file", "block"], "left").select(
        "file",
        "block",
        "at",
        "line",
        chosen("in").alias("inside"),
        chosen("end").alias("ends_inside"),
        # Lines ahead of a block's first start belong to the record that an earlier block left open.
        F.coalesce(chosen("first"), "open").alias("first"),
        header,
    )
    alone = sided.filter("inside = 0 AND ends_inside = 0").select("file", "at", "header", F.col("line").alias("record"))
    joined = (
        sided.filter("inside = 1 OR ends_inside = 1")
        .groupBy("file", F.col("first").alias("at"))
        .agg(F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("parts"), F.bool_or("header").alias("header"))
        .select("file", "at", "header", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("record"))
    )
    return _ended(alone.unionByName(joined))

"""Bounded samples of labelled documents, and the split that keeps the rest for testing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(key: str | Column, parts: int, part: int) -> Column:
    """Whether the key's CRC-32, of its decimal text, leaves this remainder. A null key: not."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts == part, F.lit(False))


def sample(
    df: DataFrame, labels: DataFrame, label: str, split: tuple[int, int], most: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, text, y`` of at most ``most`` labelled documents that are not held out.

    They are chosen by a hash of the key; the chosen keys, bounded by ``most``, are broadcast to the
    documents. Labels that are null or of a null key are passed over, repeated ones count once. Of
    documents that repeat a key the smallest text counts, so no more than ``most`` rows are returned.
    """
    chosen = (
        labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key, *split))
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(label).cast("double").alias("y"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(most)
    )
    found = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "key")
    return found.groupBy("key").agg(F.min("text").alias("text"), F.max("y").alias("y"))

"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

ARROW = {
    LongType(): pa.int64(),
    IntegerType(): pa.int32(),
    DoubleType(): pa.float64(),
    StringType(): pa.string(),
    BooleanType(): pa.bool_(),
    BinaryType(): pa.binary(),
    ArrayType(LongType()): pa.list_(pa.int64()),
}

#: Bytes of text that are handled together; a batch of long texts is cut into such pieces.
PIECE = 16 << 20

#: What the contracts call white space: every other character is part of a word.
BLANKS = " \t\n\x0b\x0c\r"

Work = Callable[[list], dict]


def pieces(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch, each with about ``PIECE`` bytes in the given column."""
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + (n or 0) > PIECE:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def per_text(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    fields: dict[str, DataType],
    work: Callable[[], Work],
) -> DataFrame:
    """Add columns computed from whole texts, batch by batch in Python.

    ``work`` is called once per task and gives a function from a list of texts (None for null) to
    the new columns. Only the ``keep`` columns pass through; other columns of ``df``, whatever
    their names, are not read. No row is dropped and no row moves to another task.
    """
    own = text in keep and isinstance(df.schema[text].dataType, StringType)
    source = df.select(*[df[c] for c in keep], *([] if own else [df[text].cast("string").alias("__text")]))
    schema = StructType(
        [source.schema[c] for c in keep] + [StructField(n, t) for n, t in fields.items()]
    )
    n, types = len(keep), {name: ARROW[kind] for name, kind in fields.items()}
    at = list(keep).index(text) if own else n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = work()
        for whole in batches:
            for batch in pieces(whole, at):
                got = function(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    batch.columns[:n] + [pa.array(got[k], t) for k, t in types.items()],
                    names=[*keep, *types],
                )

    return source.mapInArrow(run, schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def identity(text: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes, which stand for a text (or null) where the text itself need not move."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)

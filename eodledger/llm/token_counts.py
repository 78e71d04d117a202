"""Token counts of documents in flat token files that have no index.

A file is a sequence of ids of two bytes, high byte first; each document ends with a separator id.
Files are cut into blocks of equal length wherever that falls. In a block all separators are found
with one comparison; a prefix sum of their number over a file's blocks gives every piece between
separators the number of its document, and pieces of one document, in however many blocks, are added.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eodledger.llm.bpe import Encoder
from eodledger.llm.common import pieces
from eodledger.session import scratch_path, stored

#: Ends a document: an id above the vocabularies.
SEPARATOR = 50304
#: The id that the writer puts at the end of a file: it belongs to no document and is not counted. Its
#: two bytes are those of the character in UTF-8, so that Spark's text writer can put it there.
FILLER, MARK = 50305, "ā"
#: Ids before the text's own that hold its key, as digits in this base, the highest first.
KEY_IDS, BASE, NO_KEY = 5, 50000, 9
#: Bytes in a block.
BLOCK = 1 << 20
#: Bytes from which on a file is closed behind its last document.
FILE = 16 << 20
#: Bytes that a Python worker remembers words in, and what an entry takes besides its word and its ids.
REMEMBERED, ENTRY = 24 << 20, 200
#: Fragments it remembers.
FRAGMENTS = 20_000


def key_ids(key: int | None) -> bytes:
    """The ids that hold a key; none is the separator."""
    if key is None:
        digits = [NO_KEY] + [0] * (KEY_IDS - 1)
    else:
        rest = key + (1 << 63)
        digits = [rest // BASE**k % BASE for k in range(KEY_IDS - 1, -1, -1)]
    return b"".join([d.to_bytes(2, "big") for d in digits])


def key_of(ids: Column) -> Column:
    """The key that an array of ``KEY_IDS`` ids holds."""
    whole = lambda n: F.lit(str(n)).cast("decimal(38,0)")
    n = sum((F.get(ids, k).cast("decimal(10,0)") * whole(BASE ** (KEY_IDS - 1 - k)) for k in range(KEY_IDS)), whole(0))
    return F.when(F.get(ids, 0) != NO_KEY, (n - whole(1 << 63)).cast("long"))


class _Ids(dict):
    """The ids of words as bytes; all are forgotten when they take too much memory."""

    def __init__(self, path: str):
        super().__init__()
        self.encoder, self.size = Encoder(path, FRAGMENTS), 0
        self.special = {token: i.to_bytes(2, "big") for token, i in self.encoder.v.special.items()}

    def __missing__(self, word: str) -> bytes:
        found = self.special.get(word) or b"".join([i.to_bytes(2, "big") for i in self.encoder.ids_of(word)])
        if len(word) < 100:
            self.size += 4 * len(word) + len(found) + ENTRY
            if self.size > REMEMBERED:
                self.clear()
                self.size = 0
            self[word] = found
        return found

    def of(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.encoder.words(text)))


@lru_cache(maxsize=1)
def _ids(path: str) -> _Ids:
    """One for each Python worker, which Spark uses for many tasks."""
    return _Ids(path)


def write_tokens(df: DataFrame, folder: str, vocabulary: str, key: str = "doc_id", text: str = "text", least: int = FILE) -> None:
    """Write each row's key, the ids of its whole text and a separator into flat files.

    A null text counts as empty. Rows are not moved between tasks. A file takes whole documents until
    it has ``least`` bytes, so it is no longer than that and one document; a filler ends it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, end, held = _ids(vocabulary), SEPARATOR.to_bytes(2, "big"), bytearray()
        made = lambda: pa.RecordBatch.from_arrays([pa.array([bytes(held)], pa.binary())], names=["ids"])
        for whole in batches:
            for batch in pieces(whole, 1):
                for own, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                    held += key_ids(own) + ids.of(content.as_py() or "") + end
                    if len(held) >= least:
                        yield made()
                        held.clear()
        if held:
            yield made()

    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, "ids binary")
    rows.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", MARK).option("maxRecordsPerFile", 1).text(folder)


def blocks(spark: SparkSession, folder: str, size: int = BLOCK) -> DataFrame:
    """``file, block, bytes`` of all files in a folder; the last block of a file may be shorter.

    Spark reads a file whole, so files should be bounded, as those of ``write_tokens`` are.
    """
    files = spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), "content")
    last = F.greatest(F.expr(f"cast((length(content) - 1) div {size} as int)"), F.lit(0))
    return files.select("file", "content", F.explode(F.sequence(F.lit(0), last)).alias("block")).select(
        "file", "block", F.expr(f"substring(content, block * {size} + 1, {size})").alias("bytes")
    )


def _pieces(separator: int, heads: int, filler: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(2)[i].as_buffer(), ">u2")
                ids = ids[ids != filler]
                ends = np.nonzero(ids == separator)[0]
                starts = np.concatenate(([0], ends + 1))
                sizes = np.concatenate((ends, [len(ids)])) - starts
                head = np.minimum(sizes, heads)
                at = np.repeat(starts - np.concatenate(([0], np.cumsum(head)[:-1])), head) + np.arange(head.sum())
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(batch.column(0)[i], n),
                        pa.repeat(batch.column(1)[i], n),
                        pa.array(np.arange(n)),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(np.arange(n) < len(ends)),
                        pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(head))).astype(np.int32)), pa.array(ids[at].astype(np.int32))),
                    ],
                    names=["file", "block", "piece", "n", "ended", "head"],
                )

    return run


def count(cut: DataFrame, separator: int = SEPARATOR, heads: int = KEY_IDS, filler: int = FILLER) -> DataFrame:
    """``file, number, n, head`` of every document in ``cut (file, block, bytes)``.

    ``n`` is the number of its ids, ``head`` the first ``heads`` of them. Blocks hold an even number
    of bytes. A document without ids counts if a separator ends it; ids behind the last separator of
    a file are a document too. Fillers count nowhere. Nothing is gathered by file but one number for
    each block.
    """
    found = stored(
        cut.mapInArrow(_pieces(separator, heads, filler), "file string, block int, piece long, n long, ended boolean, head array<int>"), "pieces"
    )
    seps = found.groupBy("file", "block").agg(F.count_if("ended").alias("seps"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = seps.select("file", "block", F.coalesce(F.sum("seps").over(before), F.lit(0)).alias("before"))
    return (
        found.join(scan, ["file", "block"])
        .groupBy("file", (F.col("before") + F.col("piece")).alias("number"))
        .agg(
            F.sum("n").alias("n"),
            F.bool_or("ended").alias("ended"),
            F.slice(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block", "head"))), lambda s: s["head"])), 1, heads).alias("head"),
        )
        .filter("ended or n > 0")
        .select("file", "number", "n", "head")
    )


def token_counts(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The key and ``n_tokens`` of every row of ``df``, counted in flat files of its texts' ids.

    A null text counts as empty and has no tokens; a null key stays null; repeated rows repeat; an
    empty table gives no rows; other columns are not read.
    """
    spark = df.sparkSession
    folder = scratch_path(spark, "tokens")
    write_tokens(df, folder, vocabulary, key, text)
    found = count(blocks(spark, folder, block))
    return found.select(key_of(F.col("head")).alias(key), (F.col("n") - KEY_IDS).alias("n_tokens"))

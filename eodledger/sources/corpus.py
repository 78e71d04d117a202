"""A folder tree of text files as a frame of (path, text).

Spark's own file sources leave out empty files and names by rules of their own. Here the tree is a
source whose partitions are folders: executors list them, without a rule for any name, and the files
found are dealt over tasks that read them.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

# Names that Hadoop gives to stores which pyarrow knows under another.
STORES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss", "viewfs": "hdfs"}
#: Folders from which on no further folder is listed while the scan is planned, and the most partitions they are dealt to.
FOLDERS = 64


def open_store(root: str) -> tuple[FileSystem, str]:
    """The file system of a path or address, and the place in it."""
    parts = urlsplit(root)
    if parts.scheme in ("", "file"):
        return FileSystem.from_uri("file://" + quote(unquote(parts.path) if parts.scheme else root))
    return FileSystem.from_uri(root.replace(parts.scheme, STORES.get(parts.scheme, parts.scheme), 1))


class Folders(InputPartition):
    """Some folders, each with whether what lies below its own folders belongs to it."""


class _Listing(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list[Folders]:
        """Folders are opened level by level until there are enough of them; each of the last holds all below it."""
        store, top = open_store(self.root)
        opened, level = [], [top.rstrip("/") or "/"]
        while level and len(opened) + len(level) < FOLDERS:
            opened += level
            level = [i.path for f in level for i in store.get_file_info(FileSelector(f)) if i.type == FileType.Directory]
        found = [(f, False) for f in opened] + [(f, True) for f in level]
        return [Folders(found[k::FOLDERS]) for k in range(min(FOLDERS, len(found)))]

    def read(self, partition: Folders) -> Iterator[tuple[str, str]]:
        store, top = open_store(self.root)
        base = top.rstrip("/") + "/"
        for folder, deep in partition.value:
            for info in store.get_file_info(FileSelector(folder, recursive=deep)):
                if info.type == FileType.File and "." in info.base_name:
                    yield info.path, f"{self.root.rstrip('/')}/{info.path.removeprefix(base)}"


class CorpusFiles(DataSource):
    """``place, path`` of every file below the option ``path`` whose name holds a dot."""

    @classmethod
    def name(cls) -> str:
        return "corpus_files"

    def schema(self) -> str:
        return "place string, path string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Listing(self.options["path"])


def _contents(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(root)
        for batch in batches:
            for place, path in zip(batch.column(0).to_pylist(), batch.column(1)):
                with store.open_input_stream(place) as stream:
                    data = stream.read()
                yield pa.RecordBatch.from_arrays([pa.array([path.as_py()]), pa.array([data], pa.binary())], names=["path", "content"])

    return run


def scan_corpus(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` whose name holds a dot and whose bytes are UTF-8, each once.

    ``path`` is ``root`` and the file's place below it, as it is written in the store.
    """
    spark.dataSource.register(CorpusFiles)
    files = spark.read.format("corpus_files").option("path", root).load()
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = files.repartition(tasks, "place").mapInArrow(_contents(root), "path string, content binary")
    return found.where(F.is_valid_utf8(F.col("content").cast("string"))).select("path", F.col("content").cast("string").alias("text"))

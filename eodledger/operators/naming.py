"""Finding many names in texts with one pass over each text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Bytes of names that go to every task at once. A longer list is worked through in parts.
LIST_BYTES = 16 << 20


class _Finder:
    """The entries of ``specs (used, table, columns)`` whose names a text holds; all names are lowered."""

    def __init__(self, specs: list[tuple[str, str, list[str] | None]], need_column: bool):
        self.need_column = need_column
        self.by_table: dict[str, list[tuple[str, list[str]]]] = defaultdict(list)
        for used, table, columns in specs:
            self.by_table[table].append((used, [c for c in columns or () if c is not None]))
        names = set(self.by_table)
        if need_column:
            names.update(c for rows in self.by_table.values() for _, columns in rows for c in columns)
        self.everywhere = names & {""}
        self.words = ahocorasick.Automaton()
        for name in names - {""}:
            self.words.add_word(name, name)
        self.words.make_automaton()

    def __call__(self, text: str) -> list[str]:
        held = {name for _, name in self.words.iter(text)} if len(self.words) else set()
        held |= self.everywhere
        return [
            used
            for table in held & self.by_table.keys()
            for used, columns in self.by_table[table]
            if not self.need_column or not held.isdisjoint(columns)
        ]


def _part(corpus: DataFrame, text: str, specs: list[tuple], need_column: bool) -> DataFrame:
    kept = [c for c in corpus.columns if c != text]
    shared = corpus.sparkSession.sparkContext.broadcast(specs)
    schema = StructType([*[corpus.schema[c] for c in kept], StructField("used", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Finder(shared.value, need_column)
        for batch in batches:
            at, used = [], []
            for i, content in enumerate(batch.column(len(kept))):
                if content.is_valid:
                    found = find(content.as_py())
                    at += [i] * len(found)
                    used += found
            columns = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(used, pa.string())], names=schema.names)

    return corpus.select(*kept, F.lower(text).alias(text)).mapInArrow(run, schema)


def found_in(corpus: DataFrame, text: str, specs: DataFrame, need_column: bool) -> DataFrame:
    """The other columns of ``corpus`` and ``used``, for each text and entry of ``specs`` found in it.

    ``specs (used, name, columns)``: an entry is found where the lowered text holds the name as it is
    given and, with ``need_column``, any of the columns as well. All names make one automaton in each
    task, which reads a text once however many names there are. The list is known to be small before
    it is sent: beyond ``LIST_BYTES`` entries are dealt to parts by their hash, with one pass each.
    """
    rows = specs.select("used", "name", "columns").where(F.col("name").isNotNull())
    size = F.octet_length("name") + F.coalesce(F.aggregate("columns", F.lit(0), lambda n, c: n + F.coalesce(F.octet_length(c), F.lit(0))), F.lit(0))
    parts = -(-(rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]) // LIST_BYTES) or 1
    own = lambda k: [tuple(r) for r in rows.where(F.pmod(F.xxhash64("used", "name", "columns"), F.lit(parts)) == k).collect()]
    return reduce(DataFrame.unionByName, [_part(corpus, text, own(k), need_column) for k in range(parts)])

"""Phrase collocations from sorted streams of n-gram counts.

The counts of words, pairs and triples are one stream, kept in two orders. In prefix order an n-gram
stands behind the n-grams it begins with, in suffix order behind those it ends with, because every
part of a frequent n-gram is itself frequent. One pass over each order, in lockstep, therefore gives
every n-gram the counts of its left parts, then of its right parts, and tells each pair how often its
longer phrases extend it: the count last seen is the count looked for, and nothing is looked up.

Counting comes first: words and pairs in one pass over the texts; then triples, whose two pairs must
both be frequent. What tells a task which pairs are frequent is a bitmap of fixed size. It may call
a rare pair frequent, never a frequent one rare, and the counts of what passes are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eodledger.llm.common import pieces
from eodledger.session import stored

#: Phrases that occur less often are no candidates.
LEAST = 10
#: A candidate goes if a longer one that holds it has at least this percentage of its occurrences.
SHADOW = 50
#: Phrases returned for each language.
TOP = 2000
#: Words that a task counts together before it hands counts on.
HELD = 1_000_000
#: Bits of the bitmap of frequent pairs, as a power of two: 16 MB, whatever the input.
BITMAP = 27
#: Rows of a stream, as a power of two, that are passed over together.
BLOCK = 16
#: Rows of one batch that Python returns.
ROWS = 100_000

UND = "und"
SEED = 42
#: Letters become lower case, a tab a blank, and what ends a piece a line break.
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
#: No letter of the lowered texts, so it can stand between pieces.
_BREAK = b"A"


class _Ids(dict):
    """A number from 1 on for each word; 0 is the break between pieces."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _numbers(text: bytes, ids: _Ids) -> np.ndarray:
    words = text.translate(_TABLE).replace(b"\n", b" A ").split()
    return np.fromiter(map(ids.__getitem__, words), np.int64, len(words))


def _turned(values: np.ndarray) -> np.ndarray:
    return (values << np.uint64(21)) | (values >> np.uint64(43))


def _rows(lang: str, words: list[pa.Array], n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Batches of ``lang, w1, w2, w3, n``; words that are not given are null."""
    size = len(n)
    columns = [*words, *[pa.nulls(size, pa.string())] * (3 - len(words))]
    whole = pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang), size), *columns, pa.array(n)], names=["lang", "w1", "w2", "w3", "n"])
    for at in range(0, size, ROWS):
        yield whole.slice(at, ROWS)


def _short(lang: str, x: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
    """Counts of words and of pairs, and of all words in a row without one."""
    size = len(words)
    ones = np.bincount(x, minlength=size)
    seen = np.nonzero(ones[1:])[0] + 1
    yield from _rows(lang, [], np.array([ones[1:].sum()]))
    yield from _rows(lang, [words.take(pa.array(seen))], ones[seen])
    code, n = np.unique((x[:-1] * size + x[1:])[(x[:-1] > 0) & (x[1:] > 0)], return_counts=True)
    yield from _rows(lang, [words.take(pa.array(code // size)), words.take(pa.array(code % size))], n)


def _long(bits: np.ndarray):
    def count(lang: str, x: np.ndarray, words: pa.Array) -> Iterator[pa.RecordBatch]:
        """Counts of triples whose pairs are both in the bitmap."""
        size = len(words)
        own = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words.cast(pa.binary()).to_pylist()], np.uint64)[x]
        at = own[:-1] ^ _turned(own[1:]) ^ _turned(_turned(np.uint64(xxhash.xxh64_intdigest(lang.encode(), SEED))))
        at >>= np.uint64(64 - BITMAP)
        near = (x[:-1] > 0) & (x[1:] > 0) & ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
        first = np.nonzero(near[:-1] & near[1:])[0]
        pair, number = np.unique(x[first] * size + x[first + 1], return_inverse=True)
        code, n = np.unique(number * size + x[first + 2], return_counts=True)
        begin = pair[code // size]
        yield from _rows(lang, [words.take(pa.array(i)) for i in (begin // size, begin % size, code % size)], n)

    return count


def _counted(texts: DataFrame, count, most: int) -> DataFrame:
    """What ``count`` finds in the words of each language, ``most`` words at a time; ``count`` is called in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function, ids = count(), _Ids()
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            words = pa.array(list(ids), pa.binary()).cast(pa.string())
            for lang, numbers in held.items():
                yield from function(lang, np.concatenate(numbers), words)

        for whole in batches:
            for batch in pieces(whole, 1):
                for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    if text.is_valid:
                        numbers = _numbers(text.as_py(), ids)
                        held.setdefault(lang, []).extend((numbers, np.zeros(1, np.int64)))
                        size += len(numbers) + 1
                        if size >= most:
                            yield from flush()
                            ids, held, size = _Ids(), {}, 0
        if held:
            yield from flush()

    rows = texts.mapInArrow(run, "lang string, w1 string, w2 string, w3 string, n long")
    return rows.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))


def frequent_pairs(pairs: DataFrame) -> np.ndarray:
    """The bitmap of ``pairs (lang, w1, w2)``: a bit for the hash of each."""
    turned = lambda h: F.shiftleft(h, 21).bitwiseOR(F.shiftrightunsigned(h, 43))
    at = F.xxhash64("w1").bitwiseXOR(turned(F.xxhash64("w2"))).bitwiseXOR(turned(turned(F.xxhash64("lang"))))
    at = F.shiftrightunsigned(at, 64 - BITMAP)
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    # At most 2 ** (BITMAP - 6) rows, combined before their exchange.
    found = pairs.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(1 << (BITMAP - 6), np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits.view(np.uint8)


def counts(df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, held: int = HELD) -> DataFrame:
    """``lang, w1, w2, w3, n``: words, pairs and triples with at least ``least`` occurrences within pieces.

    The words behind an n-gram's last are null; a row without any word has the number of all words.
    """
    texts = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(UND)).alias("lang"), F.col(text).cast("string").cast("binary").alias("text"))
    enough = F.col("n") >= least
    short = stored(_counted(texts, lambda: _short, held).filter(enough | F.col("w1").isNull()), "words")
    shared = df.sparkSession.sparkContext.broadcast(frequent_pairs(short.filter("w2 is not null")).tobytes())
    long = _counted(texts, lambda: _long(np.frombuffer(shared.value, np.uint8)), held).filter(enough)
    return short.unionByName(stored(long, "triples"))


def in_lockstep(stream: DataFrame, order: list[Column], one: str, two: str) -> DataFrame:
    """``stream`` with ``one`` and ``two``, the counts of the word and of the pair that came last in the order.

    ``order`` are the language and the words of an n-gram, from one end; ``size`` is their number. The
    stream is dealt by ranges of the whole order and stored, so no frequent word makes a large task;
    it is passed over in blocks, each of which starts with what the blocks before it ended with.
    """
    names = [f"__{i}" for i in range(len(order))]
    keyed = stream.withColumns(dict(zip(names, order)))
    rows = stored(
        keyed.repartitionByRange(*names).sortWithinPartitions(*names).drop(*names).withColumn("__at", F.monotonically_increasing_id()), "stream"
    ).withColumn("__block", F.shiftright("__at", BLOCK))
    seen = {c: F.when(F.col("size") == k, F.col("n")) for c, k in ((one, 1), (two, 2))}
    ends = rows.groupBy("__block").agg(*[F.max_by(F.col("n"), F.when(F.col("size") == k, F.col("__at"))).alias(c) for c, k in ((one, 1), (two, 2))])
    # One row for each block of 2 ** BLOCK rows.
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("__block", *[F.last(c, ignorenulls=True).over(before).alias(f"__{c}") for c in seen])
    here = Window.partitionBy("__block").orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.join(starts, "__block")
        .withColumns({c: F.coalesce(F.last(v, ignorenulls=True).over(here), F.col(f"__{c}")) for c, v in seen.items()})
        .drop("__block", "__at", *[f"__{c}" for c in seen])
    )


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), in decimals of 38 digits: exact, or an error beyond 10 ** 15 occurrences."""
    exact = lambda c: f"cast({c} as decimal(19,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({exact(a)} * {exact(a)})) div ({exact(left)} * {exact(right)})")


def candidates(df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, shadow: int = SHADOW) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of every phrase that stays.

    Phrases are two or three words with at least ``least`` occurrences. Of the cuts of a triple the
    one with the lowest score counts, the first of equal ones. A pair goes if a frequent triple that
    holds it has at least ``shadow`` percent of its occurrences. A null language is ``und``; null and
    empty texts hold nothing; repeated rows count as often as they occur; an empty table gives no
    rows; other columns are not read.
    """
    found = counts(df, lang, text, least)
    size = F.when(F.col("w3").isNotNull(), 3).when(F.col("w2").isNotNull(), 2).otherwise(1)
    stream = found.filter("w1 is not null").withColumn("size", size)
    prefix = in_lockstep(stream, [F.col(c) for c in ("lang", "w1", "w2", "w3")], "begin1", "begin2")
    ends = [F.coalesce("w3", "w2", "w1"), F.when(size == 3, F.col("w2")).when(size == 2, F.col("w1")), F.when(size == 3, F.col("w1"))]
    both = stored(in_lockstep(prefix, [F.col("lang"), *ends], "end1", "end2"), "phrases")
    cut = lambda k, left, right: F.struct(score("n", left, right).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))
    best = F.when(F.col("size") == 2, cut(1, "begin1", "end1")).otherwise(F.least(cut(1, "begin1", "end2"), cut(2, "begin2", "end1")))
    triples = both.filter("size = 3")
    shadows = (
        triples.filter(100 * F.col("n") >= shadow * F.col("begin2"))
        .select("lang", "w1", "w2")
        .unionByName(triples.filter(100 * F.col("n") >= shadow * F.col("end2")).select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")))
        .distinct()
    )
    kept = both.filter("size = 2").join(shadows.hint("merge"), ["lang", "w1", "w2"], "left_anti").unionByName(triples)
    total = found.filter("w1 is null").select("lang", F.col("n").alias("total"))
    return kept.withColumn("cut", best).join(total, "lang").select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        F.col("n").alias("a"),
        "cut.l",
        "cut.r",
        F.col("total").alias("n"),
        F.col("cut.score").alias("score"),
    )


def collocations(
    df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, shadow: int = SHADOW, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``top`` phrases of each language.

    They descend by score, then by ``a``; then the phrase ascends bytewise. Spark keeps the first
    ``top`` of a language in each task before they meet.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = candidates(df, lang, text, least, shadow).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Removal of passages that an earlier document holds, by difference-cover anchors.

A passage is found by windows of words. The places of a text are numbered modulo a period, and only
runs of words at the places of a difference cover are hashed: for any two numbers some shift below the
period takes both into the cover. Two equal windows, wherever they stand, therefore contain equal
anchors at the same distance from their starts, as long as an anchor fits behind the largest shift. So
a window that holds no anchor shared with another text is no copy, and only the windows around shared
anchors are extended to their whole length and compared.

Hashes travel packed, as arrays: one row for each bucket of hashes and batch of texts, in which each
hash stands once however many texts of the batch hold it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eodledger.llm.common import pieces
from eodledger.session import stored

#: Words of a passage.
WINDOW = 13
#: Numbers of the places, and those whose differences modulo the period are all numbers.
PERIOD, COVER = 7, (0, 1, 3)
#: Words of an anchor: it fits into a window behind any shift below the period.
ANCHOR = WINDOW - PERIOD + 1
#: Bytes of text for each bucket of hashes, so that a bucket is small at any size of the input.
BUCKET_BYTES = 16 << 20
#: Words whose hashes a Python worker remembers, of up to so many bytes each.
REMEMBERED, SHORT = 500_000, 64
#: In place of a text where several texts of a batch share an anchor.
SEVERAL = 0

PROBE = "bucket int, known boolean, rids array<long>, a array<long>, b array<long>, keys array<long>"
FOUND = "bucket int, rids array<long>, hashes array<long>"


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


_ANCHOR_BY, _A_BY, _B_BY = _odd(64, 1), _odd(64, 2), _odd(64, 3)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class _Words:
    """The words of some texts, one after the other: hash, number of the text, place in it, words from there on."""

    def __init__(self, texts: list[bytes | None], hashes: _Hashes):
        own = []
        for text in texts:
            words = text.split() if text else ()
            own.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        sizes = np.array([len(o) for o in own], np.int64)
        self.h = np.concatenate(own) if own else np.empty(0, np.uint64)
        self.text = np.repeat(np.arange(len(own)), sizes)
        ends = np.cumsum(sizes)
        self.place = np.arange(len(self.h)) - np.repeat(ends - sizes, sizes)
        self.left = np.repeat(ends, sizes) - np.arange(len(self.h))
        self.size = np.repeat(sizes, sizes)

    def runs(self, at: np.ndarray, by: np.ndarray, width: int) -> np.ndarray:
        """A hash of the ``width`` words from each place ``at`` on."""
        out = np.zeros(len(at), np.uint64)
        for j in range(width):
            out += by[j] * self.h[at + j]
        return out

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the cover, in texts that hold a window, and the hashes of their anchors."""
        cover = np.isin(np.arange(PERIOD), COVER)
        at = np.nonzero(cover[self.place % PERIOD] & (self.left >= ANCHOR) & (self.size >= WINDOW))[0]
        return at, self.runs(at, _ANCHOR_BY, ANCHOR)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _changes(*sorted_: np.ndarray) -> np.ndarray:
    """Where a new run of equal values starts."""
    new = np.ones(len(sorted_[0]), bool)
    new[1:] = np.logical_or.reduce([s[1:] != s[:-1] for s in sorted_])
    return np.nonzero(new)[0]


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    ends = np.append(starts, len(values)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64) if values.dtype == np.uint64 else values))


def _probes(bucket: np.ndarray, rids: np.ndarray, a: np.ndarray, b: np.ndarray | None = None, keys: np.ndarray | None = None) -> pa.RecordBatch:
    """One row for each bucket; ``bucket`` ascends."""
    starts = _changes(bucket) if len(bucket) else np.empty(0, np.int64)
    none = pa.nulls(len(starts), pa.list_(pa.int64()))
    columns = [pa.array(bucket[starts]), pa.repeat(pa.scalar(False), len(starts)), _lists(rids, starts), _lists(a, starts)]
    return _probe_batch([*columns, none if b is None else _lists(b, starts), none if keys is None else _lists(keys, starts)])


def _known(rids: np.ndarray, hashes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """One row for each text whose hashes need no other batch, in a bucket of its own hash."""
    order = np.argsort(rids, kind="stable")
    rids, hashes = rids[order], hashes[order]
    starts = _changes(rids) if len(rids) else np.empty(0, np.int64)
    own = rids[starts]
    none = pa.nulls(len(starts), pa.list_(pa.int64()))
    return _probe_batch(
        [pa.array(_bucket(own.view(np.uint64), buckets)), pa.repeat(pa.scalar(True), len(starts)), _lists(own, np.arange(len(own))), _lists(hashes, starts), none, none]
    )


def _probe_batch(columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "known", "rids", "a", "b", "keys"])


def _anchor_probes(buckets: int):
    """From batches of ``rid, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            for batch in pieces(whole, 1):
                words = _Words(batch.column(1).to_pylist(), hashes)
                at, a = words.anchors()
                text = words.text[at]
                order = np.lexsort((text, a))
                a, text = a[order], text[order]
                first = _changes(a, text) if len(a) else order
                a, text = a[first], text[first]
                rids = batch.column(0).to_numpy(zero_copy_only=False)[text]
                starts = _changes(a) if len(a) else first
                sizes = np.diff(np.append(starts, len(a)))
                several = np.repeat(sizes > 1, sizes)
                yield _known(rids[several], a[several], buckets)
                one = np.where(sizes > 1, SEVERAL, rids[starts]) if len(a) else rids
                yield _probes(_bucket(a[starts], buckets), one, a[starts])

    return run


def _flat(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _found(table: pa.Table, choose: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], buckets: int) -> pa.Table:
    """What ``choose`` picks among a bucket's probes, and what was known before: a row for each bucket of texts."""
    known = table.column("known").to_numpy()
    probes, rest = table.filter(pa.array(~known)), table.filter(pa.array(known))
    rids, hashes = choose(probes)
    sizes = rest.column("a").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    return _by_bucket(np.append(rids, np.repeat(_flat(rest, "rids"), sizes)), np.append(hashes, _flat(rest, "a")), buckets)


def _by_bucket(rids: np.ndarray, hashes: np.ndarray, buckets: int) -> pa.Table:
    rids, hashes, _ = _sorted(rids, hashes)
    bucket = _bucket(rids.view(np.uint64), buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, rids, hashes = bucket[order], rids[order], hashes[order]
    starts = _changes(bucket) if len(bucket) else np.empty(0, np.int64)
    return pa.table({"bucket": pa.array(bucket[starts]), "rids": _lists(rids, starts), "hashes": _lists(hashes, starts)})


def _sorted(rids: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs without repeats, by text, and where a new text starts."""
    order = np.lexsort((hashes, rids))
    rids, hashes = rids[order], hashes[order]
    if not len(rids):
        return rids, hashes, np.empty(0, np.int64)
    first = _changes(rids, hashes)
    rids, hashes = rids[first], hashes[first]
    return rids, hashes, _changes(rids)


def _gathered(table: pa.Table) -> pa.Table:
    """One row for each text of a bucket."""
    rids, hashes, starts = _sorted(_flat(table, "rids"), _flat(table, "hashes"))
    return pa.table({"rid": pa.array(rids[starts]), "hashes": _lists(hashes, starts)})


def _shared(buckets: int):
    """The anchors of a bucket that texts of several batches hold, or several texts of one."""

    def choose(probes: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rids, a = _flat(probes, "rids"), _flat(probes, "a")
        order = np.argsort(a, kind="stable")
        rids, a = rids[order], a[order]
        starts = _changes(a) if len(a) else order
        sizes = np.diff(np.append(starts, len(a)))
        none = np.add.reduceat(rids == SEVERAL, starts, dtype=np.int64) if len(a) else sizes
        chosen = np.repeat((sizes > 1) | (none > 0), sizes) & (rids != SEVERAL)
        return rids[chosen], a[chosen]

    return lambda table: _found(table, choose, buckets)


def _window_probes(buckets: int):
    """From batches of ``rid, text, key, hashes``, the shared anchors of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            for batch in pieces(whole, 1):
                words = _Words(batch.column(1).to_pylist(), hashes)
                at, anchor = words.anchors()
                shared = np.unique(batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                near = np.zeros(len(words.h) + PERIOD, bool)
                near[at[np.isin(anchor, shared)]] = True
                whole_windows = words.left >= WINDOW
                close = np.logical_or.reduce([near[d : d + len(words.h)] for d in range(PERIOD)]) & whole_windows
                at = np.nonzero(close)[0]
                a, b = words.runs(at, _A_BY, WINDOW), words.runs(at, _B_BY, WINDOW)
                rids = batch.column(0).to_numpy(zero_copy_only=False)[words.text[at]]
                keys = batch.column(2).to_numpy(zero_copy_only=False)[words.text[at]]
                order = np.lexsort((rids, keys, b, a))
                a, b, rids, keys = a[order], b[order], rids[order], keys[order]
                if len(a):
                    first = _changes(a, b, keys, rids)
                    a, b, rids, keys = a[first], b[first], rids[first], keys[first]
                starts = _changes(a, b) if len(a) else order
                least = np.repeat(keys[starts], np.diff(np.append(starts, len(a))))
                later = keys > least
                yield _known(rids[later], a[later], buckets)
                ask = ~later
                yield _probes(_bucket(a[ask], buckets), rids[ask], a[ask], b[ask], keys[ask])

    return run


def _covered(buckets: int):
    """The windows of a bucket that a text with a smaller key holds as well."""

    def choose(probes: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rids, a, b, keys = (_flat(probes, c) for c in ("rids", "a", "b", "keys"))
        order = np.lexsort((b, a))
        rids, a, b, keys = rids[order], a[order], b[order], keys[order]
        starts = _changes(a, b) if len(a) else order
        least = np.minimum.reduceat(keys, starts) if len(a) else keys
        later = keys > np.repeat(least, np.diff(np.append(starts, len(a))))
        return rids[later], a[later]

    return lambda table: _found(table, choose, buckets)


def _by_text(found: DataFrame) -> DataFrame:
    """One row for each text, with all its hashes: no more than it has words."""
    return found.groupBy("bucket").applyInArrow(_gathered, "rid long, hashes array<long>")


def covered_windows(df: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` as ``rid, text, key``, and ``rid, hashes``: the hashes of each text's windows that are to go.

    ``rid`` is a hash of key and text. Rows without a key take no part.
    """
    own = F.col(key).cast("long")
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rid = F.xxhash64(own, content)
    texts = df.select(F.when(rid == SEVERAL, 1).otherwise(rid).alias("rid"), content.cast("binary").alias("text"), own.alias("key"))
    keyed = texts.filter("key is not null")
    spark = df.sparkSession
    size = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    anchors = keyed.select("rid", "text").mapInArrow(_anchor_probes(buckets), PROBE)
    shared = stored(anchors.groupBy("bucket").applyInArrow(_shared(buckets), FOUND), "anchors")
    near = keyed.join(_by_text(shared), "rid").select("rid", "text", "key", "hashes")
    windows = near.mapInArrow(_window_probes(buckets), PROBE)
    return texts, stored(windows.groupBy("bucket").applyInArrow(_covered(buckets), FOUND), "windows")


def _kept(joined: bool):
    """From batches of ``rid, text, key, hashes``: key, counts, and the kept words or their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for whole in batches:
            for batch in pieces(whole, 1):
                out: list[tuple] = []
                for text, gone in zip(batch.column(1).to_pylist(), batch.column(3)):
                    words = text.split()
                    left = words
                    if gone.is_valid:
                        own = _Words([text], hashes)
                        at = np.nonzero(own.left >= WINDOW)[0]
                        starts = at[np.isin(own.runs(at, _A_BY, WINDOW), gone.values.to_numpy().view(np.uint64))]
                        edges = np.zeros(len(words) + 1, np.int64)
                        edges[starts] += 1
                        np.subtract.at(edges, starts + WINDOW, 1)
                        left = [words[i] for i in np.nonzero(np.cumsum(edges[:-1]) == 0)[0].tolist()]
                    line = b" ".join(left)
                    out.append((len(words), len(words) - len(left), line if joined else hashlib.sha256(line).hexdigest()))
                n, removed, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary() if joined else pa.string())],
                    names=["key", "n_words", "n_removed", "kept"],
                )

    return run


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """``key, n_words, n_removed`` and ``kept`` (or its SHA-256, ``kept_sha256``) for every row of ``df``.

    Words are runs of what is not ASCII white space. A word goes if a window of ``WINDOW`` words
    around it also starts in a row with a smaller key, judged on the texts as they come; ``kept`` are
    the other words, joined by one blank. A null text has no words. Rows with equal keys take nothing
    from each other; a null key is neither smaller nor larger than any, so such rows stay whole and
    take nothing away. Repeated rows repeat; an empty table gives no rows; other columns are not read.
    """
    texts, gone = covered_windows(df, key, text)
    joined = texts.join(_by_text(gone), "rid", "left").select("rid", "text", "key", "hashes")
    name = "string" if digest else "binary"
    found = joined.mapInArrow(_kept(not digest), f"key long, n_words long, n_removed long, kept {name}")
    kept = F.col("kept").alias("kept_sha256") if digest else F.col("kept").cast("string").alias("kept")
    return found.select(F.col("key").alias(key), "n_words", "n_removed", kept)

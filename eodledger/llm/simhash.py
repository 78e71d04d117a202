"""Near duplicates by 64-bit SimHash, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from eodledger.llm.common import fresh, per_text
from eodledger.llm.components import components, forest
from eodledger.session import stored

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
#: Fingerprints in a tile. A group of more is cut into tiles, and pairs of tiles are compared in separate tasks.
TILE = 2048
#: Rows of one tile that are compared with the other tile in one numpy call.
STRIP = 256


def shingle_hashes(text: str, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of ``width`` words (of all words, if there are fewer), repeats included."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[: -width] + 1)).tolist()
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    found = (digest(view[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist()))
    return np.fromiter(found, np.uint64, len(starts))


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it; no hashes give zero."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _work():
    def run(texts: list) -> dict:
        found = np.array([fingerprint(shingle_hashes(t or "")) for t in texts], np.uint64)
        return {"fp": found.view(np.int64)}

    return run


def fingerprints(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``fp``, the fingerprint of the whole text as a signed long.

    A null text counts as empty; an empty text, or one of white space only, gives zero.
    """
    return per_text(df, text, keep, {"fp": LongType()}, _work)


def bit_counts(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps).astype(np.int16)


def tile_links(a: np.ndarray, b: np.ndarray | None = None, radius: int = RADIUS) -> np.ndarray:
    """Links between the fingerprints of two tiles, or within one, each sorted by bit count.

    Returns a forest: pairs of fingerprints that connect what the links connect. Strips whose bit
    counts differ from a tile's by more than the radius are skipped, and so are parts of a tile.
    """
    other = a if b is None else b
    nodes = a if b is None else np.concatenate((a, b))
    shift = 0 if b is None else len(a)
    mine, theirs = bit_counts(a), bit_counts(other)
    parent = np.arange(len(nodes))
    for at in range(0, len(a), STRIP):
        strip = a[at : at + STRIP]
        low = np.searchsorted(theirs, mine[at] - radius, "left")
        high = np.searchsorted(theirs, mine[min(at + STRIP, len(a)) - 1] + radius, "right")
        if b is None:
            low = max(low, at)
        if low >= high:
            continue
        near = np.bitwise_count(strip[:, None] ^ other[None, low:high]) <= radius
        i, j = np.nonzero(near)
        parent = forest(parent, i + at, j + low + shift)
    child = np.nonzero(parent != np.arange(len(nodes)))[0]
    return np.stack((nodes[child], nodes[parent[child]]), axis=1)


def _small_links(fps: np.ndarray, ends: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within many small groups at once; ``ends`` has, for each row, where its group ends."""
    a, b = [], []
    rows, step = np.arange(len(fps)), 1
    while len(rows := rows[rows + step < ends[rows]]):
        near = rows[np.bitwise_count(fps[rows] ^ fps[rows + step]) <= radius]
        a.append(near)
        b.append(near + step)
        step += 1
    return (np.concatenate(a), np.concatenate(b)) if a else (rows, rows)


#: Groups of up to this many fingerprints are compared together with other groups.
SMALL = 64


def _compare(radius: int):
    def links(fps: np.ndarray, sides: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        sizes = ends - starts
        small = np.repeat(sizes <= SMALL, sizes)
        out = []
        if small.any():
            kept = np.nonzero(small)[0]
            last = np.cumsum(sizes[sizes <= SMALL])
            own = fps[kept]
            i, j = _small_links(own, np.repeat(last, sizes[sizes <= SMALL]), radius)
            parent = forest(np.arange(len(own)), i, j)
            child = np.nonzero(parent != np.arange(len(own)))[0]
            out.append(np.stack((own[child], own[parent[child]]), axis=1))
        for s, e in zip(starts[sizes > SMALL].tolist(), ends[sizes > SMALL].tolist()):
            f, side = fps[s:e], sides[s:e]
            order = np.argsort(bit_counts(f), kind="stable")
            f, side = f[order], side[order]
            out.append(tile_links(f, None, radius) if not side.any() else tile_links(f[side == 0], f[side == 1], radius))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(table: pa.Table) -> Iterator[pa.RecordBatch]:
            gid = table.column("gid").to_numpy()
            if not len(gid):
                return
            starts = np.concatenate(([0], np.nonzero(gid[1:] != gid[:-1])[0] + 1))
            ends = np.concatenate((starts[1:], [len(gid)]))
            fps = table.column("fp").to_numpy().view(np.uint64)
            for found in links(fps, table.column("side").to_numpy(), starts, ends):
                found = found.view(np.int64)
                low, high = found.min(axis=1), found.max(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(high), pa.array(low)], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            table = pa.Table.from_batches(held).combine_chunks()
            gid = table.column("gid").to_numpy()
            cut = int(np.searchsorted(gid, gid[-1], "left"))  # the last group may go on
            yield from flush(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held:
            yield from flush(pa.Table.from_batches(held).combine_chunks())

    return run


def _bands(radius: int) -> list[tuple[int, int]]:
    """Start and width of the bit bands; texts within the radius agree on at least one of them."""
    cuts = [BITS * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(u, v)`` pairs of distinct fingerprints that connect all those within ``radius`` bits.

    ``fps`` has one column ``fp`` without repeats. Two fingerprints that differ in at most
    ``radius`` bits agree on one of ``radius + 1`` bands, so tiles are formed within the groups
    that share a band. A group of more than ``tile`` fingerprints is cut by bit count, and a bit
    count of more than ``tile`` by a hash; only pairs of tiles whose bit counts differ by no more
    than the radius are formed, each in its own group, so a frequent band spreads over tasks.
    Within a group at most one pair per fingerprint is returned, however many are linked.
    """
    band = lambda k, start, width: F.shiftrightunsigned("fp", start).bitwiseAND((1 << width) - 1) + F.lit(k << 58)
    rows = fps.select(
        "fp",
        F.bit_count("fp").cast("int").alias("ones"),
        F.explode(F.array(*[band(k, *b) for k, b in enumerate(_bands(radius))])).alias("key"),
    )
    cells = rows.groupBy("key", "ones").agg(F.count("*").alias("n"))
    sums = cells.groupBy("key").agg(F.sum("n").alias("total")).filter(F.col("total") > tile)
    cut = stored(cells.join(sums, "key").select("key", "ones", F.ceil(F.col("n") / tile).cast("int").alias("parts")), "cells")
    tiles = cut.select("key", "ones", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    a, b = tiles.alias("a"), tiles.alias("b")
    pairs = a.join(b, F.col("a.key") == F.col("b.key")).filter(
        (F.col("b.ones") - F.col("a.ones")).between(0, radius)
        & ((F.col("b.ones") > F.col("a.ones")) | (F.col("b.part") >= F.col("a.part")))
    ).select("a.key", F.col("a.ones").alias("oa"), F.col("a.part").alias("pa"), F.col("b.ones").alias("ob"), F.col("b.part").alias("pb"))
    gid = F.xxhash64("key", "oa", "pa", "ob", "pb")
    roles = pairs.select("key", F.col("oa").alias("ones"), F.col("pa").alias("part"), gid.alias("gid"), F.lit(0).alias("side")).unionByName(
        pairs.filter("oa <> ob or pa <> pb").select("key", F.col("ob").alias("ones"), F.col("pb").alias("part"), gid.alias("gid"), F.lit(1).alias("side"))
    )
    roles = roles.groupBy("key", "ones", "part").agg(F.collect_list(F.struct("gid", "side")).alias("groups"))
    part: Column = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    held = rows.join(cut, ["key", "ones"], "left").withColumn("part", part)
    whole = held.filter("parts is null").select("fp", F.xxhash64("key").alias("gid"), F.lit(0).alias("side"))
    split = (
        held.filter("parts is not null")
        .join(roles, ["key", "ones", "part"])
        .select("fp", F.explode("groups").alias("g"))
        .select("fp", "g.gid", "g.side")
    )
    return (
        whole.unionByName(split)
        .repartition("gid")
        .sortWithinPartitions("gid")
        .mapInArrow(_compare(radius), "u long, v long")
    )


def clusters(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``(fp, root)`` for each distinct fingerprint: the smallest one reachable over links."""
    nodes = stored(fps.select("fp").distinct(), "fps")
    return components(nodes.withColumnRenamed("fp", "node"), links(nodes, radius, tile)).select(
        F.col("node").alias("fp"), "root"
    )


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Rows are linked if their fingerprints differ in at most ``radius`` bits; ``component_id`` is
    the smallest key reachable over links, the own included. Null and empty texts have fingerprint
    zero and are linked like any other. A repeated row is returned as often as it occurs. A null
    key is ignored in the smallest key, which is null only if all keys of a component are. An
    empty table gives no rows; other columns are not read.
    """
    found = stored(fingerprints(df, text, (key,)), "fingerprints")
    roots = clusters(found, radius, tile)
    own = found.groupBy("fp").agg(F.min(key).alias("low"))
    reps = own.join(roots, "fp")
    low = reps.groupBy("root").agg(F.min("low").alias("component_id"))
    names = reps.join(low, "root").select("fp", "component_id")
    return found.join(names, "fp").select(
        key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """The rows of ``df`` that stay: of each component the one with the smallest key.

    A null key comes last. Of rows with equal keys in a component, the one with the smallest text hash
    stays, so repeated rows leave one. Columns are those of ``df``; an empty table gives no rows. Keys,
    hashes and fingerprints are stored, texts are not; the rows that stay are found by key and hash.
    """
    own = F.xxhash64(F.col(text))
    found = stored(per_text(df.select(F.col(key).alias("key"), F.col(text).alias("text"), own.alias("own")), "text", ("key", "own"), {"fp": LongType()}, _work), "fingerprints")
    roots = clusters(found.select("fp"), radius, tile)
    low = found.groupBy("fp").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "own")).alias("low"))
    best = low.join(roots, "fp").groupBy("root").agg(F.min("low").alias("low"))
    # Null has a name of its own, so that the join and the ranking behind it deal rows out alike:
    # the texts are shuffled once.
    named = lambda k: F.coalesce(F.concat(F.lit("="), k.cast("string")), F.lit(""))
    name, mine, first = fresh(df, "__key"), fresh(df, "__own"), fresh(df, "__first")
    best = best.select(named(F.col("low.key")).alias(name), F.col("low.own").alias(mine))
    chosen = df.withColumns({name: named(F.col(key)), mine: own}).join(best, [name, mine], "left_semi")
    order = Window.partitionBy(name, mine).orderBy(F.length(text).asc_nulls_first())
    return chosen.withColumn(first, F.row_number().over(order)).filter(F.col(first) == 1).select(*df.columns)

"""Exact top-k by inner product over a bit-sliced index.

The components of a block of vectors are held as bitmaps, one for each attribute and bit. A query
adds the slices of all attributes, each shifted by the bits of the query's own component, with
bitmap arithmetic: the sums are bitmaps again, one for each bit of the score. The k best rows are
then read off from the most significant slice downward; rows that are still equal at the end are a
tie, which the order of the rows in the block, that of their ids, resolves exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCALE = 64
#: Vectors in a block of the index, and queries that meet a block together.
BLOCK, QUERIES = 16_384, 1_024


def slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmaps [attribute, bit, word] of the columns of ``values`` above their minima; the minima."""
    low = values.min(axis=0)
    above = (values - low).T
    width = max(1, int(above.max(initial=0)).bit_length())
    rows = -len(values) % 64
    bits = (above[:, None, :] >> np.arange(width)[None, :, None]) & 1
    packed = np.packbits(np.pad(bits.astype(np.uint8), ((0, 0), (0, 0), (0, rows))), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64), low


def added(columns: dict[int, list[np.ndarray]]) -> list[np.ndarray]:
    """The bits of a sum, lowest first. ``columns``: for each power of two, stacks of bitmaps to add.

    Three bitmaps of one power become a bitmap of that power and one of the next, all triples of a
    power in one step.
    """
    out, power = [], 0
    width = next(iter(columns.values()))[0].shape[-1]
    while power <= max(columns):
        stack = np.concatenate([np.atleast_2d(x) for x in columns.pop(power, [])] or [np.zeros((1, width), np.uint64)])
        while len(stack) > 1:
            n = len(stack) // 3
            if n:
                a, b, c, rest = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n], stack[3 * n :]
                half = a ^ b
                carry = (a & b) | (half & c)
                stack = np.concatenate((half ^ c, rest))
            else:
                carry = (stack[0] & stack[1])[None]
                stack = (stack[0] ^ stack[1])[None]
            columns.setdefault(power + 1, []).append(carry)
        out.append(stack[0])
        power += 1
        if not columns:
            break
    return out


def score_slices(index: np.ndarray, query: np.ndarray) -> list[np.ndarray]:
    """Bits of the score of every row, up to a constant that is the same for all rows.

    A negative component counts the other way round: its attribute's complement is added.
    """
    width = index.shape[1]
    columns: dict[int, list[np.ndarray]] = {}
    size = np.abs(query)
    flip = np.where(query < 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    for a in range(int(size.max(initial=0)).bit_length()):
        chosen = np.nonzero((size >> a) & 1)[0]
        if not len(chosen):
            continue
        part = index[chosen] ^ flip[chosen][:, None, None]
        for b in range(width):
            columns.setdefault(a + b, []).append(part[:, b])
    return added(columns) if columns else [np.zeros(index.shape[2], np.uint64)]


def best_rows(bits: list[np.ndarray], live: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k rows with the highest scores, earlier rows first among equals."""
    sure, tied = np.zeros_like(live), live
    for plane in reversed(bits):
        more = tied & plane
        n = int(np.bitwise_count(sure | more).sum())
        if n <= k:
            sure, tied = sure | more, tied & ~plane
            if n == k:
                return _positions(sure)
        else:
            tied = more
    rows = _positions(sure)
    return np.concatenate((rows, _positions(tied)[: k - len(rows)]))


def _positions(bitmap: np.ndarray) -> np.ndarray:
    words = np.nonzero(bitmap)[0]
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, b = np.nonzero(bits)
    return words[w] * 64 + b


def block_best(ids: np.ndarray, values: np.ndarray, qids: np.ndarray, queries: np.ndarray, k: int) -> pd.DataFrame:
    """The best k rows of one block for each query; a query's own row takes no part."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    index, _ = slices(values)
    full = np.packbits(np.pad(np.ones(len(ids), np.uint8), (0, -len(ids) % 64)), bitorder="little").view(np.uint64)
    out = []
    for qid, query in zip(qids.tolist(), queries):
        live = full
        if (at := np.searchsorted(ids, qid)) < len(ids) and ids[at] == qid:
            live = full.copy()
            for i in range(at, np.searchsorted(ids, qid, "right")):
                live[i // 64] &= ~(np.uint64(1) << np.uint64(i % 64))
        rows = best_rows(score_slices(index, query), live, k)
        out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[rows], "score": values[rows] @ query}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def quantised(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``key`` and ``v``, the components as whole numbers; without vectors that take no part.

    A vector takes no part if it is null or empty, or a component is null, infinite or not a number.
    """
    return (
        df.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("x"))
        .filter(F.col("x").isNotNull() & (F.size("x") > 0) & F.col("key").isNotNull())
        .withColumn("x", F.transform("x", lambda e: e.cast("double")))
        .filter(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
        .select("key", F.transform("x", lambda e: F.floor(e * scale)).alias("v"))
    )


def top_k(
    df: DataFrame,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    scale: int = SCALE,
    block: int = BLOCK,
    queries: int = QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest scores of each query against all rows.

    Queries are the rows whose key is divisible by ``every``. Vectors become whole numbers,
    floor(scale * x); the score is their inner product. Ties go to the smaller key; with fewer
    candidates all are returned. A null vector, an empty one, and one with a null, infinite or
    not-a-number component takes no part, nor does a row without key. A repeated row is a candidate
    as often as it occurs and a query once. Vectors of different lengths are an error.

    Rows are dealt to blocks by a hash of the key, so no vector or key gathers in one task. Each
    part of the queries meets each block once; a pair returns at most k rows a query, and these are
    ranked by query. The number of pairs is that of an exact search; none of the rows is skipped.
    """
    rows = quantised(df, key, vector, scale)
    sizes = rows.agg(F.count("*").alias("n")).first()["n"]
    blocks, parts = -(-sizes // block) or 1, -(-sizes // (every * queries)) or 1
    one = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks)).cast("int"))
    many = (
        rows.filter(F.col("key") % every == 0)
        .dropDuplicates(["key"])
        .withColumn("part", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(parts)).cast("int"))
    )
    side = "key", "v"
    left = one.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select("block", "part", *side)
    right = many.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select("block", "part", *side)

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return block_best(
            left["key"].to_numpy(), np.stack(left["v"].to_numpy()), right["key"].to_numpy(), np.stack(right["v"].to_numpy()), k
        )

    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(
        meet, "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

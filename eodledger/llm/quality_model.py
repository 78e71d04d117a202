"""Text quality by random indexing and a small network.

Random indexing gives each word (a bucket of words, by hash) a fixed sparse random vector, and adds
up, over the whole corpus, those of the words around it: words used alike get vectors alike, in one
pass and in a space whose size does not grow. A document is the mean of its words' vectors; a network
of two layers turns it into a chance, whose temperature is fitted on rows kept apart.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType

from eodledger.llm.boosting import sigmoid, temperature
from eodledger.llm.common import per_text, pieces
from eodledger.llm.labelled import held_out, sample

BUCKETS, SIZE, MARKS, REACH = 8192, 64, 4, 2
#: Buckets in a row of the summed vectors.
CHUNK = 256
#: Tasks whose tables are added together first.
TASKS = 1024
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]+|_+")
REMEMBERED = 1_000_000
_KNOWN: dict[str, int] = {}


def words(text: str) -> np.ndarray:
    """The bucket of each word, number and run of signs of a text."""
    if len(_KNOWN) > REMEMBERED:
        _KNOWN.clear()
    tokens, known = TOKEN.findall(text), _KNOWN
    found = [known.get(t) for t in tokens]
    if None in found:
        for i, b in enumerate(found):
            if b is None:
                found[i] = known[tokens[i]] = zlib.crc32(tokens[i].encode()) % BUCKETS
    return np.array(found, np.int32)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few entries of each bucket's random vector."""
    rng = np.random.default_rng(11)
    return rng.integers(0, SIZE, (BUCKETS, MARKS)), rng.choice([-1.0, 1.0], (BUCKETS, MARKS))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task's texts add to the vectors of the buckets, and their counts."""
    places, signs = index_vectors()
    sums, counts = np.zeros(BUCKETS * SIZE), np.zeros(BUCKETS)
    for whole in batches:
        for batch in pieces(whole, 0):
            found = [words(t or "") for t in batch.column(0).to_pylist()]
            ids = np.concatenate(found) if found else np.empty(0, np.int32)
            document = np.repeat(np.arange(len(found)), [len(f) for f in found])
            counts += np.bincount(ids, minlength=BUCKETS)
            for at in range(0, len(ids), 1 << 20):
                end = min(len(ids), at + (1 << 20))
                for step in range(1, REACH + 1):
                    a, b = ids[at : min(end, len(ids) - step)], ids[at + step : end + step]
                    same = document[at : at + len(b)] == document[at + step : at + step + len(b)]
                    a, b = a[: len(b)][same], b[same]
                    for one, other in ((a, b), (b, a)):
                        for k in range(MARKS):
                            sums += np.bincount(one * SIZE + places[other, k], signs[other, k], BUCKETS * SIZE)
    table = np.concatenate((sums.reshape(BUCKETS, SIZE), counts[:, None]), axis=1)
    chunks = [table[i : i + CHUNK] for i in range(0, BUCKETS, CHUNK)]
    used = [i for i, c in enumerate(chunks) if c.any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array([chunks[i].astype(np.float32).tobytes() for i in used], pa.binary())], names=["chunk", "sums"]
    )


def _summed(kind: type):
    """Adds the tables of a group, which are of this kind of number, into one of doubles."""

    def work(key: tuple, frames: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK * (SIZE + 1))
        for b in frames["sums"]:
            total += np.frombuffer(b, kind)
        return pd.DataFrame({"chunk": [key[0]], "sums": [total.tobytes()]})

    return work


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """Unit vectors of all buckets, from every text of ``df``. Their size is fixed: buckets times size.

    The tables of tasks are added in two levels, first those of ``TASKS`` tasks that follow each
    other, so a group holds 68 MB of them and the second level a row for each ``TASKS`` tasks.
    """
    tasks = df.select(F.col(text)).mapInArrow(_contexts, "chunk int, sums binary")
    tasks = tasks.withColumn("part", F.floor(F.spark_partition_id() / TASKS))
    parts = tasks.groupBy("chunk", "part").applyInPandas(_summed(np.float32), "chunk int, sums binary")
    rows = parts.groupBy("chunk").applyInPandas(_summed(np.float64), "chunk int, sums binary").collect()
    table = np.zeros((BUCKETS, SIZE + 1))
    for r in rows:
        table[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["sums"], np.float64).reshape(-1, SIZE + 1)
    vectors = table[:, :SIZE]
    mean = vectors.sum(axis=0) / max(1.0, table[:, SIZE].sum())
    vectors = vectors - table[:, SIZE:] * mean  # what every word has around it tells nothing
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(texts: list, vectors: np.ndarray) -> np.ndarray:
    """The mean of the word vectors of each text, and the mean of their sizes in each direction."""
    out = np.zeros((len(texts), 2 * SIZE), np.float32)
    for i, t in enumerate(texts):
        ids = words(t or "")
        for at in range(0, len(ids), 1 << 16):
            part = vectors[ids[at : at + (1 << 16)]]
            out[i, :SIZE] += part.sum(axis=0)
            out[i, SIZE:] += np.abs(part).sum(axis=0)
        out[i] /= max(1, len(ids))
    return out


@dataclass
class Network:
    """Two layers over standardised inputs, and the temperature of its chances."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    heat: float = 1.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def chance(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x) / self.heat)


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 120, rate: float = 3e-3, decay: float = 1e-3, seed: int = 5) -> Network:
    """Adam on the log loss of four fifths of the rows; the temperature from the others."""
    rng = np.random.default_rng(seed)
    apart = rng.random(len(y)) < 0.2
    if min(y[~apart].sum(), (1 - y[~apart]).sum()) < 2:  # nothing to tell apart
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        n = 2 * SIZE
        return Network(np.zeros(n), np.ones(n), np.zeros((n, hidden)), np.zeros(hidden), np.zeros(hidden), float(np.log(share / (1 - share))))
    mean, scale = x[~apart].mean(axis=0), x[~apart].std(axis=0) + 1e-6
    u, t = (x[~apart] - mean) / scale, y[~apart]
    p = [rng.normal(0, u.shape[1] ** -0.5, (u.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        order = rng.permutation(len(t))
        for at in range(0, len(t), 64):
            rows = order[at : at + 64]
            h = np.tanh(u[rows] @ p[0] + p[1])
            d = (sigmoid(h @ p[2] + p[3]) - t[rows]) / len(rows)
            dh = d[:, None] * p[2] * (1 - h**2)
            grads = [u[rows].T @ dh + decay * p[0], dh.sum(axis=0), h.T @ d + decay * p[2], np.array([d.sum()])]
            step += 1
            for a, g, mm, vv in zip(p, grads, m, v):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                a -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    net.heat = temperature(net.margin(x[apart]), y[apart])
    return net


def classify(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    split: tuple[int, int] = (4, 2),
    most: int = 4000,
    threshold: float = 0.7,
) -> DataFrame:
    """The key, ``held_out``, ``score`` and ``predicted`` for every row of ``df``.

    Word vectors come from all texts. The network is fitted on at most ``most`` labelled documents
    that are not held out; nothing but the text is an input. A null text counts as empty, and an
    empty text has the score of the zero vector. Without labels of both kinds every score is the
    share of the one there is, or one half. Rows repeat as in ``df``; other columns are not read.
    """
    vectors = word_vectors(df, text)
    chosen = per_text(sample(df, labels, label, split, most, key, text), "text", ("key", "y"), {"x": BinaryType()}, _features(vectors))
    rows = sorted((r["key"], r["y"], bytes(r["x"])) for r in chosen.collect())
    x = np.array([np.frombuffer(r[2], np.float32) for r in rows], np.float64).reshape(len(rows), 2 * SIZE)
    net = train(x, np.array([r[1] for r in rows], float))

    def work():
        return lambda texts: {"score": net.chance(pooled(texts, vectors).astype(np.float64))}

    scored = per_text(df, text, (key,), {"score": DoubleType()}, work)
    return scored.select(key, held_out(key, *split).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _features(vectors: np.ndarray):
    return lambda: lambda texts: {"x": [row.tobytes() for row in pooled(texts, vectors)]}

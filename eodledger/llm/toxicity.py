"""Toxicity of texts: a recurrent network over overlapping windows, trained and run in numpy.

A word's input is a vector of the word and one of its pieces of three and four characters. A gated
recurrent layer reads a window in both directions, attention pools its states, and a logistic unit
scores the window; a text has the score of its highest window.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from eodledger.llm.boosting import sigmoid
from eodledger.llm.common import per_text
from eodledger.llm.labelled import held_out, sample

WINDOW, STRIDE = 24, 12
WORDS, PIECES, INPUT, STATE, ATTEND = 8192, 16384, 12, 8, 8
TOKEN = re.compile(r"\w+")
#: Windows that go through the network together.
TOGETHER = 4096
REMEMBERED = 400_000


def word_parts(word: str) -> tuple[int, np.ndarray]:
    """Bucket of a word, and buckets of its pieces of three and four characters, ends marked."""
    marked = f"<{word}>"
    pieces = {marked[i : i + n] for n in (3, 4) for i in range(max(1, len(marked) - n + 1))}
    return zlib.crc32(word.encode()) % WORDS, np.array(sorted(zlib.crc32(x.encode(), 1) % PIECES for x in pieces))


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def windows(n: int) -> np.ndarray:
    """First words of the windows over n words: each half a window on, until all words are covered."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n > WINDOW else np.zeros(1, np.int64)


@dataclass
class Params:
    word: np.ndarray
    piece: np.ndarray
    x: np.ndarray  # inputs to gates, both directions: [2 * INPUT, 2, 3 * STATE]
    bias: np.ndarray  # [2, 3 * STATE]
    u: np.ndarray  # states to gates: [2, STATE, 3 * STATE]
    attend: np.ndarray  # [2 * STATE, ATTEND]
    attend_bias: np.ndarray
    look: np.ndarray  # [ATTEND]
    out: np.ndarray  # [2 * STATE]
    shift: np.ndarray  # [1]

    def all(self) -> list[np.ndarray]:
        return list(self.__dict__.values())


def start(seed: int = 3) -> Params:
    r = np.random.default_rng(seed).normal
    return Params(
        r(0, 0.05, (WORDS, INPUT)), r(0, 0.05, (PIECES, INPUT)), r(0, 0.3, (2 * INPUT, 2, 3 * STATE)), np.zeros((2, 3 * STATE)),
        r(0, 0.3, (2, STATE, 3 * STATE)), r(0, 0.4, (2 * STATE, ATTEND)), np.zeros(ATTEND), r(0, 0.5, ATTEND), r(0, 0.5, 2 * STATE), np.full(1, -1.0),
    )


def word_input(p: Params, word: str) -> np.ndarray:
    w, pieces = word_parts(word)
    return np.concatenate((p.word[w], p.piece[pieces].sum(axis=0) / len(pieces) ** 0.5))


def _run(gates: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: bool):
    """States of one direction. gates: [windows, steps, 3 * STATE]; what backpropagation needs, if wanted."""
    n, steps, _ = gates.shape
    h = np.zeros((n, STATE), gates.dtype)
    states, kept = np.empty((n, steps, STATE), gates.dtype), []
    for t in range(steps):
        g = gates[:, t]
        zr = sigmoid(g[:, : 2 * STATE] + h @ u[:, : 2 * STATE])
        z, r = zr[:, :STATE], zr[:, STATE:]
        c = np.tanh(g[:, 2 * STATE :] + (r * h) @ u[:, 2 * STATE :])
        m = mask[:, t, None]
        new = h + m * (1 - z) * (c - h)
        if keep:
            kept.append((h, z, r, c, m))
        h = new
        states[:, t] = h
    return states, kept


def _back(d_states: np.ndarray, kept: list, u: np.ndarray):
    """Gradients of the gates and of ``u`` from those of the states."""
    n, steps, _ = d_states.shape
    d_gates, d_u = np.zeros((n, steps, 3 * STATE)), np.zeros_like(u)
    d_h = np.zeros((n, STATE))
    for t in reversed(range(steps)):
        h, z, r, c, m = kept[t]
        d = d_h + d_states[:, t]
        d_c = d * m * (1 - z) * (1 - c**2)
        d_z = -d * m * (c - h) * z * (1 - z)
        d_rh = d_c @ u[:, 2 * STATE :].T
        d_r = d_rh * h * r * (1 - r)
        d_zr = np.concatenate((d_z, d_r), axis=1)
        d_h = d * (1 - m * (1 - z)) + d_rh * r + d_zr @ u[:, : 2 * STATE].T
        d_u[:, : 2 * STATE] += h.T @ d_zr
        d_u[:, 2 * STATE :] += (r * h).T @ d_c
        d_gates[:, t, : 2 * STATE], d_gates[:, t, 2 * STATE :] = d_zr, d_c
    return d_gates, d_u


def forward(p: Params, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Log odds of windows. gates: [windows, steps, 2, 3 * STATE]; the second direction reads backwards."""
    ahead, kept_a = _run(gates[:, :, 0], mask, p.u[0], keep)
    behind, kept_b = _run(gates[:, ::-1, 1], mask[:, ::-1], p.u[1], keep)
    h = np.concatenate((ahead, behind[:, ::-1]), axis=2)
    a = np.tanh(h @ p.attend + p.attend_bias)
    e = np.where(mask > 0, a @ p.look, -1e9)
    e = np.exp(e - e.max(axis=1, keepdims=True)) * mask
    alpha = e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
    c = (alpha[:, :, None] * h).sum(axis=1)
    return c @ p.out + p.shift[0], (h, a, alpha, c, kept_a, kept_b)


def backward(p: Params, d: np.ndarray, mask: np.ndarray, kept: tuple):
    """Gradients of the gates and of the parameters above the inputs, from those of the log odds."""
    h, a, alpha, c, kept_a, kept_b = kept
    g = {"out": c.T @ d, "shift": np.array([d.sum()])}
    d_c = d[:, None] * p.out
    d_alpha = (h * d_c[:, None, :]).sum(axis=2)
    d_h = alpha[:, :, None] * d_c[:, None, :]
    d_e = alpha * (d_alpha - (alpha * d_alpha).sum(axis=1, keepdims=True))
    g["look"] = np.einsum("nt,ntk->k", d_e, a)
    d_a = d_e[:, :, None] * p.look * (1 - a**2)
    g["attend"], g["attend_bias"] = np.einsum("nth,ntk->hk", h, d_a), d_a.sum(axis=(0, 1))
    d_h += d_a @ p.attend.T
    ga, ua = _back(d_h[:, :, :STATE], kept_a, p.u[0])
    gb, ub = _back(d_h[:, ::-1, STATE:], kept_b, p.u[1])
    g["u"] = np.stack((ua, ub))
    return np.stack((ga, gb[:, ::-1]), axis=2), g


class Texts:
    """Labelled texts as windows over a table of their distinct words."""

    def __init__(self, texts: list[str]):
        index: dict[str, int] = {"": 0}
        rows, owner = [], []
        for k, text in enumerate(texts):
            ids = np.array([index.setdefault(w, len(index)) for w in tokens(text)], np.int64)
            for s in windows(len(ids)):
                row = ids[s : s + WINDOW]
                rows.append(np.pad(row, (0, WINDOW - len(row))))
                owner.append(k)
        self.rows, self.owner = np.array(rows, np.int64).reshape(-1, WINDOW), np.array(owner, np.int64)
        self.mask = (self.rows > 0).astype(float)
        parts = [word_parts(w) for w in index]
        self.bucket = np.array([b for b, _ in parts])
        self.size = np.array([len(x) for _, x in parts])
        self.start = np.cumsum(self.size) - self.size
        self.pieces = np.concatenate([x for _, x in parts])

    def pieces_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of some words, one word after the other, and where each word's begin."""
        size = self.size[words]
        begin = np.cumsum(size) - size
        return self.pieces[np.repeat(self.start[words] - begin, size) + np.arange(size.sum())], begin

    def inputs(self, p: Params, words: np.ndarray) -> np.ndarray:
        pieces, begin = self.pieces_of(words)
        chars = np.add.reduceat(p.piece[pieces], begin, axis=0) / np.sqrt(self.size[words])[:, None]
        return np.concatenate((p.word[self.bucket[words]], chars.astype(p.word.dtype)), axis=1)

    def scores(self, p: Params) -> np.ndarray:
        """Log odds of all windows."""
        p = Params(*[v.astype(np.float32) for v in p.all()])
        words = np.array_split(np.arange(len(self.bucket)), 1 + len(self.bucket) // 20_000)
        table = np.concatenate([np.tensordot(self.inputs(p, w), p.x, 1) + p.bias for w in words]).astype(np.float32)
        return np.concatenate(
            [forward(p, table[self.rows[i : i + TOGETHER]], self.mask[i : i + TOGETHER].astype(np.float32))[0] for i in range(0, len(self.rows), TOGETHER)]
        )


def _best(owner: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The highest window of each text."""
    order = np.lexsort((score, owner))
    return order[np.nonzero(np.diff(owner[order], append=-1))[0]]


def _suspicion(t: Texts, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A first score of the windows: the largest log odds, by texts, of a word or a piece of one; these odds."""
    n = len(t.bucket)
    pairs = np.unique(np.repeat(t.owner, WINDOW) * n + t.rows.ravel())
    text, word = pairs // n, pairs % n

    def odds(text: np.ndarray, item: np.ndarray, items: int) -> np.ndarray:
        pairs = np.unique(text * items + item)
        of, item = y[pairs // items], pairs % items
        toxic, clean = np.bincount(item, of, items), np.bincount(item, 1 - of, items)
        found = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / ((1 - y).sum() + 1))
        return found * np.minimum(1, (toxic + clean) / 8)

    of_word = odds(text, word, n)
    of_piece = odds(np.repeat(text, t.size[word]), t.pieces_of(word)[0], PIECES)
    best = np.maximum(of_word, np.maximum.reduceat(of_piece[t.pieces], t.start))
    best[0] = -9
    return best[t.rows].max(axis=1), of_word, of_piece


@dataclass
class Model:
    params: Params | None
    slope: float = 1.0
    shift: float = 0.0

    def chance(self, odds: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * odds + self.shift)


def fit(texts: list[str], y: np.ndarray, rounds: int = 5, rate: float = 0.01, seed: int = 3) -> Model:
    """Rounds over the window of each text that scores highest so far, and over some others.

    A label is of a text, and one window is enough to earn it, so the highest window stands for its
    text; for a text of the other class it is the hardest example. The first windows are chosen by
    the words' log odds. The last quarter of the texts is kept apart to fit the chances of texts.
    """
    kept = distinct(texts, y)
    texts, y = [texts[i] for i in kept], y[kept]
    if len(y) < 8 or min(y.sum(), (1 - y).sum()) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
        return Model(None, 1.0, float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    train = np.arange(len(y)) % 4 != 3
    if min(y[train].sum(), (1 - y[train]).sum()) < 1:
        train[:] = True
    t, yt = Texts([x for x, k in zip(texts, train) if k]), y[train]
    p = start(seed)
    names = list(p.__dict__)
    first = {k: np.zeros_like(v) for k, v in p.__dict__.items()}
    second = {k: np.zeros_like(v) for k, v in p.__dict__.items()}
    step, (score, of_word, of_piece) = 0, _suspicion(t, yt)
    p.word[t.bucket, 0] = 0.5 * np.clip(of_word, -4, 4)  # the inputs start from what is known already
    p.piece[:, 0] = 0.5 * np.clip(of_piece, -4, 4)
    for _ in range(rounds):
        top = _best(t.owner, score)
        toxic, clean = top[yt[t.owner[top]] > 0], top[yt[t.owner[top]] == 0]
        others = np.nonzero(yt[t.owner] == 0)[0]
        others = rng.choice(others, min(len(others), len(clean)), replace=False)
        toxic = np.tile(toxic, max(1, min(8, (len(clean) + len(others)) // (2 * len(toxic)))))
        chosen = rng.permutation(np.concatenate((toxic, clean, others)))
        for at in range(0, len(chosen), 128):
            rows = chosen[at : at + 128]
            words, where = np.unique(t.rows[rows], return_inverse=True)
            inputs = t.inputs(p, words)
            gates = (np.tensordot(inputs, p.x, 1) + p.bias)[where.reshape(len(rows), WINDOW)]
            mask = t.mask[rows]
            odds, kept = forward(p, gates, mask, True)
            d_gates, g = backward(p, (sigmoid(odds) - yt[t.owner[rows]]) / len(rows), mask, kept)
            d_table = np.zeros((len(words), 2, 3 * STATE))
            np.add.at(d_table, where.reshape(-1), d_gates.reshape(-1, 2, 3 * STATE))
            g["x"] = np.tensordot(inputs, d_table, ((0,), (0,)))
            g["bias"] = d_table.sum(axis=0)
            d_in = np.tensordot(d_table, p.x, ((1, 2), (1, 2)))
            g["word"], g["piece"] = np.zeros_like(p.word), np.zeros_like(p.piece)
            np.add.at(g["word"], t.bucket[words], d_in[:, :INPUT])
            size = t.size[words]
            np.add.at(g["piece"], t.pieces_of(words)[0], np.repeat(d_in[:, INPUT:] / np.sqrt(size)[:, None], size, axis=0))
            step += 1
            for k in names:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] ** 2 - second[k])
                value = getattr(p, k)
                value -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
        score = t.scores(p)
    apart = Texts([x for x, k in zip(texts, ~train if not train.all() else train) if k])
    odds = apart.scores(p)
    return Model(p, *_chances(odds[_best(apart.owner, odds)], y[~train] if not train.all() else y))


def _chances(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """The slope and shift that fit chances of texts to their log odds best, among bounded ones."""
    slope, shift = (g.ravel()[:, None] for g in np.meshgrid(np.geomspace(0.2, 2, 16), np.linspace(-6, 6, 49)))
    q = sigmoid(slope * np.clip(odds, -20, 20) + shift).clip(0.01, 0.99)
    loss = -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean(axis=1) + 1e-4 * shift[:, 0] ** 2
    return float(slope[loss.argmin(), 0]), float(shift[loss.argmin(), 0])


def distinct(texts: list[str], y: np.ndarray) -> list[int]:
    """The first of each group of equal texts with equal labels: a copied label is one label."""
    seen: dict[tuple, int] = {}
    for i, text in enumerate(texts):
        seen.setdefault((text, float(y[i])), i)
    return sorted(seen.values())


class Scorer:
    """Log odds of whole texts; the gate inputs of words seen before are remembered."""

    def __init__(self, model: Model):
        self.p = Params(*[v.astype(np.float32) for v in model.params.all()])
        # Directions ahead, so that each has its gates side by side.
        self.table = np.zeros((0, 2, 3 * STATE), np.float32)
        self.index: dict[str, int] = {}
        self._learn([""])

    def _learn(self, words: list[str]) -> None:
        """Rows of the gate inputs for new words."""
        parts = [word_parts(w) for w in words]
        ends = np.cumsum([len(x) for _, x in parts])
        chars = np.add.reduceat(self.p.piece[np.concatenate([x for _, x in parts])], np.concatenate(([0], ends[:-1])), axis=0)
        chars /= np.sqrt(np.diff(ends, prepend=0))[:, None]
        inputs = np.concatenate((self.p.word[[b for b, _ in parts]], chars), axis=1)
        new = (np.tensordot(inputs, self.p.x, 1) + self.p.bias).astype(np.float32)
        n = len(self.index)
        if n + len(words) > len(self.table):
            self.table = np.concatenate((self.table[:n], np.zeros((max(1024, n, len(words)), 2, 3 * STATE), np.float32)))
        self.table[n : n + len(words)] = new
        self.index.update(zip(words, range(n, n + len(words))))

    def odds(self, texts: list) -> np.ndarray:
        if len(self.index) > REMEMBERED:
            self.index = {}
            self._learn([""])
        out, rows, owner, held = np.full(len(texts), -np.inf, np.float32), [], [], 0

        def flush() -> None:
            nonlocal rows, owner, held
            if not rows:
                return
            ids = np.concatenate(rows)
            at = np.concatenate(owner)
            for i in range(0, len(ids), TOGETHER):
                part = ids[i : i + TOGETHER]
                mask = (part > 0).astype(np.float32)
                np.maximum.at(out, at[i : i + TOGETHER], forward(self.p, self.table[part], mask)[0])
            rows, owner, held = [], [], 0

        for k, text in enumerate(texts):
            words, index = tokens(text or ""), self.index
            found = [index.get(w) for w in words]
            if None in found:
                self._learn(list(dict.fromkeys(w for w, i in zip(words, found) if i is None)))
                found = [index[w] for w in words]
            first = windows(len(found))
            padded = np.zeros(first[-1] + WINDOW, np.int64)
            padded[: len(found)] = found
            rows.append(padded[first[:, None] + np.arange(WINDOW)])
            owner.append(np.full(len(first), k))
            held += len(first)
            if held >= 4 * TOGETHER:
                flush()
        flush()
        return out


def score(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    split: tuple[int, int] = (5, 0),
    most: int = 3000,
) -> DataFrame:
    """The key, ``held_out``, ``score`` and ``predicted`` for every row of ``df``.

    The network is fitted on at most ``most`` labelled documents that are not held out; nothing but
    the text is an input. Every whole text is scored in windows of 24 words, each half a window
    on from the last. A null text counts as empty; an empty text is a window without words. Without
    labels of both kinds every score is the share of the one there is, or one half. Rows repeat as
    in ``df``; other columns are not read.
    """
    rows = sorted((r["key"], r["y"], r["text"]) for r in sample(df, labels, label, split, most, key, text).collect())
    model = fit([r[2] for r in rows], np.array([r[1] for r in rows], float))

    def work():
        if model.params is None:
            return lambda texts: {"score": model.chance(np.zeros(len(texts)))}
        scorer = Scorer(model)
        return lambda texts: {"score": model.chance(scorer.odds(texts))}

    found = per_text(df, text, (key,), {"score": DoubleType()}, work)
    return found.select(key, held_out(key, *split).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Phrases against plain counting, over short blocks, few words at a time, and a bitmap without use."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import DATA

from eodledger.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, shadow=50, top=2000):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        gone = {p[i : i + 2] for p, n in frequent.items() if len(p) == 3 for i in (0, 1) if 100 * n >= shadow * f[p[i : i + 2]]}
        best = []
        for p, a in frequent.items():
            if p not in gone:
                score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def ours(frame, **how):
    return sorted(tuple(r) for r in collocations.collocations(frame, **how).collect())


AWKWARD = [
    (None, "en"),
    ("", None),
    (" \t\n", "en"),
    ("A b\tc. A b c; A  B", None),
    ("one two three four " * 4000, "en"),
    ("w" * 30000 + " x", "en"),
    ("x\x01y Ünï É é 日本語 。 x\x85y x y", "de"),
    *[("the cat sat on the mat, the cat sat", "fr")] * 12,
    *[("the dog\x0bthe dog the cat", "fr")] * 12,
    *[("Same same same same", None)] * 5,
    *[("same Same same same", "und")] * 5,
]


@pytest.fixture
def awkward(spark):
    ddl = "text string, lang string, w1 string, n int, size int, one int, phrase string, __block int"
    return spark.createDataFrame([(*r, "p", 1, 2, 3, "q", 4) for r in AWKWARD], ddl)


def test_awkward_rows(awkward):
    assert ours(awkward) == brute(AWKWARD)
    assert ours(awkward.limit(0)) == []


def test_cuts_shadows_and_ranks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK", 3)
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    frame = spark.createDataFrame(rows, "text string, lang string")
    for how in ({}, {"least": 3, "shadow": 80, "top": 50}, {"least": 1, "top": 10}):
        assert ours(frame, **how) == brute(rows, **how)


def test_few_words_at_a_time_and_a_full_bitmap(spark, awkward, monkeypatch):
    want = sorted(map(str, collocations.counts(awkward).collect()))
    assert sorted(map(str, collocations.counts(awkward, held=7).collect())) == want
    monkeypatch.setattr(collocations, "frequent_pairs", lambda pairs: np.full(1 << (collocations.BITMAP - 3), 255, np.uint8))
    assert sorted(map(str, collocations.counts(awkward).collect())) == want


def test_scores_beyond_64_bits(spark):
    a, left, right = 9 * 10**14 + 1, 9 * 10**14 + 7, 9 * 10**14 + 11
    got = spark.range(1).selectExpr(f"{a}L AS a", f"{left}L AS l", f"{right}L AS r").select(collocations.score("a", "l", "r")).first()[0]
    assert got == 1000000 * a * a // (left * right)

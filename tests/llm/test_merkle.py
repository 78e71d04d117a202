"""The manifest against a plain tree, on sizes around the arity and on awkward rows."""

import hashlib
import zlib

import pytest

from eodledger.llm import merkle, queries

FIELDS = queries.LEAF
DDL = "doc_id long, source string, lang string, n_chars long, text string, path string, leaf int, idx long, tree int, `key` string, h int, kids int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(nodes):
    """The hash on top, and for each node its siblings step by step."""
    steps, groups, level = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
    while len(level) > 1:
        ups, members = [], []
        for at in range(0, len(level), 8):
            run = level[at : at + 8]
            for j in range(len(run)):
                for i in groups[at + j]:
                    steps[i].append((run[:j], run[j + 1 :]))
            ups.append(h(*run))
            members.append([i for g in groups[at : at + 8] for i in g])
        level, groups = ups, members
    return level[0], steps


def brute(rows):
    trees = {}
    for lang in sorted({r[2] for r in rows}, key=lambda g: (g is not None, (g or "").encode())):
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, *grow([leaf(r) for r in own])
    root, tops = grow([t[1] for t in trees.values()])
    out = []
    for (own, subroot, steps), top in zip(trees.values(), tops):
        for r, step in zip(own, steps):
            path = step + top
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            text = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            folded = leaf((*r[:4], text)) if hit else leaf(r)
            for left, right in path:
                folded = h(*left, folded, *right)
            proof = h(*(x for left, right in path for x in left + right))
            out.append((r[0], leaf(r), subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def ours(frame):
    return sorted((tuple(r) for r in merkle.verified(frame, FIELDS).collect()), key=str)


AWKWARD = [
    (1, None, None, None, None),
    (None, "s", None, 3, "No key"),
    (None, "s", "und", 3, "No key"),
    (2, "", "de", 0, ""),
    (4, "b", "é", 3, "One"),
    (4, "b", "é", 3, "One"),
    (4, "a", "é", 3, "Two"),
    (5, "c", "zz", 10, "Long Text " * 20000),
    (6, "c", "zz", 10, "日本語 ÜNÏ 😀\n"),
    *[(7, "hot", "fr", 1, "Same")] * 70,
    *[(i, "x", "en", i, f"Text {i}") for i in range(100, 1000, 3)],
]


def test_awkward_rows(spark):
    frame = spark.createDataFrame([(*r, "p", 1, 2, 3, "k", 4, 5) for r in AWKWARD], DDL)
    assert ours(frame) == brute(AWKWARD)
    assert ours(frame.limit(0)) == []


@pytest.mark.parametrize("n", [1, 8, 9, 513])
def test_one_group(spark, n):
    rows = [(3 * i, "s", "l", i, f"Row {i}") for i in range(n)]
    found = ours(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))
    assert found == brute(rows)
    assert all(r[6] == (zlib.crc32(str(r[0]).encode()) % 3 != 0) for r in found)


def test_ancestors_that_are_moved_instead_of_sent(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", -1)
    rows = [(i, "s", f"g{i % 11}", i, f"Row {i}") for i in range(700)]
    assert ours(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")) == brute(rows)


def test_paths_are_real_outputs(spark):
    frame = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "doc_id long, text string").selectExpr("*", "'a' AS lang")
    for r in merkle.proofs(frame, ("doc_id", "text")).collect():
        folded = r.leaf
        for left, right in r.path:
            folded = h(*(bytes(x).hex() for x in left), folded, *(bytes(x).hex() for x in right))
        assert folded == r.root == r.subroot

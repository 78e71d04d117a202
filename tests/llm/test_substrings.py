"""Passages of earlier documents against all windows, one by one."""

import hashlib
import random

from eodledger.llm import substrings


def brute(rows):
    first = {}
    texts = [(k, (t or "").encode().split()) for k, t in rows]
    for key, words in texts:
        for i in range(len(words) - 12) if key is not None else ():
            w = tuple(words[i : i + 13])
            first[w] = min(first.get(w, key), key)
    out = []
    for key, words in texts:
        gone = set()
        for i in range(len(words) - 12) if key is not None else ():
            if first[tuple(words[i : i + 13])] < key:
                gone.update(range(i, i + 13))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((key, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ours(frame):
    return sorted((tuple(r) for r in substrings.without_repeats(frame, digest=True).collect()), key=str)


def test_a_cover_has_every_difference():
    cover = set(substrings.COVER)
    assert {(a - b) % substrings.PERIOD for a in cover for b in cover} == set(range(substrings.PERIOD))
    assert substrings.ANCHOR + substrings.PERIOD - 1 == substrings.WINDOW


def test_planted_passages(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(300)}"
    passages = [[word() for _ in range(n)] for n in (12, 13, 14, 19, 26, 60, 400)]
    rows = []
    for i in range(240):
        words = [word() for _ in range(rng.randrange(0, 60))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = p if rng.random() < 0.7 else p[rng.randrange(len(p)) :]
        rows.append((i if i % 7 else i // 2, rng.choice((" ", "\n", "\t  ")).join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert ours(frame) == want and sum(r[2] for r in want) > 5000
    assert ours(frame.repartition(1)) == ours(frame.repartition(40)) == want


LONG = " ".join(f"v{i % 5000}" for i in range(60000))
COPY = "this is a line of just thirteen words that many other documents hold too"
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b"),
    (4, COPY),
    (4, COPY),
    (4, "before " + COPY),
    (None, COPY),
    (None, COPY + " after"),
    (5, "x " * 500),
    (6, "y " * 12 + "x " * 13),
    (7, LONG),
    (8, LONG + " end"),
    (9, "w" * 30000 + " " + COPY.replace(" ", "\x0c")),
    (10, "日本語 Ünï\x85code " * 20),
    (-11, "Ünï\x85code 日本語 " * 20),
    *[(i, "intro %d " % i + COPY) for i in range(100, 400)],
]


def test_awkward_rows(spark):
    ddl = "doc_id long, text string, rid int, a int, hashes int, `key` int, n_words int, kept string"
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, "k") for r in AWKWARD], ddl)
    assert ours(frame) == brute(AWKWARD)
    assert ours(frame.limit(0)) == []
    kept = {r.doc_id: r.kept for r in substrings.without_repeats(frame).collect() if (r.doc_id or 0) >= 100}
    assert kept == {i: f"intro {i}" for i in range(100, 400)}

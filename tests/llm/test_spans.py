"""Places taken in a text against plain comparison, and texts full of spans."""

import random
import time

from eodledger.llm import pii, queries, secrets
from eodledger.llm.spans import Taken


def test_taken_as_all_comparisons():
    rng = random.Random(8)
    for _ in range(300):
        places = [(s, s + rng.randrange(1, 9)) for s in (rng.randrange(60) for _ in range(rng.randrange(9)))]
        taken = Taken(places)
        for start in range(62):
            for end in range(start + 1, start + 6):
                assert taken.apart(start, end) == all(end <= s or start >= e for s, e in places)
                covered = {i for s, e in taken.within(start, end) for i in range(s, e)}
                assert covered & set(range(start, end)) == {i for s, e in places for i in range(max(s, start), min(e, end))}
        for _ in range(20):
            start = rng.randrange(60)
            if taken.apart(start, start + 3):
                taken.add(start, start + 3)
                places.append((start, start + 3))
        assert all(taken.apart(i, i + 1) == all(i + 1 <= s or i >= e for s, e in places) for i in range(70))


def test_long_lists_take_linear_time():
    rng = random.Random(9)
    sums = "".join(f"{rng.getrandbits(256):064x}  dist/file-{i}.tar.gz\n" for i in range(40_000))
    contacts = "".join(f"name {i} <n{i}@example.com> +1 (234) 555-{i % 10000:04}\n" for i in range(20_000))
    encoding = secrets.ranks(queries.RANKS, queries.PATTERN)
    start = time.time()
    assert len(secrets.find(sums, encoding)[0]) == 40_000
    assert sum(s[0] == "email" for s in pii.find(contacts, pii.Selector(None))[0]) == 20_000
    assert time.time() - start < 60

"""The schedule of the mix for any number of sources, against earliest deadline first with a heap."""

import heapq
import random

import pytest

from eodledger.llm import mixing


def brute(weights):
    """The source of each slot of a period: of the released blocks the one that is due first."""
    total, out, ready = sum(weights), [], []
    wait = [(0, i, 0) for i in range(len(weights))]
    for slot in range(total):
        while wait and wait[0][0] <= slot:
            _, i, k = heapq.heappop(wait)
            heapq.heappush(ready, (-(-(k + 1) * total // weights[i]), i, k))
        due, i, k = heapq.heappop(ready)
        assert due > slot
        out.append(i)
        heapq.heappush(wait, ((k + 1) * total // weights[i], i, k + 1))
    return out


def scheduled(spark, weights, pooled):
    frame = spark.createDataFrame([(f"s{i:07}", w, 1000) for i, w in enumerate(weights)], "source string, w long, total long")
    slots = {slot: int(r.source[1:]) for r in mixing.schedule(frame, pooled=pooled).collect() for slot in r.plan}
    return [slots.get(t) for t in range(sum(weights))]


def many():
    weights = [1] * 100_000
    for i, w in ((3, 7), (5, 60), (70_000, 30), (99_999, 200)):
        weights[i] = w
    return weights


@pytest.mark.parametrize(
    "weights, pooled",
    [([5, 4, 1], 7), ([2] * 5, 2), ([2, 3, 2, 7, 2], 2), ([4] * 9 + [1, 1, 3], 4), ([1] * 3000 + [300, 2, 5], 1), (many(), 1)],
    ids=["no pool", "pool only", "turns of two", "lighter than the pool", "one heavy source", "100,000 sources"],
)
def test_schedule_is_earliest_deadline_first(spark, weights, pooled):
    assert scheduled(spark, weights, pooled) == brute(weights)


def test_schedule_of_random_weights(spark):
    rng = random.Random(3)
    for _ in range(12):
        weights = [rng.choice((rng.randrange(1, 9), 3, 1)) for _ in range(rng.randrange(1, 30))]
        assert scheduled(spark, weights, rng.choice((1, 2, 3))) == brute(weights)


def test_many_unnamed_sources_lose_no_row(spark):
    docs = spark.range(30_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'a', IF(id % 7 = 0, NULL, concat('host', id % 6000))) AS source")
    found = mixing.positions(docs, {"a": 40, "absent": 5}, block=2)
    rows = found.select("doc_id", "source", f"{found.columns[-1]}.*").toPandas()
    assert len(rows) == 30_000 and rows.doc_id.is_unique and rows.position.is_unique
    first = rows[rows.in_mix]
    period = rows.source.nunique() + 1 + 39
    used = first.drop_duplicates("slot")
    assert sorted(used.slot) == list(range(len(used)))
    assert abs((used.source == "a").sum() - len(used) * 40 / period) < 1


def test_weights_outside_their_bounds(spark):
    docs = spark.range(3).selectExpr("id AS doc_id", "'a' AS source")
    for weights, default in (({"a": 0}, 1), ({"a": 5000}, 1), ({}, 0)):
        with pytest.raises(ValueError):
            mixing.positions(docs, weights, default)

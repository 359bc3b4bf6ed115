"""Models that learn from all labels, however many."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexbrook.llm import simhash, toxicity


def test_toxicity_learns_from_all_labels(spark):
    n = 61_000
    toxic = F.col("id") % 4 == 0
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.when(toxic, "scum ").otherwise("friend "), F.format_string("w%d", "id")).alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), toxic.cast("int").alias("toxic"))
    model = toxicity.train(docs, labels)
    assert model["weights"]["scum"] == math.log((n / 4 + 0.5) / (n / 4 + 1)) - math.log(0.5 / (n * 3 / 4 + 1))
    assert model == toxicity.train(docs, labels, most_sent=0)


def crowded(rng, places: int, rows: int, near: int):
    """Places of random planes, each with so many pairs that differ in one bit."""
    place = np.repeat(np.arange(places), rows)
    planes = [rng.integers(0, 1 << 63, places * rows, np.uint64) for _ in range(2)]
    for k in range(places):
        for i in range(near):
            a, b = k * rows + 2 * i, k * rows + 2 * i + rows // 2
            planes[0][b], planes[1][b] = planes[0][a] ^ np.uint64(1 << i), planes[1][a]
    return place, planes


def test_pairs_of_a_place_are_compared_once(monkeypatch):
    """a place with one pair of near copies costs little more than one without any."""
    place, planes = crowded(np.random.default_rng(3), 20, 400, 1)
    count, compared = np.bitwise_count, [0]

    def counted(x):
        compared[0] += x.size
        return count(x)

    monkeypatch.setattr(simhash.np, "bitwise_count", counted)
    found = list(simhash.linked(place, planes, np.arange(len(place)), 28))
    assert sum(len(a) for a, _ in found) == 20
    assert compared[0] < 1.5 * 2 * 20 * 400 * 399 / 2


@pytest.mark.parametrize("rows,near", [(1, 0), (2, 1), (5, 1), (40, 0), (60, 9), (300, 60)])
def test_groups_of_a_place_are_those_of_all_pairs(rows, near):
    rng = np.random.default_rng(rows)
    place, planes = crowded(rng, 7, rows, near)
    keep = np.sort(rng.choice(len(place), max(1, len(place) * 4 // 5), replace=False))  # places of different sizes
    place, planes, key = place[keep], [x[keep] for x in planes], keep
    want, got = np.arange(len(key)), np.arange(len(key))
    for i in range(len(key)):
        for j in range(i + 1, len(key)):
            if place[i] == place[j] and sum(int(x[i] ^ x[j]).bit_count() for x in planes) <= 28 and want[i] != want[j]:
                want[want == max(want[i], want[j])] = min(want[i], want[j])
    at = {k: i for i, k in enumerate(key.tolist())}
    for a, b in simhash.linked(place, planes, key, 28):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            i, j = got[at[x]], got[at[y]]
            assert i != j
            got[got == max(i, j)] = min(i, j)
    assert (want == got).all()

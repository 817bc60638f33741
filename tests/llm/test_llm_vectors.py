"""Vector codes and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiftlens.llm import hard_negatives, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, key string, vector string, error string, anchor string"
NAN, INF = float("nan"), float("inf")


def vectors(rng, n, size=8, steps=40):
    """Few different components, so that distances and scores tie."""
    return [[rng.randrange(-steps, steps) / 64 for _ in range(size)] for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(*r, None, "a", "b", None) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    found = [(i, v, rng.choice([None, 0, 1, 2])) for i, v in enumerate(vectors(rng, 300))]
    rng.shuffle(found)
    bad = [[0.0] * 7 + [x] for x in (None, NAN, INF, -INF)]
    found += [(1000 + i, v, 1) for i, v in enumerate([None, [], *bad])]
    found += [found[5], found[5], (None, found[6][1], 1), (2000, found[7][1], None), (-3, [0.0] * 8, 2), (-2, [-0.0] * 8, 2)]
    return found + [(3000 + i, [1 / 8] * 8, 0) for i in range(60)]


def steps(vector):
    if not vector or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def coded_by_force(rows, parts, entries, rounds):
    kept = sorted(((i is None, i or 0, steps(v)), i, label) for i, v, label in rows if steps(v))
    split = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    points = [split(k[0][2]) for k in kept]
    books = [[list(point[p]) for point in points[:entries]] for p in range(parts)]
    nearest = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            met = [nearest(p, point[p])[1] for point in points]
            new = []
            for k, old in enumerate(books[p]):
                own = [point[p] for point, m in zip(points, met, strict=True) if m == k]
                new.append([sum(c) // len(own) for c in zip(*own, strict=True)] if own else old)
            books[p] = new
    out = []
    for (_, i, label), point in zip(kept, points, strict=True):
        best = [nearest(p, point[p]) for p in range(parts)]
        out.append((i, label, bytes(k for _, k in best), sum(d for d, _ in best)))
    return sorted(out, key=repr), books


@pytest.mark.parametrize("shape", [vector_codes.Shape(4, 16, 2), vector_codes.Shape(8, 256, 1), vector_codes.Shape(1, 1, 3)])
def test_vector_codes_equal_brute_force(spark, rows, shape):
    coded, codebooks = vector_codes.compress(table(spark, rows), shape)
    want, books = coded_by_force(rows, shape.parts, shape.entries, shape.rounds)
    assert sorted(((r.key, r.label, bytes(r.code), r.error) for r in coded.collect()), key=repr) == want
    assert codebooks.tolist() == books


def test_orchard_search_finds_the_lowest_nearest_entry():
    rng = np.random.default_rng(0)
    for _ in range(40):
        entries = rng.integers(-6, 6, (rng.integers(1, 50), 3))
        parts = rng.integers(-9, 9, (200, 3))
        at, distance = vector_codes.Neighbours(entries).nearest(parts)
        every = ((parts[:, None] - entries[None]) ** 2).sum(-1)
        assert (at == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_vector_codes_of_no_rows_and_wrong_sizes(spark):
    coded, _ = vector_codes.compress(table(spark, [(1, None, 1), (2, [], 1)]))
    assert coded.count() == 0 and coded.columns == ["key", "label", "code", "error"]
    with pytest.raises(ValueError):
        vector_codes.compress(table(spark, [(1, [0.5] * 6, 1)]), vector_codes.Shape(4))


def mined_by_force(rows, every, positives=5, negatives=5, percent=80):
    kept = [(i, steps(v), label) for i, v, label in rows if i is not None and label is not None and steps(v)]
    out = []
    for i, x, label in {(i, tuple(x), label) for i, x, label in kept if i % every == 0}:
        score = lambda y: sum(a * b for a, b in zip(x, y, strict=True))  # noqa: E731, B023
        near = sorted((-score(y), j) for j, y, other in kept if other == label and j != i)[:positives]
        far = sorted((-score(y), j) for j, y, other in kept if other != label)
        for top, j in near:
            window = [(s, k) for s, k in far if percent * -top <= 100 * -s <= 100 * -top][:negatives]
            out += [(i, j, rank, k, -top, -s) for rank, (s, k) in enumerate(window, 1)]
    return sorted(out)


@pytest.mark.parametrize("every, shape", [
    (10, hard_negatives.Mining()), (3, hard_negatives.Mining(anchors_at_once=40, block_rows=16)), (7, hard_negatives.Mining(2, 9, 40)),
])
def test_hard_negatives_equal_brute_force(spark, rows, every, shape):
    got = hard_negatives.mine(table(spark, rows), F.col("vec_id") % every == 0, shape)
    want = mined_by_force(rows, every, shape.positives, shape.negatives, shape.least_percent)
    assert len(want) > 50 and sorted(tuple(r) for r in got.collect()) == want


def test_hard_negatives_of_few_rows(spark):
    mine = lambda rows: sorted(tuple(r) for r in hard_negatives.mine(table(spark, rows), F.col("vec_id") % 10 == 0).collect())
    assert mine([]) == []
    assert mine([(10, [0.5] * 4, 1)]) == []
    below = [(10, [0.5] * 4, 1), (11, [-0.5] * 4, 1), (12, [-0.5] * 4, 2)]  # a positive whose score is below zero has no window
    assert mine(below) == []
    ties = [(10, [1.0] * 4, 1), (15, [1.0] * 4, 1), *[(i, [1.0] * 4, 2) for i in range(40, 20, -1)]]
    assert [(r[2], r[3]) for r in mine(ties) if r[0] == 10] == [(1, 21), (2, 22), (3, 23), (4, 24), (5, 25)]


def test_postings_leave_no_pair_out():
    rng = np.random.default_rng(3)
    for _ in range(30):
        y = rng.integers(-300, 300, (80, 12)) * (rng.random((80, 12)) < 0.4)
        x = rng.integers(-300, 300, (9, 12))
        index = hard_negatives.Index(y)
        ordered = x[:, index.order].astype(float)
        scores = x @ y.T
        least = np.quantile(scores, rng.choice([0.2, 0.8, 0.99]), axis=1)
        i, j = index.reach(ordered, hard_negatives.remaining_norms(ordered), least)
        assert set(zip(*np.nonzero(scores >= least[:, None]), strict=True)) <= set(zip(i, j, strict=True))

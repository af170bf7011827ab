"""Hard negatives against plain loops over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gladwire.llm import negatives

SCHEMA = "vec_id long, label int, vector array<long>, anchor string, score long"
IS_ANCHOR = "vec_id % 10 = 0"


def plain(rows, positives=5, keep=5, low=80, high=100):
    rows = [r for r in rows if r[1] is not None and r[2] is not None and r[2] and None not in r[2]]
    behind = lambda i: (i is None, i or 0)
    out, seen = [], set()
    for a in rows:
        if a[0] is None or a[0] % 10 or (a[0], a[1], tuple(a[2])) in seen:
            continue
        seen.add((a[0], a[1], tuple(a[2])))
        scored = sorted(
            (-sum(x * y for x, y in zip(a[2], r[2], strict=True)), behind(r[0]), r[1], r[0])
            for r in rows if r[0] != a[0] and len(r[2]) == len(a[2])
        )
        for p, _, _, pid in [s for s in scored if s[2] == a[1]][:positives]:
            fits = [s for s in scored if s[2] != a[1] and low * -p <= 100 * -s[0] <= high * -p][:keep]
            out += [(a[0], pid, i + 1, s[3], -p, -s[0]) for i, s in enumerate(fits)]
    return sorted(out, key=repr)


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, negatives.mine(frame, F.expr(IS_ANCHOR)).collect()), key=repr)
    assert got == plain(rows)
    return got


def clustered(rng, n, size, labels=4):
    """Vectors of very different lengths around a few directions."""
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(6)]
    rows = []
    for i in range(n):
        c, long = rng.choice(centres), 10 ** rng.uniform(0, 3)
        rows.append((i, rng.randrange(labels), [round(long * (x + rng.gauss(0, 0.2))) for x in c]))
    return rows


def test_against_all_pairs(spark):
    assert check(spark, clustered(random.Random(1), 400, 12))


def test_small_blocks_of_anchors_and_many_ties(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    rng = random.Random(2)
    rows = [(i, rng.randrange(3), [rng.randint(-1, 1) for _ in range(4)]) for i in range(200)]
    rows += [(200 + i, i % 3, [1, 1, 0, 1]) for i in range(150)]
    assert check(spark, rows)


def test_odd_rows(spark):
    rng = random.Random(3)
    rows = clustered(rng, 60, 3)
    rows += [(None, 1, rows[0][2]), (None, 2, rows[0][2]), (70, None, [1, 2, 3]), (80, 1, None), (90, 1, []), (100, 1, [1, None, 2])]
    rows += [rows[0], rows[0], (0, 3, [5, 5, 5]), (110, 1, [7, 7]), (111, 1, [7, 8]), (112, 2, [7, 7]), (113, 2, [0, 0])]
    rows += [(120, 1, [0, 0, 0]), (130, 5, [10**9, 10**9, 1]), (131, 5, [10**9, 1, 1]), (132, 6, [10**9, 0, 0])]
    assert check(spark, rows)
    frame = spark.createDataFrame([], SCHEMA)
    assert negatives.mine(frame, F.expr(IS_ANCHOR)).collect() == []
    assert negatives.mine(spark.createDataFrame([(1, 1, [1], "x", 1)], SCHEMA), F.expr(IS_ANCHOR)).collect() == []


def test_scores_beyond_a_long_end_at_its_limits(spark):
    big = 2**62
    rows = [(10, 1, [big, big]), (1, 1, [big, big]), (2, 2, [big, big]), (3, 2, [-big, -big])]
    got = negatives.mine(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), F.expr(IS_ANCHOR)).collect()
    assert [(r.positive_id, r.negative_id, r.negative_score) for r in got] == [(1, 2, 2**63 - 1)]


@pytest.mark.parametrize("cosine", [0.3, 0.7, 0.95])
def test_lists_lose_no_row_and_cut_off_most(cosine):
    """Whatever the floor, the candidates hold all rows that reach it; high floors leave few."""
    rng = np.random.default_rng(int(cosine * 100))
    drawn = rng.normal(size=(3000, 8)) ** 3
    vectors = np.rint(drawn / np.sqrt((drawn**2).sum(1))[:, None] * 5000).astype(np.int64)
    bucket = negatives.Bucket(np.arange(3000), np.zeros(3000, np.int64), vectors)
    own = vectors[:40]
    floor = (cosine * np.sqrt((own**2).sum(1)) * 5000).astype(np.int64)[:, None]
    a = negatives.Anchors(
        np.arange(40), np.zeros(40, np.int64), own, floor, np.full((40, 1), 2**62), np.full((40, 1), 2**62), True, 5
    )
    whole, few = bucket.candidates(a)
    listed = dict(few)
    scores = own @ vectors.T
    verified = 0
    for i in range(40):
        reached = np.flatnonzero(scores[i] >= floor[i, 0])
        if i in whole:
            verified += 3000
        else:
            assert set(reached) <= set(listed.get(i, np.zeros(0, int)).tolist())
            verified += len(listed.get(i, ()))
    assert verified < 40 * 3000 * {0.3: 1.01, 0.7: 0.95, 0.95: 0.2}[cosine]


def test_short_buckets_are_passed_over():
    vectors = np.array([[1, 2], [2, 1], [0, 0]])
    a = negatives.Anchors(
        np.array([9]), np.array([0]), np.array([[10, 10]]), np.array([[1000]]), np.array([[2000]]), np.array([[99]]), True, 5
    )
    whole, few = negatives.Bucket(np.arange(3), np.zeros(3, int), vectors).candidates(a)
    assert len(whole) == 0 and few == []

"""Exact top-k by multi-index hashing against brute force."""

from __future__ import annotations

import math
import random

import pytest

from rateforge.llm import hamming_search as H

SCHEMA = "id long, embedding array<float>, code long, distance int"


def code(v):
    return sum(1 << i for i, x in enumerate(v[:64]) if x is not None and not math.isnan(x) and x > 0)


def brute(rows, queries, k):
    codes = [(i, code(v)) for i, v in rows if i is not None and v is not None]
    out = []
    for q, v in queries:
        if q is None or v is None:
            continue
        near = sorted(((code(v) ^ c).bit_count(), i) for i, c in codes)[:k]
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)


def search(spark, rows, queries, k):
    return sorted(tuple(r) for r in H.top_k(frame(spark, rows), frame(spark, queries), k).collect())


@pytest.mark.parametrize("k", [1, 10])
def test_random_and_near_codes(spark, k):
    rnd = random.Random(k)
    vector = lambda: [rnd.choice([-1.0, 0.5]) for _ in range(64)]
    rows = [(i, vector()) for i in range(150)]
    for i in range(150, 260):  # around a few centres
        v = list(rows[i % 3][1])
        for b in rnd.sample(range(64), rnd.randint(0, 9)):
            v[b] = -v[b]
        rows.append((i, v))
    rows += [(i, rows[5][1]) for i in range(260, 330)]  # a group of copies
    queries = [r for r in rows if r[0] % 20 == 5] + [(265, rows[5][1])]
    assert search(spark, rows, queries, k) == brute(rows, queries, k)


def test_defined_cases(spark):
    """Nulls, NaN, short and long vectors, repeated rows, fewer codes than k."""
    nan = float("nan")
    rows = [
        (1, [1.0] * 64), (1, [1.0] * 64), (2, [1.0] * 10), (3, [1.0] * 70), (4, [None, nan] + [1.0] * 62),
        (5, None), (None, [1.0]), (6, []),
    ]
    queries = [(1, [1.0] * 64), (6, []), (5, None)]
    assert search(spark, rows, queries, 10) == brute(rows, queries, 10)
    assert search(spark, rows, [], 3) == []
    assert search(spark, [], queries, 3) == []


def test_segments_follow_the_number_of_codes():
    """More codes, longer segments; the entries a value stay few at every size."""
    counts = [H.segment_count(10**e) for e in range(11)]
    assert counts == sorted(counts, reverse=True) and counts[0] == 16 and counts[-1] == 3
    assert H.segment_count(10_000) > H.segment_count(60_000) > H.segment_count(10**7)


def test_probes_are_all_values_at_the_radius(spark):
    """Uneven segments: 64 bits in 5, of 12 and 13 bits."""
    query = -0x123456789ABCDEF
    waiting = spark.createDataFrame([(query, 64)], "query long, kth int")
    for radius in (0, 1, 3, 13):
        found = [tuple(r) for r in H._probes(waiting, 64, 5, range(1, 5), radius).select("segment", "value").collect()]
        expected = []
        for i in range(1, 5):
            start, stop = 64 * i // 5, 64 * (i + 1) // 5
            own = (query >> start) & ((1 << (stop - start)) - 1)
            expected += [(i, v) for v in range(1 << (stop - start)) if (v ^ own).bit_count() == radius]
        assert sorted(found) == sorted(expected)


@pytest.mark.parametrize("n", [3, 5, 16])
def test_any_number_of_segments_gives_the_same_results(spark, monkeypatch, n):
    """The number decides the work alone: every code is met once, ties stay in order."""
    rnd = random.Random(n)
    centre = [rnd.choice([-1.0, 1.0]) for _ in range(64)]
    rows = []
    for i in range(120):  # distances 0 to 4 with many ties
        v = list(centre)
        for b in rnd.sample(range(64), i % 5):
            v[b] = -v[b]
        rows.append((i, v))
    monkeypatch.setattr(H, "segment_count", lambda *a: n)
    queries = [r for r in rows if r[0] % 17 == 0]
    assert search(spark, rows, queries, 10) == brute(rows, queries, 10)

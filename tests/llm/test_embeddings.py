"""Whitening, one-bit code search and ball k-means against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateforge.llm import ball_kmeans, bidiagonal, queries, rotated_codes, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, code string"
NAN, INF = float("nan"), float("inf")


@pytest.fixture()
def table(spark, tmp_path):
    """An embeddings table, with columns of clashing names, in a folder of its own."""

    def make(rows):
        rows = [(i, v, label, "vector", "code") for i, v, label in rows]
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
        return str(tmp_path)

    return make


def some_rows(n=300, d=16, seed=3):
    """Random vectors, copies, and rows that must drop out."""
    drawn = np.random.default_rng(seed)
    centres = drawn.standard_normal((4, d))
    x = (centres[drawn.integers(0, 4, n)] + 0.5 * drawn.standard_normal((n, d))).astype(np.float32)
    rows = [(i, [float(c) for c in v], int(i % 3) if i % 7 else None) for i, v in enumerate(x)]
    rows += [(n + i, rows[20][1], 1) for i in range(40)]  # copies
    rows += [rows[5], rows[5]]  # repeated rows
    bad = [None, [], [None] * d, [NAN] * d, [INF] * d, rows[0][1][:-1] + [None], rows[0][1][:-1]]
    return rows, [(10_000 + 20 * i, v, 2) for i, v in enumerate(bad)]


def whole(rows):
    return np.array([v for _, v, _ in rows], dtype=np.float64)


# --- singular values -----------------------------------------------------------


def factor(x):
    r, d = np.linalg.qr(x, mode="r"), x.shape[1]
    return np.vstack([r, np.zeros((max(0, d - len(r)), d))])


@pytest.mark.parametrize("kind", ["random", "falling", "rising", "clusters", "identity", "dependent", "few", "one"])
def test_singular_vectors(kind):
    drawn = np.random.default_rng(1)
    x = drawn.standard_normal((200, 24))
    if kind == "falling":
        x = x * np.logspace(0, -6, 24)
    elif kind == "rising":
        x = x * np.logspace(-4, 2, 24)
    elif kind == "clusters":
        turn, _ = np.linalg.qr(drawn.standard_normal((24, 24)))
        x = (np.linalg.qr(x)[0] * np.repeat([3.0, 2.0, 1.0, 1.0 + 1e-7], 6)) @ turn
    elif kind == "identity":
        x = np.eye(24)
    elif kind == "dependent":
        x[:, 3], x[:, 9] = 0.0, x[:, 10] - 2 * x[:, 11]
    elif kind == "few":
        x = x[:5]
    elif kind == "one":
        x = x[:, :1]
    squares, v = bidiagonal.right_singular(factor(x), whitening.RANK)
    true = np.linalg.svd(x, compute_uv=False)
    rank = {"dependent": 22, "few": 5}.get(kind, x.shape[1])
    assert len(squares) == rank
    np.testing.assert_allclose(np.sqrt(squares), true[:rank], rtol=1e-9)
    white = x @ v / np.sqrt(squares)
    np.testing.assert_allclose(white.T @ white, np.eye(rank), atol=1e-9)


# --- whitening -----------------------------------------------------------------


def test_whitening_against_brute_force(spark, table):
    rows, bad = some_rows()
    got = queries.op11_embedding_whitening(spark, table([*rows, *bad, (None, rows[1][1], 0)])).collect()
    rows = [*rows, (None, rows[1][1], 0)]
    x = np.floor(64 * whole(rows)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    covariance = centred.T @ centred / n
    e, v = np.linalg.eigh(covariance)
    e, v = e[::-1], v[:, ::-1]
    white = centred @ v / np.sqrt(e)
    assert len(got) == n * 16 and {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    signs = {}
    left = sorted((-1 if i is None else i, c) for i, _, _ in rows for c in range(16))
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["component"] - 1) for r in got) == left
    place = {i: p for p, (i, _, _) in enumerate(rows)}
    for r in got:
        p, c = place[r["vec_id"]], r["component"] - 1
        sign = signs.setdefault(c, math.copysign(1, r["whitened"] * white[p, c]))
        assert r["whitened"] == pytest.approx(sign * white[p, c], abs=1e-8)
        assert r["explained"] == pytest.approx(e[c] / np.trace(covariance), rel=1e-9)
        assert r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[p], sums))


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [], 0)], [(1, [1.0, 2.0], 0)] * 3])
def test_whitening_without_components(spark, table, rows):
    got = queries.op11_embedding_whitening(spark, table(rows))
    assert got.count() == 0 and got.columns[:2] == ["vec_id", "component"]


def test_whitening_large_values_and_long_vectors(spark, table):
    """Deviations beyond 64 bits are null; more than 32 dimensions give 32 components; a constant dimension none."""
    drawn = np.random.default_rng(5)
    x = drawn.standard_normal((90, 40)).astype(np.float32)
    x[:, 7] = 3.0
    x[0] *= np.float32(1e8)
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    got = queries.op11_embedding_whitening(spark, table(rows))
    assert got.where("component <= 32").count() == got.count() == 90 * 32
    n, ints = 90, np.floor(64 * whole(rows)).astype(np.int64).astype(object) + 1_000_000
    sums = ints.sum(axis=0)
    for r in got.where("component = 1").collect():
        true = sum((n * a - s) ** 2 for a, s in zip(ints[r["vec_id"]], sums))
        assert r["deviation"] == (true if true < 2**63 else None)
    with pytest.raises(Exception, match="2\\^46"):
        whitening.whiten(spark.createDataFrame([(1, [1e20])], "vec_id long, embedding array<float>"))


def test_merging_many_tasks(spark):
    """More partial factors than one task merges."""
    drawn = np.random.default_rng(2)
    x = drawn.standard_normal((400, 5))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    one, many = (whitening.whiten(frame.repartition(p))[1] for p in (1, 70))
    np.testing.assert_allclose(one.components, many.components, atol=1e-10)
    np.testing.assert_allclose(one.eigenvalues, many.eigenvalues, rtol=1e-12)


# --- one-bit codes -------------------------------------------------------------


def inner(a, b):
    """Summed from the first component to the last (``sum`` compensates its rounding)."""
    total = 0.0
    for x, y in zip(a.tolist(), b.tolist()):
        total += x * y
    return total


def best(rows, queries_at, k):
    """Exact results, as sets of (score, id) lists per query row."""
    x = whole(rows)
    out = {}
    for q in queries_at:
        scores = [inner(x[q], v) for v in x]
        ranked = sorted((-s, rows[p][0]) for p, s in enumerate(scores) if p != q)[:k]
        out[q] = [(i, -s) for s, i in ranked]
    return out


def test_code_search_against_brute_force(spark, table):
    rows, bad = some_rows(n=700)
    rows = [r for p, r in enumerate(rows) if p < 740]  # ids are unique
    cases = [(9_000, [0.0] * 16, 0), (None, rows[0][1], 0)]
    got = queries.op12_rotated_code_search(spark, table([*rows, *bad, *cases])).collect()
    true = best(rows, [p for p, r in enumerate(rows) if r[0] % 20 == 0], 20)
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(found.setdefault(r["query_id"], [])) + 1
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(found) == set(true) and all(len(f) == 20 for f in found.values())
    x = whole(rows)
    for q, results in found.items():
        assert results == sorted(results, key=lambda t: (-t[1], t[0]))
        assert all(s == inner(x[q], x[i]) for i, s in results)
    recall = np.mean([len(set(found[q]) & set(true[q])) / 20 for q in true])
    assert recall >= 0.97


def test_code_search_recall_without_structure(spark):
    """Random directions in 64 dimensions, several groups and batches: the hardest case for any index."""
    drawn = np.random.default_rng(8)
    x = drawn.standard_normal((4000, 64)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    got = rotated_codes.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0)
    scores = x.astype(np.float64)[::20] @ x.astype(np.float64).T
    scores[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    true = {20 * q: set(np.argsort(-s)[:20].tolist()) for q, s in enumerate(scores)}
    found = got.groupBy("query_id").agg(F.collect_list("vec_id").alias("ids")).collect()
    assert np.mean([len(true[r["query_id"]] & set(r["ids"])) / 20 for r in found]) >= 0.98 and len(found) == 200


def test_code_search_few_and_repeated_rows(spark):
    schema = "vec_id long, embedding array<float>"
    find = lambda rows: [
        tuple(r) for r in rotated_codes.nearest(spark.createDataFrame(rows, schema), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    ]
    assert find([]) == find([(1, None), (20, [0.0, 0.0])]) == find([(20, [1.0])]) == []
    assert find([(1, [1.0, 0.0]), (3, [2.0, 0.0])]) == []
    rows = [(0, [1.0, 0.0]), (5, [1.0, 1.0]), (4, [1.0, 1.0]), (7, [0.0, 3.0])]
    assert find(rows) == [(0, 1, 4, 1.0), (0, 2, 5, 1.0), (0, 3, 7, 0.0)]
    same = [(20, [2.0, 1.0])] * 2
    assert find(same) == [(20, 1, 20, 5.0)] * 2


def test_bounds_choose_few_rows_for_reranking():
    drawn = np.random.default_rng(4)
    x = drawn.standard_normal((5000, 64))
    turn = rotated_codes.rotation(64)
    np.testing.assert_allclose(turn @ turn.T, np.eye(64), atol=1e-12)
    bits, length, f = rotated_codes.encode(x, np.zeros(64), turn)
    signs = np.unpackbits(bits, axis=1).astype(float) * 2 - 1
    q = drawn.standard_normal(64)
    estimate = (signs @ (turn @ q)) / 8 / f * length
    bound = rotated_codes.EPSILON * np.linalg.norm(q) * length * np.sqrt((1 - f**2) / f**2 / 63)
    assert np.mean(np.abs(estimate - x @ q) <= bound) >= 0.93


# --- ball k-means --------------------------------------------------------------


def brute_codes(rows, parts=16, k=64):
    x = np.floor(256 * whole(rows)).astype(np.int64)
    first = sorted(range(len(rows)), key=lambda p: (rows[p][0], rows[p][1]))[:k]
    cut = [x.shape[1] * i // parts for i in range(parts + 1)]
    books, codes, error = [], [], np.zeros(len(x), dtype=np.int64)
    for p in range(parts):
        points = x[:, cut[p] : cut[p + 1]]
        book = points[first].copy()
        for n in range(3):
            squares = ((points[:, None] - book[None]) ** 2).sum(axis=2)
            code = squares.argmin(axis=1)
            if n < 2:
                for e in set(code.tolist()):
                    book[e] = [sum(map(int, c)) // int((code == e).sum()) for c in points[code == e].T]
        books.append(book)
        codes.append(code)
        error += squares.min(axis=1)
    sha = hashlib.sha256(",".join(str(c) for b in books for c in b.ravel()).encode()).hexdigest()
    return ["".join(f"{c:02x}" for c in row) for row in np.array(codes).T], error, sha


@pytest.mark.parametrize("d, n", [(64, 300), (16, 300), (32, 10), (20, 100)])
def test_ball_kmeans_against_brute_force(spark, table, d, n):
    rows, bad = some_rows(n=n + 30, d=d)
    rows = [r for r in rows if r[0] != 5]  # equal ids have equal vectors
    if n == 10:
        rows = rows[:10]
    got = queries.op13_ball_kmeans_codes(spark, table([*rows, *bad])).collect()
    codes, error, sha = brute_codes(rows)
    by_label = {}
    for (_, _, label), e in zip(rows, error):
        by_label[label] = by_label.get(label, 0) + int(e)
    true = sorted((i, c, int(e), by_label[label], sha) for (i, _, label), c, e in zip(rows, codes, error))
    assert sorted(tuple(r) for r in got) == true


def test_ball_search_is_exact_and_skips_work():
    """Against a full search on small integers, where ties are everywhere; equal entries too."""
    drawn = np.random.default_rng(6)
    for spread in (2, 6, 60, 4000):
        points = drawn.integers(-spread, spread + 1, (3000, 3))
        entries = np.concatenate([points[:40], points[:2]])
        wide, _ = ball_kmeans.full_search(points, entries)
        moved = entries.copy()
        for e in set(wide.tolist()):
            moved[e] = points[wide == e].sum(axis=0) // (wide == e).sum()
        best_of, least, computed = ball_kmeans.ball_search(points, wide, moved)
        true, squares = ball_kmeans.full_search(points, moved)
        assert (best_of == true).all() and (least == squares).all()
        if spread == 4000:
            assert computed < 0.5 * len(points) * len(entries)
        # From any assignment, even a bad one, the result is the nearest entry.
        anyhow = drawn.integers(0, len(entries), len(points))
        assert (ball_kmeans.ball_search(points, anyhow, moved)[0] == true).all()


def test_ball_kmeans_without_rows(spark, table):
    assert queries.op13_ball_kmeans_codes(spark, table([(1, None, 0), (2, [NAN], 1)])).count() == 0


def test_ball_kmeans_large_components(spark):
    with pytest.raises(Exception, match="2\\^16"):
        frame = spark.createDataFrame([(1, [1e9], 0)], "vec_id long, embedding array<float>, label int")
        ball_kmeans.compress(frame)[0].collect()

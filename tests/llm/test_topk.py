import math

import numpy as np
import pytest

from lakeloom.llm import topk
from lakeloom.llm.topk import Shelf, top_k


def plain(rows, queries, k):
    def whole(x):
        ok = x is not None and all(c is not None and math.isfinite(c) for c in x)
        return [math.floor(256 * c) for c in x] if ok else None

    vectors = [(i, whole(x)) for i, x in rows if i is not None and whole(x) is not None]
    out = []
    for q in sorted(set(queries)):
        for x in [min(x for i, x in vectors if i == q)] if any(i == q for i, _ in vectors) else []:
            scores = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q and len(y) == len(x)]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def ran(spark, rows, queries, k):
    vectors = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, x int, ids string")
    return sorted(tuple(r) for r in top_k(vectors, vectors.where(vectors.vec_id.isin(queries)), k=k).collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "SHELF", 21)
    monkeypatch.setattr(topk, "BUNDLE", 5)
    rng = np.random.default_rng(4)
    rows = [(int(i), np.round(rng.normal(size=6), 1).tolist()) for i in rng.permutation(300) - 40]
    rows += [(1000 + i, rows[3][1]) for i in range(80)] + rows[:5]  # ties and repeated rows
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 4), (2002, [math.nan] * 6), (2003, [math.inf] * 6), (None, [1.0] * 6)]
    rows += [(3000 + i, [float(i), -1.0]) for i in range(4)] + [(4000, []), (4001, [])]
    queries = [int(i) for i in range(-40, 260, 9)] + [1000, 2000, 2002, 3001, 4000]
    assert ran(spark, rows, queries, 5) == plain(rows, queries, 5)


def test_large_components(spark):
    rows = [(i, [float(2**21 + i), float(3**12 * (i % 3))]) for i in range(30)]
    assert ran(spark, rows, [0, 7], 4) == plain(rows, [0, 7], 4)


def test_blocks_are_skipped(monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 10)
    matrix = np.repeat(np.arange(100)[::-1], 10).reshape(-1, 1)
    shelf = Shelf(np.arange(1000), matrix)
    seen = []
    shelf.exact = [type("B", (), {"__matmul__": lambda self, ask, b=b: seen.append(1) or b @ ask})() for b in shelf.exact]
    ids, scores = shelf.top(-1, np.array([1]), 5)
    assert ids.tolist() == [0, 1, 2, 3, 4] and scores.tolist() == [99] * 5 and len(seen) == 1


def test_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(none, none).collect() == []
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert top_k(one, one).collect() == []
    assert top_k(one, none).collect() == []


def test_shelves_below_the_bound_are_not_visited(spark, monkeypatch):
    """Clusters by id: a query has to visit the shelves of its own cluster only."""
    for name, size in (("BLOCK", 10), ("SHELF", 40), ("BUNDLE", 16)):
        monkeypatch.setattr(topk, name, size)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 12)) * 4
    rows = [(n, (centres[n // 100] + rng.normal(size=12) * 0.05).tolist()) for n in range(800)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    queries = vectors.where("vec_id % 50 = 0")
    found = topk.search(vectors, queries, 5, 256, "vec_id", "embedding")
    got = sorted(tuple(r) for r in topk.ranked(found, 5).collect())
    assert got == plain(rows, list(range(0, 800, 50)), 5)
    looked, skipped = found.agg({"looked": "sum", "skipped": "sum"}).first()
    assert looked + skipped <= 16 * 15 * 4 / 3  # blocks on visited shelves: a third of all at most


def test_bounds_hold():
    rng = np.random.default_rng(6)
    for size in (3, 2**20, 2**40):
        vectors, asked = (rng.integers(-size, size, (50, 7)) for _ in range(2))
        high = topk.bounds(asked, vectors.max(axis=0), vectors.min(axis=0))
        exact = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in vectors] for x in asked]
        assert all(max(own) <= bound for own, bound in zip(exact, high.tolist()))

import math

import numpy as np

from tickloom.llm import topk

SF = "/root/testdata/sf0.01"


def _brute(rows, is_query, k=10):
    points = [
        (i, [math.floor(1024 * float(e)) for e in x])
        for i, x in rows
        if i is not None and x and all(e is not None and math.isfinite(e) for e in x)
    ]
    out = []
    for at, (i, q) in enumerate(points):
        if is_query(i):
            best = sorted((-sum(a * b for a, b in zip(q, v)), j) for to, (j, v) in enumerate(points) if to != at)[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    return sorted(out)


def _got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def test_matches_brute_force(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert _got(topk.search(df, "vec_id % 20 = 0")) == _brute(rows, lambda i: i % 20 == 0)


def test_small_rings_ties_and_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "RING_ROWS", 16)
    monkeypatch.setattr(topk, "SAMPLE_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.2, 6).round(1).tolist() if i % 3 else [0.5] * 6) for i in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert _got(topk.search(df, "vec_id % 50 = 0", k=7)) == _brute(
        [(r.vec_id, r.embedding) for r in df.collect()], lambda i: i % 50 == 0, 7
    )


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, -0.5]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []),
            (None, [1.0, 1.0]), (100, [0.0, 0.0]), (100, [0.0, 0.0]), (7, [-0.0001, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as v", "2 as pivot", "3 as n")
    got = _got(topk.search(df, "vec_id % 100 = 0"))
    assert got == _brute(rows, lambda i: i % 100 == 0)
    assert len(got) == 12  # three query rows, four other sound rows each
    assert topk.search(df.limit(0), "vec_id % 100 = 0").count() == 0
    assert topk.search(df.where("vec_id is null"), "vec_id % 100 = 0").count() == 0


def test_large_components_repeated_rows_and_unequal_lengths(spark):
    rng = np.random.default_rng(7)
    for size in (1e5, 1e6, 1e14):
        rows = [(i % 150, (rng.normal(0, 1, 5 if i % 4 else 3) * size).tolist()) for i in range(200)] + [(9, [size] * 5)] * 20
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got, want = _got(topk.search(df, "vec_id % 50 = 0")), _brute(rows, lambda i: i % 50 == 0)
        if size < 1e14:
            assert max(r[3] for r in want) > 2**53 and got == want
        else:  # beyond a long all scores are the largest long
            assert [(q, r, s) for q, r, _, s in got] == [(q, r, min(s, 2**63 - 1)) for q, r, _, s in want]


def test_bounds_are_sound_and_skip_rings_of_clustered_vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1000, (40, 16))
    v = (centres[rng.integers(0, 40, 4000)] + rng.normal(0, 20, (4000, 16))).astype(np.int64)
    longest2 = float((v**2).sum(1).max())
    lifted = topk._lifted(v.astype(float), longest2)
    pivots = topk.fit_pivots(lifted)
    away = np.sqrt(topk._squares(lifted, pivots))
    cell = away.argmin(1)
    rings = np.unique(cell)
    low, high = (np.stack([f(away[cell == c], axis=0) for c in rings]) for f in (np.min, np.max))
    bound = topk.ring_bounds(away[:50], low, high)
    true = np.sqrt(topk._squares(lifted[:50], lifted))
    assert all((bound[:, i] <= true[:, cell == c].min(1) + 1e-3).all() for i, c in enumerate(rings))
    scores = topk.products(v[:50], v, longest2)
    floor = np.sort(scores, axis=1)[:, -10]
    asked = bound <= topk.farthest(floor, longest2)[:, None]
    for i in range(50):  # every vector of the ten best lies in a ring that is asked
        assert asked[i, np.searchsorted(rings, cell[scores[i] >= floor[i]])].all()
    assert asked.mean() < 0.5

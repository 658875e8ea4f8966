"""Operator 6 against all scores."""

import math

import numpy as np

from sackcast.llm import topk


def _brute(rows, k, every):
    cells = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            cells[i] = [math.floor(1024 * x) for x in v]
    out = []
    for q in cells:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(cells[q], cells[c])), c) for c in cells if c != q and len(cells[c]) == len(cells[q]))
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def _got(spark, rows, k=10, every=100):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").drop("x")
    return sorted(tuple(r) for r in topk.exact_top_k(topk.scaled_vectors(frame), k, every).collect())


def test_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    assert sorted(tuple(r) for r in topk.exact_top_k(topk.scaled_vectors(table)).collect()) == _brute(rows, 10, 100)


def test_many_blocks_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rows = [(i, [((i * 7919) % 13) / 13, ((i * 104729) % 7) / -7, 0.25], 1) for i in range(300)]
    rows += [(300, None, 1), (310, [None, 1.0, 2.0], 1), (320, [float("nan"), 1.0, 2.0], None), (330, [float("inf"), 1.0, 2.0], 1), (None, [1.0, 1.0, 1.0], 1), (5, rows[5][1], 1),
             (340, [], 1), (350, [1.0, 2.0], 1)]
    import numpy as np
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _ in rows]
    assert _got(spark, rows, 10, 10) == _brute(exact, 10, 10)


def test_few_rows(spark):
    assert _got(spark, [(0, [1.0], 1)]) == [] and _got(spark, [(1, [1.0], 1)]) == []
    assert _got(spark, [(0, [1.0], 1), (1, [2.0], 1)]) == [(0, 1, 1, 1024 * 2048)]


def _brute_rows(rows, k, every):
    """As _brute, for ids that may come with several vectors of whole numbers."""
    found = {}
    for q, a in rows:
        if q % every == 0:
            found.setdefault(q, set()).update((-sum(x * y for x, y in zip(a, b)), c) for c, b in rows if c != q and len(a) == len(b))
    return sorted((q, r + 1, c, -s) for q, all_of in found.items() for r, (s, c) in enumerate(sorted(all_of)[:k]))


def test_rounds_against_all_scores(spark, monkeypatch):
    for name, value in {"BLOCK": 16, "QUERIES": 16, "TILE": 4, "GROUP": 24, "LEAST": 1, "SPREAD": 3, "DIM": 8}.items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(5)
    vectors = np.rint(rng.standard_normal((700, 8)) * 10.0 ** rng.uniform(0, 4, (700, 1))).astype(int).tolist()
    rows = list(enumerate(vectors))
    rows += [(1000 + i, vectors[3]) for i in range(60)]  # a very common vector
    rows += [(1100 + i, [0] * 8) for i in range(20)]
    rows += [(1200 + i, [-5 - i % 3] * 8) for i in range(40)] + [(1250, [9] * 8), (1260, [1 << 29] * 8)]
    rows += [(1300 + i, rng.integers(-400, 400, 200).tolist()) for i in range(40)]  # three lanes
    rows += [(10, vectors[20]), (10, vectors[3]), (7, vectors[20]), (7, vectors[7]), (11, vectors[12])]  # ids with several vectors, one repeated
    frame = spark.createDataFrame(rows, "vec_id long, cells array<long>")
    assert sorted(tuple(r) for r in topk.exact_top_k(frame, 10, 10).collect()) == _brute_rows(rows, 10, 10)


def test_screen_keeps_all_that_reach_the_cutoff_and_little_else():
    rng = np.random.default_rng(6)
    for dim, lanes in ((64, 4), (200, 3)):
        exact = rng.standard_normal((1536, dim)) / np.sqrt(dim)
        exact[600:700] = 0.6 * exact[:100] + 0.8 * exact[600:700]  # some that are alike
        cells = np.floor(1024 * exact).astype(np.int64)
        q, c = cells[:512], cells[512:]
        block = topk._Block(np.arange(len(c)), c)
        assert block.lanes == lanes
        scores = q @ c.T
        own, whole, off = topk._coarse(q, block.length, block.most)
        cutoff = np.full(len(q), 0.5 * 2 ** 20)
        wide = np.column_stack([whole, np.zeros(len(q))])
        threshold = block.threshold(cutoff * block.length ** 2 / own, topk._length(whole), off * block.length + 1e-6)
        at, to, busy = block.near(wide, threshold, np.empty(len(q) * block.size))
        kept = np.zeros(scores.shape, bool)
        kept[at, to] = True
        reach = scores >= cutoff[:, None]
        assert reach.sum() >= 50 and kept[reach].all() and not len(busy)
        assert kept.mean() < 0.02  # before: every pair was scored exactly, and twice

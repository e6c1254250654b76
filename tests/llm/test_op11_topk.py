import math
import random

import numpy as np
import pytest

from adlake.llm import op11_topk

KIND = "vec_id long, embedding array<float>, label int, v string, norm int"


def brute(rows, k=10, every=100):
    usable = [(i, [max(-(2**63), min(2**63 - 1, math.floor(1024 * float(np.float32(x))))) for x in v]) for i, v in rows
              if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, x) in enumerate(usable):
        if q is None or math.fmod(q, every):
            continue
        scores = [(max(-(2**63), min(2**63 - 1, sum(map(lambda s, t: s * t, x, y)))), i) for b, (i, y) in enumerate(usable) if b != a]
        scores.sort(key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "mine", 1) for i, v in rows], KIND)


def result(spark, rows, k=10):
    return sorted(map(tuple, op11_topk.report(frame(spark, rows), k).collect()), key=str)


def vectors(seed, n, dims=8, spread=2.0):
    rnd = np.random.default_rng(seed)
    center = rnd.normal(size=(5, dims))
    x = center[rnd.integers(0, 5, n)] + rnd.normal(size=(n, dims)) * 0.2
    x *= np.exp(rnd.normal(size=(n, 1)) * spread)
    return [(i, x[i].astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("spread", [0.0, 0.3, 2.0])
def test_agrees_with_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(op11_topk, "BLOCK_VALUES", 256)
    monkeypatch.setattr(op11_topk, "SEED_ROWS", 40)
    rows = vectors(1, 1200, spread=spread)
    assert result(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([0.0, 0.5, -0.5, 0.25]) for _ in range(4)]) for i in range(-300, 500, 7)]
    rows += [(100, None), (200, [1.0, None]), (300, [math.nan, 1.0]), (400, [math.inf, 0.0]), (None, [0.5, 0.5, 0.5, 0.5]), (None, None)]
    rows += [(500, []), (600, [0.0] * 4), (700, [0.5]), (800, [0.5] * 9), (900, [1e30, 1.0]), (1000, [-1e30, 3e38]), (1100, [1e12, 1e12, 1e-30])]
    rows += [(1200 + i % 3 * 100, [0.5, 0.5, 0.25, 0.0]) for i in range(9)] + [(2000 + i, [0.75] * 4) for i in range(40)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows, 3) == brute(rows, 3)


def test_few_rows(spark):
    assert result(spark, []) == []
    assert result(spark, [(100, [1.0])]) == []
    assert result(spark, [(100, [1.0]), (7, [2.0])]) == [(100, 1, 7, 2 * 1024 * 1024)]
    assert result(spark, [(1, [1.0]), (7, [2.0])]) == []


def test_coordinates_and_lengths_prune_but_lose_nothing():
    rnd = np.random.default_rng(7)
    r = np.floor(1024 * rnd.normal(size=(4000, 6)) ** 3).astype(np.int64)
    q = np.floor(1024 * rnd.normal(size=(30, 6)) ** 3).astype(np.int64)
    norms = [np.sqrt((m.astype(float) ** 2).sum(1)) for m in (q, r)]
    scores = q @ r.T
    bound = np.sort(scores, axis=1)[:, -25].astype(float)
    got = {i: (at.tolist(), s.tolist()) for i, at, s in op11_topk.search_block(q, norms[0], bound, r, norms[1], np.arange(4000), np.zeros(4000, bool), 11)}
    for i in range(30):
        want = sorted(range(4000), key=lambda j: (-scores[i, j], j))[:11]
        assert got[i] == (want, scores[i, want].tolist())


def test_a_vector_that_many_rows_share_sends_few_of_them(spark):
    rows = [(i, [0.5, 0.25]) for i in range(3000)] + [(5000 + i, [0.1, i / 10]) for i in range(50)]
    vectors = op11_topk.integer_vectors(frame(spark, rows))
    assert op11_topk.candidate_rows(vectors, 10).count() == 11 + 50
    assert result(spark, rows) == brute(rows)

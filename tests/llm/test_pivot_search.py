import math

import numpy as np
import pytest

from registrum.llm import pivot_search

SCHEMA = "vec_id long, embedding array<float>, score int, rank string"


def brute(rows, every, k):
    good = []
    for key, vector, *_ in rows:
        if key is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        good.append((key, [math.floor(64 * float(np.float32(v))) for v in vector]))
    out = []
    for q, a in good:
        if q % every:
            continue
        found = sorted(((-sum(x * y for x, y in zip(a, b)), c) for c, b in good if c != q))[:k]
        out += [(q, i, c, -s) for i, (s, c) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_matches_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(pivot_search, "FIRST_ROUND", 8)
    monkeypatch.setattr(pivot_search, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + spread * rng.normal(size=12)).tolist(), 1, "x") for i in range(400)]
    rows += [(400 + i, rows[0][1], 1, "x") for i in range(30)]  # ties
    rows += [(440, None, 1, "x"), (460, [math.nan] * 12, 1, "x"), (480, [None, 1.0], 1, "x"), (500, [math.inf], 1, "x")]
    rows += [(520, [], 1, "x"), (540, [1.0, 2.0], 1, "x"), (None, [1.0], 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = sorted(map(tuple, pivot_search.top_k(df, 20, 7).collect()))
    assert found == brute(rows, 20, 7)


def test_huge_components_few_rows_and_empty(spark):
    rows = [(0, [3e30, 1.0], 1, "x"), (1, [-2e30, 1.0], 1, "x"), (20, [1e9, -5.0], 1, "x"), (3, [0.0, 4.0], 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    wanted = [(*r[:3], clip(r[3])) for r in brute(rows, 20, 20)]
    assert sorted(map(tuple, pivot_search.top_k(df, 20, 20).collect())) == wanted
    assert pivot_search.top_k(df.where("vec_id = 3")).count() == 0
    assert pivot_search.top_k(df.limit(0)).count() == 0
    assert pivot_search.top_k(df.where("vec_id = 20")).count() == 0

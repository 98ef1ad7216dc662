import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from registrum.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score int, rank string"


def brute(rows, every=100, positives=5, negatives=10, scale=256):
    good = []
    for key, vector, label, *_ in rows:
        if key is None or label is None or vector is None or any(v is None or not math.isfinite(v) for v in vector):
            continue
        good.append((key, label, [math.floor(scale * float(np.float32(v))) for v in vector]))
    clip = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for q, own, a in good:
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), c, label) for c, label, b in good if c != q)
        for s, p, label in [r for r in scored if r[2] == own][:positives]:
            fit = [r for r in scored if r[2] != own and -30 * s <= -100 * r[0] <= -90 * s][:negatives]
            out += [(q, p, i, c, clip(-s), clip(-n)) for i, (n, c, _) in enumerate(fit, 1)]
    return sorted(out)


def found(df, **options):
    return sorted(map(tuple, hard_negatives.mine(df, **options).collect()))


@pytest.mark.parametrize("spread", [0.05, 0.6])
def test_matches_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 1000)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 9))
    rows = [(i, (centres[i % 5] + spread * rng.normal(size=9)).tolist(), i % 3, 1, "x") for i in range(300)]
    rows += [(300 + i, rows[0][1], i % 2, 1, "x") for i in range(40)]  # ties, a hot cell
    rows += [(400, None, 1, 1, "x"), (410, [math.nan] * 9, 1, 1, "x"), (420, [None, 1.0], 1, 1, "x")]
    rows += [(430, [1.0] * 9, None, 1, "x"), (None, [1.0], 1, 1, "x"), (440, [], 1, 1, "x"), (450, [1.0, 2.0], 2, 1, "x")]
    rows += [rows[7], rows[7]]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df, every=10) == brute(rows, every=10)


def test_searches_end_early(spark):
    """Far cells are not opened once a window is certified."""
    rng = np.random.default_rng(5)
    first = np.repeat(np.arange(4), 50)
    vectors = np.zeros((200, 4))
    vectors[:, 0] = 100.0 * first + rng.integers(0, 5, 200)
    books = (np.array([[100.0 * c, 0.0] for c in range(4)]), np.zeros((1, 2)))
    facts = (books, (np.full(4, 5.0), np.zeros(1)), True, 2)
    cells = hard_negatives.Cells(facts, np.arange(200), np.zeros(200), vectors, first, np.zeros(200, np.int64))
    opened = []
    held = cells.of
    cells.of = type("Seen", (dict,), {"get": lambda self, k: opened.append(k) or held.get(k)})()
    wanted = hard_negatives.Wanted(5)
    cells.search(np.array([1.0, 0, 0, 0]), -1, 0, True, [wanted])
    assert opened == [(3, 0)] and len(wanted.ids) == 5


def test_huge_components_and_empty(spark):
    rows = [(0, [3e30, 1.0], 1, 1, "x"), (1, [2e30, 1.0], 1, 1, "x"), (2, [1e30, -5.0], 2, 1, "x"), (3, [1.5e30, 9.0], 0, 1, "x")]
    rows += [(4, [-1e30, 2.0], 0, 1, "x"), (100, [1.0, 4.0], 1, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(rows)
    assert found(df.limit(0)) == []
    assert found(df.where("vec_id = 1")) == []
    assert found(df.where("vec_id = 0")) == []


def test_labels_by_expression(spark):
    rng = np.random.default_rng(11)
    rows = [(i, rng.normal(size=6).tolist(), i % 10, 1, "x") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    changed = [(r[0], r[1], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2]) for r in rows]
    assert found(df, label=moved) == brute(changed)

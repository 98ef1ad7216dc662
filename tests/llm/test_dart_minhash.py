import random
from collections import Counter

import numpy as np
import pytest

from registrum.llm import dart_minhash as dm
from registrum.llm.components import components


def brute_classes(rows):
    words = dm.Words()
    sets = []
    for _, text in rows:
        elements, weights = dm.shingle_units(words.hashes(text or ""))
        sets.append(Counter(dict(zip(elements.tolist(), weights.tolist()))))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a and sum((a & b).values()) >= dm.THRESHOLD * sum((a | b).values())):
                parent[find(i)] = find(j)
    ids = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            ids[find(i)] = min(ids.get(find(i), key), key)
    return [ids.get(find(i)) for i in range(len(rows))]


def varied(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def test_collisions_equal_weighted_jaccard():
    rng = np.random.default_rng(1)
    elements = dm.mix(np.arange(1, 301, dtype=np.uint64))
    for fraction in (False, True):
        a, b = rng.integers(0, 4, 300).astype(float), rng.integers(0, 4, 300).astype(float)
        b[:200] = a[:200]
        if fraction:
            a, b = a * 0.7, b * 0.7 + 0.1 * (b > 0)
        wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        same = np.mean(dm.signature(elements, a, 3000) == dm.signature(elements, b, 3000))
        assert abs(same - wanted) < 0.04


@pytest.mark.parametrize("representatives", [1, 3])
def test_classes_match_brute_force(spark, monkeypatch, representatives):
    monkeypatch.setattr(dm, "REPRESENTATIVES", representatives)
    rng = random.Random(4)
    rows, key = [], 0
    for group in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([4, 30, 120, 400]))]
        for _ in range(rng.randint(1, 14)):
            key += 1
            rows.append((key, " ".join(varied(rng, base, rng.choice([0, 0, 1, 2, len(base) // 25])))))
    rows += [(None, rows[0][1]), (None, "alone without id"), (900, None), (901, ""), (902, " ... "), rows[5], rows[5]]
    rows += [(3, "another text under an id that is taken"), (903, "one two " * 20_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, node string, keys int")
    found = dm.classes(df.repartition(5))
    assert found.columns == ["doc_id", "class_id"]
    wanted = sorted(map(repr, zip([r[0] for r in rows], brute_classes(rows))))
    assert sorted(repr((r.doc_id, r.class_id)) for r in found.collect()) == wanted


def test_empty_table(spark):
    assert dm.classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    found = {r.node: r.label for r in components(chain).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_components_of_a_chain_in_random_order(spark):
    ids = random.Random(3).sample(range(-(10**12), 10**12), 400)
    chain = spark.createDataFrame([*zip(ids, ids[1:]), (5, 5)], "a long, b long")
    found = {r.node: r.label for r in components(chain).collect()}
    assert found == {**dict.fromkeys(ids, min(ids)), 5: 5}


def test_one_of_each_keeps_user_columns(spark):
    rows = [(1, "the same text in two rows of the table", "a"), (2, "the same text in two rows of the table", "b"), (3, "another", "c")]
    found = dm.one_of_each(spark.createDataFrame(rows, "doc_id long, text string, _of string")).collect()
    assert sorted((r.doc_id, r["_of"]) for r in found) == [(1, "a"), (3, "c")]

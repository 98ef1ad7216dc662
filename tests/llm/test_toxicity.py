import random

import numpy as np
import pytest

from registrum.llm import toxicity
from registrum.llm.queries import op9_naive_bayes_ngrams


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(400):
        words = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(30)]
        toxic = int(i % 4 == 0)
        if toxic:
            words[rng.randrange(30)] = "horrible"
            words[rng.randrange(30)] = "dreadful"
        docs.append((i, " ".join(words), "x"))
        labels.append((i, toxic))
    labels += [(None, 1), (3, None), (9999, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, label string").repartition(5),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_features_match_a_plain_count():
    texts = ["Ab  cd\nE", "", "ab", "ab cd e ab cd e", "日本語 text"]
    every = np.arange(toxicity.BUCKETS)
    owners, buckets = toxicity.present(texts, every)
    for i, text in enumerate(texts):
        clean = " " + " ".join(text.lower().split()) + " "
        grams = {clean[k : k + n] for n in toxicity.SIZES for k in range(len(clean) - n + 1)}
        alone = toxicity.present([text], every)[1]
        assert set(buckets[owners == i]) == set(alone)
        assert len(alone) <= len(grams)
        assert len(alone) >= len(grams) - 1


def test_held_out_accuracy_and_edge_rows(spark, tables):
    docs, labels = tables
    model = toxicity.fit(docs, labels.where("doc_id % 5 != 0 or doc_id is null"))
    rows = toxicity.score(docs, model).join(labels.where("toxic is not null"), "doc_id").collect()
    held = [r for r in rows if r.doc_id % 5 == 0]
    assert len(held) >= 80
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in held]) > 0.97
    odd = spark.createDataFrame([(1, None), (1, ""), (2, "x" * 300_000), (None, "horrible dreadful")], "doc_id long, text string")
    scores = {(r.doc_id, (r.text or "")[:3]): r.score for r in toxicity.score(odd, model).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    assert scores[None, "hor"] > 0.5 > scores[1, ""]
    assert toxicity.score(odd.limit(0), model).count() == 0
    with pytest.raises(ValueError, match="text"):
        toxicity.score(odd, model, output="text")


def test_one_class_or_no_labels(spark, tables):
    docs, labels = tables
    none = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    clean = toxicity.fit(docs, labels.where("toxic = 0"))
    assert all(r.score < 0.05 for r in toxicity.score(docs, clean).collect())


def test_query_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    rows = op9_naive_bayes_ngrams(spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    found = rows.join(labels, "doc_id").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in found)
    assert hit / sum(r.predicted for r in found) > 0.85
    assert hit / sum(r.toxic for r in found) > 0.75

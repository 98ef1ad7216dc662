import hashlib
import re
from collections import Counter

import numpy as np

from registrum.llm import weighted_fingerprint as wf


def terms(text):
    return Counter(w for w in re.split(r"[\s!-/:-@\[-`{-~]+", text.lower()) if w)


def likeness(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / max(1, sum(max(a[k], b[k]) for k in keys))


def check(rows, docs):
    """``docs`` have different ids."""
    order = sorted(docs)
    assert sorted(r.doc_id for r in rows) == order
    errors = []
    for r in rows:
        text = docs[r.doc_id] or ""
        after = docs[order[(order.index(r.doc_id) + 1) % len(order)]] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        if text == changed:
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1
        if text == after:
            assert r.near_next == 1
        if terms(text):
            errors.append(r.near_edited - likeness(terms(text), terms(changed)))
    return errors


def test_query_estimates_generalised_jaccard(spark):
    from registrum.llm.queries import op3_weighted_sampling

    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    df = op3_weighted_sampling(spark, folder)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    rows = df.collect()
    errors = check(rows, docs)
    assert abs(np.mean(errors)) < 0.02
    assert np.std(errors) < 0.1
    by_text = {}
    for r in rows:
        assert by_text.setdefault(docs[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) > 0.98 * len(by_text)


def test_edge_rows(spark):
    rows = [(5, None), (1, ""), (9, "word " * 50_000), (12, "same text"), (20, "same text"), (31, "ünï 日本 a.b")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, fingerprint string, place int")
    check(wf.with_edits(df, 3).collect(), dict(rows))
    alone = wf.with_edits(df.where("doc_id = 12"), 4).collect()
    # The only document follows itself: "same " and "same".
    assert len(alone) == 1 and alone[0].near_next == 1
    assert alone[0].edited_sha256 == hashlib.sha256(b"same same").hexdigest()
    assert abs(alone[0].near_edited - 1 / 3) < 0.2
    more = spark.createDataFrame([*rows, (None, "no id"), (None, "no id"), (12, "other"), (12, "other")], "doc_id long, text string")
    found = wf.with_edits(more, 2).collect()
    assert len(found) == 10
    assert [r.near_next for r in found if r.doc_id is None] == [None, None]
    assert wf.with_edits(df.limit(0), 4).count() == 0


def test_rare_words_of_long_texts_win_their_share(spark):
    """Pairs of texts of 30 000 words: 200 frequent words in common, 10 000 words once in one text only."""
    rows = []
    for pair in range(6):
        frequent = " ".join(f"f{pair}x{i}" for i in range(200))
        for side in "ab":
            rare = " ".join(f"{side}{pair}y{i}" for i in range(10_000))
            rows.append((f"{pair}{side}", f"{frequent} " * 100 + rare))
    df = spark.createDataFrame(rows, "doc string, text string")
    found = {r.doc: r.fingerprint for r in wf.fingerprints(df, ["doc"]).collect()}
    same = [np.mean(np.equal(found[f"{pair}a"], found[f"{pair}b"])) for pair in range(6)]
    assert abs(np.mean(same) - 0.5) < 0.1


def test_few_samples_are_drawn_in_one_row(spark):
    df = spark.createDataFrame([(1, "a b b"), (2, None)], "doc int, text string")
    found = wf.fingerprints(df, ["doc"])
    assert wf.SAMPLES % wf.TOGETHER == 0
    assert found._jdf.queryExecution().executedPlan().toString().count("partial_min(") <= wf.TOGETHER
    rows = {r.doc: r.fingerprint for r in found.collect()}
    # As drawn when all samples still shared a row.
    assert len(rows[1]) == wf.SAMPLES and rows[1][:2] + rows[1][-1:] == [222796768, 294466673, 2640705583]
    assert rows[2] == [0] * wf.SAMPLES


def test_draws_left_out_change_nothing(spark):
    """Few draws are worked out in full, and a text where none of them is sure to win is drawn again."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.zipf(1.3, n) % 5000) for n in (3, 19, 20, 21, 22, 60, 400, 3000)]
    rows = [(i, t) for i, t in enumerate([*texts, None, "", "one", "one " * 500])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    keys = ["doc_id", "_words"]
    terms = df.select("doc_id", wf.F.explode_outer(wf.term_weights(wf.F.col("text"))).alias("_t")).select("*", wf.F.col("_t.words").alias("_words"))
    drawn = {spare: wf.draws(terms.where("doc_id = 7"), keys, spare).count() for spare in (None, wf.SPARE)}
    assert drawn[wf.SPARE] < 0.15 * drawn[None]
    full = {r.doc_id: r.fingerprint for r in wf.fingerprints(df, ["doc_id"]).collect()}
    unsure = 0
    for spare in (1.0, 5.0, wf.SPARE):
        for r in wf.fingerprints(df, ["doc_id"], spare=spare).collect():
            assert r.unsure or r.fingerprint == full[r.doc_id]
            unsure += r.unsure
    assert unsure > 0 and len(full) == len(rows)
    plain = sorted(map(tuple, wf.with_edits(df, 3, spare=1e9).collect()))
    assert plain == sorted(map(tuple, wf.with_edits(df, 3, spare=1.0).collect()))
    assert plain == sorted(map(tuple, wf.with_edits(df, 3).collect()))
    assert [r[3] for r in plain] == ["".join(f"{s:08X}" for s in full[r[0]]) for r in plain]

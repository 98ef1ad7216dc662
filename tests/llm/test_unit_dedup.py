import random

import pytest

from registrum.llm import unit_dedup
from registrum.llm.queries import op6_repeated_units

SCHEMA = "doc_id long, text string, start string, digest long, id string"


def brute_force(rows, min_words=25, unit_words=4):
    """Documents in id order (no id last); all units seen so far are remembered."""
    out, seen = {}, set()
    versions = {}
    for key, text in rows:
        versions.setdefault((key, text), None)
    by_id: dict = {}
    for key, text in versions:
        by_id.setdefault(key, []).append(text)
    for key in sorted(by_id, key=lambda k: (k is None, k)):
        new = set()
        for text in by_id[key]:
            own, run, spans = set(), [], []
            for match in unit_dedup.UNIT.finditer(text or ""):
                words = unit_dedup.normalised(match[0])
                if len(words) < unit_words:
                    continue
                unit = tuple(words)
                if unit in seen or (unit in own and key is not None):
                    run.append((match.span(), len(words)))
                else:
                    spans.append(run)
                    run = []
                own.add(unit)
            spans.append(run)
            out[key, text] = [
                (r[0][0][0], r[-1][0][1]) for r in spans if r and sum(w for _, w in r) >= min_words
            ]
            new |= own
        if key is not None:
            seen |= new
    return out


def cut(text, spans):
    for start, stop in reversed(spans):
        text = text[:start] + text[stop:]
    return text


def test_matches_brute_force(spark):
    rng = random.Random(5)
    words = ["alpha", "Beta,", "gamma", "delta", "épsilon", "zeta", "eta"]
    sentences = [" ".join(rng.choices(words, k=rng.randint(1, 9))) + "." for _ in range(40)]
    rows = []
    for i in range(60):
        picked = rng.choices(sentences, k=rng.randint(0, 25))
        rows.append((i, "".join(s + rng.choice([" ", "\n", "\n\n"]) for s in picked)))
    rows += [(None, rows[3][1]), (None, "Short."), (61, None), (62, ""), (7, "Another text. " * 30), rows[5], rows[5]]
    df = spark.createDataFrame([(*r, "s", 1, "i") for r in rows], SCHEMA).repartition(7)
    found = unit_dedup.remove_repeats(df).collect()
    assert len(found) == len(rows)
    wanted = brute_force(rows)
    remaining = sorted((repr(k), cut(t, wanted[k, t]) if t else t, wanted[k, t]) for k, t in rows)
    got = sorted((repr(r.doc_id), r.text, [tuple(s) for s in r.removed]) for r in found)
    assert sorted(map(repr, got)) == sorted(map(repr, remaining))
    assert df.columns == found[0].__fields__[:-1]


def test_common_short_lines_stay_and_long_passages_go(spark):
    passage = " ".join(f"Sentence number {i} holds some seven words." for i in range(9))
    rows = [(i, f"Good morning to you all.\nOwn text of document {i} here. {passage} End {i}.") for i in range(5)]
    found = unit_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        assert (passage in r.text) == (r.doc_id == 0)
        assert "Good morning to you all." in r.text and f"End {r.doc_id}." in r.text


def test_empty_table_long_text_and_clash(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert unit_dedup.remove_repeats(empty).count() == 0
    with pytest.raises(ValueError, match="removed"):
        unit_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string, removed int"))
    long = "One more line of many words.\n" * 40_000
    found = unit_dedup.remove_repeats(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()
    assert found[0].text.strip() == "One more line of many words."


def test_query_matches_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    wanted = brute_force(docs)
    for r in op6_repeated_units(spark, folder).collect():
        text = dict(docs)[r.doc_id]
        assert [tuple(s) for s in r.removed] == wanted[r.doc_id, text]
        assert r.text == cut(text, wanted[r.doc_id, text])


def test_lists_of_short_units_go(spark):
    menu = "\n".join(f"dish{i} price{i}" for i in range(30))
    rows = [
        (1, f"First house\n{menu}\nOpen late"),
        (2, f"Second house\n{menu}\nClosed now"),
        (3, "\n".join(f"dish{i} price{i + 1}" for i in range(29))),
        (4, "\n".join(f"dish{i} price{i}" for i in range(12))),
        (None, f"A sentence of its own.\n{menu}"),
    ]
    found = {r.doc_id: r.text for r in unit_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert found == {**texts, 2: "Second house\n\nClosed now", None: "A sentence of its own.\n"}


def test_user_columns_of_any_name_stay(spark):
    line = "One line of more than a few words that two documents share with each other here. " * 3
    rows = [(1, line, "a", 7), (2, line, "b", 8), (3, "Alone.", "c", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _of string, _id int")
    found = unit_dedup.remove_repeats(df).collect()
    assert sorted((r.doc_id, r["_of"], r["_id"]) for r in found) == [(k, o, i) for k, _, o, i in rows]


def test_without_limits_every_repeated_line_goes(spark):
    """Plain method, told independently of the operator's units: lines without ends of sentences."""
    rng = random.Random(11)
    lines = [" ".join(rng.choices(["one", "Two,", "three", "vier", "cinq"], k=rng.randint(1, 6))) for _ in range(30)]
    lines.append("a line of eleven words that six documents of this table share")
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 12)) + [lines[-1]] * (i % 3 == 0))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in unit_dedup.remove_repeats(df, min_words=1, unit_words=1).collect()}
    seen = set()
    for i, text in rows:
        kept = []
        for line in text.split("\n"):
            key = line.lower().replace(",", "").strip()
            if key and key not in seen:
                kept.append(line)
                seen.add(key)
        assert [x for x in found[i].text.split("\n") if x] == kept
        # Original offsets are retained.
        assert cut(text, [tuple(s) for s in found[i].removed]) == found[i].text
    assert sum("eleven words" in r.text for r in found.values()) == 1

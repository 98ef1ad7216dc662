import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from registrum.llm import ppm
from registrum.llm.queries import op12_partial_matching

SCHEMA = "doc_id long, text string, slice string, score int, word int"
ORDER = 5


def plain_tokens(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", low)]


class Plain:
    """Dictionaries of contexts, byte by byte."""

    def __init__(self, texts):
        self.trie = defaultdict(Counter)
        self.words = Counter()
        for text in texts:
            words = plain_tokens(text)
            self.words.update([*words, b"\n"])
            body = b"\n" * ORDER + b"".join(w + b" " for w in words) + b"\n"
            for i in range(ORDER, len(body)):
                for k in range(ORDER + 1):
                    self.trie[body[i - k : i]][body[i]] += 1

    def byte(self, before: bytes, symbol: int) -> float:
        out, excluded = 0.0, set()
        for k in range(ORDER, -1, -1):
            own = {s: n for s, n in self.trie.get(before[len(before) - k :], {}).items() if s not in excluded}
            if not own:
                continue
            total = sum(own.values())
            if symbol in own:
                return out + math.log10((2 * own[symbol] - 1) / (2 * total))
            out += math.log10(len(own) / (2 * total))
            excluded |= set(own)
        return out - math.log10(256 - len(excluded))

    def row(self, text):
        words = plain_tokens(text)
        body = b"\n" * ORDER + b"".join(w + b" " for w in words) + b"\n"
        score = sum(self.byte(body[i - ORDER : i], body[i]) for i in range(ORDER, len(body)))
        every = [*words, b"\n"]
        n, v = sum(self.words.values()), len(self.words)
        base = sum(math.log10((self.words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in every)
        return len(every), sum(self.words[w] > 0 for w in every), n, base, score


def held_out(key):
    return zlib.crc32(str(key).encode()) % 5 == 1


def check(rows, found):
    model = Plain(t for k, t in rows if k is not None and not held_out(k))
    wanted = sorted((k if k is not None else -1, *model.row(t)) for k, t in rows)
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    assert [w[:4] for w in wanted] == [g[:4] for g in got]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in wanted], rtol=1e-5, atol=1e-6)


def run(df, buckets=7):
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5))
    slices = ppm.sliced(df, remainder != 1)
    return ppm.score(slices, ppm.fit(slices, buckets)).collect()


@pytest.mark.parametrize("small", [False, True])
def test_matches_brute_force(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(ppm, "SLICE_BYTES", 60)
        monkeypatch.setattr(ppm, "CHUNK", 16)
        monkeypatch.setattr(ppm, "ASKING", 2)
        monkeypatch.setattr(ppm, "FAN", 2)
        monkeypatch.setattr(ppm, "WORDS", 5)
    texts = ["The cat sat on the mat", None, "", "the CAT\tsat\x0bagain\n\n", "Ünï cödé   wörds", "a" * 200, "the cat sat on the mat"]
    texts += [f"the {w} of the {w} is here" for w in ("house", "mouse", "horse", "hearse", "zebra")]
    rows = [(i, t) for i, t in enumerate(texts)] + [(40, "same"), (40, "same"), (None, "null id here"), (41, "\x00\x1c odd \x85")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)
    check(rows, run(df))


def test_nothing_learnt_and_empty(spark):
    key = next(k for k in range(100) if held_out(k))
    found = run(spark.createDataFrame([(key, "abc", "x", 1, 2)], SCHEMA))
    assert found[0].train_tokens == 0 and found[0].n_known == 0
    assert found[0].score == pytest.approx(-5 * math.log10(256), rel=1e-6)
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_probabilities_sum_to_one():
    """All 256 bytes after any context, seen or not."""
    rng = np.random.default_rng(1)
    body = bytes(rng.choice(list(b"abcd "), 400).tolist()) + b"\n"
    cut = ppm.Slice.of([body])
    found, real = next(cut.chunks())
    keys, counts = np.unique(found[real], return_counts=True)
    short = ((keys >> np.uint64(32)) << np.uint64(8)) | (keys & np.uint64(255))
    every = ppm.levels(keys, counts.astype(np.int64), ppm.merged([short], [counts.astype(np.int64)]))
    contexts = [bytes(c) for c in itertools.product(b"ab ", repeat=3)] + [b"zzz", b"zza", b"zab"]
    for context in contexts:
        whole = np.frombuffer((b"cd" + context), np.uint8)
        key = sum(int(b) << (8 * (1 + i)) for i, b in enumerate(whole))
        asked = np.array([key | s for s in range(256)], np.uint64)
        assert (10 ** ppm.code_lengths(asked, every)).sum() == pytest.approx(1.0, abs=1e-9)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = op12_partial_matching(spark, folder).collect()
    assert {r.doc_id: r.held_out for r in found} == {d.doc_id: held_out(d.doc_id) for d in docs}
    check([(d.doc_id, d.text) for d in docs], found)


def test_ranked_places_are_those_of_a_search(monkeypatch):
    from registrum.llm import ppm

    cut = ppm.Slice.of([b"ab ab abc \n", b"\n", b"abc \n", b"b ab ab \n"])
    for size in (ppm.CHUNK, 7):
        monkeypatch.setattr(ppm, "CHUNK", size)
        keys, found = ppm.ranked(cut)
        assert keys.tolist() == ppm.distinct(cut).tolist()
        for (some, real), (mask, places) in zip(cut.chunks(), found, strict=True):
            assert mask.tolist() == real.tolist()
            assert keys[places].tolist() == some[real].tolist()
    own = ppm.bucket_of(keys, 300)
    assert ppm.by_bucket(own, 300).tolist() == sorted(range(len(own)), key=lambda i: own[i])


def test_ranked_sorts_small_blocks(monkeypatch):
    from registrum.llm import ppm

    assert ppm.BLOCK <= 1 << 64 - 8 * (ppm.ORDER + 1)
    cut, sizes = ppm.Slice.of([b"ab ab abc \n" * 500, b"\n", b"\xff\xfe \n"]), []
    monkeypatch.setattr(ppm, "BLOCK", 100)
    for name in ("sort", "argsort"):
        whole = getattr(ppm.np, name)
        monkeypatch.setattr(ppm.np, name, lambda values, *a, whole=whole, **b: sizes.append(len(values)) or whole(values, *a, **b))
    keys, [(real, places)] = ppm.ranked(cut)
    [(some, _)] = cut.chunks()
    # The last is the distinct grams of the blocks.
    assert max(sizes[:-1]) <= 100 and sizes[-1] < len(some) / 2
    assert ppm.distinct(cut).tolist() == keys.tolist()
    assert keys[places].tolist() == some[real].tolist()
    found, at = ppm.ranked_words([b"b", b"a", b"\xff", b"b", ppm.END_WORD])
    assert found == [b" ", b"a", b"b", b"\xff"] and at.tolist() == [2, 1, 3, 2, 0]
    assert ppm.ranked_words([])[0] == []

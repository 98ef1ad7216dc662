import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from registrum.llm import packing
from registrum.llm.queries import op7_concatenate_and_cut

WORD = path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, part long, place string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def expected_ids(library, text: str | None) -> list[int]:
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def check_pieces(rows, wanted: dict[int, list[int]], window: int) -> None:
    by_doc: dict[int, list] = {}
    by_window: dict[int, list] = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == wanted.keys()
    for doc, found in by_doc.items():
        ids = wanted[doc]
        at = 0
        for r in sorted(found, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            piece = np.array(ids[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(piece)
            at += r.length
        assert at == len(ids)
    assert by_window.keys() == set(range(len(by_window)))
    for sequence, found in by_window.items():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or sequence == max(by_window)


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_pieces_and_windows(spark, library, parts):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate([None, "", "one two three", "same", "same", "w é, " * 900, "end"])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts, "doc_id")
    encoded = packing.encode_partitions(df, WORD, end_id=2)
    from pyspark.sql import functions as F

    found = packing.pieces(encoded, 64).withColumn("ids_crc32", F.crc32("ids")).collect()
    wanted = {r[0]: expected_ids(library, r[1]) for r in rows}
    check_pieces(found, wanted, 64)
    whole = {r.sequence_id: r for r in packing.windows(encoded, 0, 64).collect()}
    for sequence in {r.sequence_id for r in found}:
        own = sorted((r for r in found if r.sequence_id == sequence), key=lambda r: r.offset)
        ids = np.frombuffer(b"".join(bytes(r.ids) for r in own), "<u4").tolist()
        assert whole[sequence].n_tokens == len(ids)
        assert whole[sequence].ids == ids + [0] * (64 - len(ids))
    assert len(whole) == len({r.sequence_id for r in found})


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    encoded = packing.encode_partitions(df, WORD, end_id=2)
    assert packing.pieces(encoded).count() == 0
    assert packing.windows(encoded, 0).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    wanted = {d.doc_id: expected_ids(library, d.text) for d in docs}
    check_pieces(op7_concatenate_and_cut(spark, folder).collect(), wanted, 4096)


def test_parts_have_the_ids_of_the_whole(library):
    words = ["Word", "word's", "don't,", "ABC...", "x_y", "a1", "é!", "Été,", "<|endoftext|>", "w<|endoftext|>", "w<|", "I'm!!", "('quote')"]
    words += [w + m for w in ("The", "zz", "Straße") for m in packing.MARKS] + ["end.'", "a.b", "ﬁn.", "İ.", "K", "ÀÇÑß,", "µm", "1ª", "e\u0301.", "ÿ!", "Ÿ!", "Āb."]
    memo = packing._memo(WORD)
    for word in words:
        assert np.frombuffer(memo.ids([word])[0], "<u4").tolist() == library.encode(word, add_special_tokens=False).ids, word


def test_a_chunk_met_again_is_not_learnt_again(monkeypatch):
    from registrum.llm import packing

    monkeypatch.setattr(packing, "CHUNK_ENTRIES", 2)
    asked = []

    def encode(parts):
        asked.extend(p for p in parts if p)
        return [p.encode() for p in parts]

    memo = packing.Memo(encode, encode)
    learnt = []
    learn = memo._learn
    monkeypatch.setattr(memo, "_learn", lambda chunks: (learnt.extend(chunks), learn(chunks)))
    for text in ("One, two.", "one, TWO! 3x", "one, 3x ..."):
        assert memo.ids([text]) == [text.lower().replace(" ", "").encode()]
    assert sorted(learnt) == sorted(["One,", "two.", "one,", "TWO!", "3x", "..."])
    assert sorted(asked) == sorted(["one", ",", "two", ".", "!", "3x", "..."])


def test_a_chunk_that_repeats_is_looked_up_once():
    class Known(dict):
        asked = 0

        def __getitem__(self, chunk):
            Known.asked += 1
            return super().__getitem__(chunk)

    def encode(parts):
        return [np.array([ord(c) for c in p], "<u4").tobytes() for p in parts]

    memo = packing.Memo(encode, encode)
    memo._chunks = Known({"": b""})
    texts = ["the end\nof  the end " * 300, "", "\n", "é the 日本", "of"]
    found = memo.ids(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in found] == [[ord(c) for c in t if c not in " \n"] for t in texts]
    assert 0 < Known.asked <= 6
    assert memo.ids([]) == []

import hashlib
import random

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from registrum.llm import forced_bpe
from registrum.llm.bpe_vocab import vocabulary
from registrum.llm.queries import op10_forced_boundary_bpe

WORD = path("word_bpe_49k.json")
PIECES = [
    *"aebcdxyz AÉéÈß'’\n\t.,!́  İıΣς中文漢日本🎉1234½²ªºµﬁ",
    "<|endoftext|>", "<|startoftext|>", "'s", "'RE", "각", "Å", "ạ̇",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def encoded(text: str) -> list[int]:
    return np.frombuffer(vocabulary(WORD).memo.ids([text])[0], "<u4").tolist()


def test_random_texts_match_the_library(library):
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 30)))
        assert encoded(text) == library.encode(text, add_special_tokens=False).ids, text


def test_long_words_match_the_library(library):
    for text in ("a" * 5000, "ab" * 2000 + "q" * 30, "é" * 999, "zxqj" * 400):
        assert encoded(text) == library.encode(text, add_special_tokens=False).ids


def test_cuts_stand_where_no_token_has_the_pair():
    vocab = vocabulary(WORD)
    word = vocab.as_symbols("qxjkzé中abc")
    fragments = vocab.forced_fragments(word)
    assert "".join(fragments) == word
    assert len(fragments) > 1
    for a, b in zip(fragments, fragments[1:]):
        assert (a[-1], b[0]) not in vocab.inside


def test_null_empty_long_and_repeated_texts(spark, library):
    rows = [(1, None), (2, ""), (3, "Same text."), (4, "Same text."), (5, "word é " * 60_000), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    both = forced_bpe.decode(forced_bpe.encode(df, WORD), WORD).collect()
    assert len(both) == len(rows)
    for row in both:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_clashing_names_and_empty_table(spark):
    df = spark.createDataFrame([], "ids int, text string")
    with pytest.raises(ValueError, match="ids"):
        forced_bpe.encode(df, WORD)
    assert forced_bpe.encode(df, WORD, output="own").count() == 0


def test_query_matches_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op10_forced_boundary_bpe(spark, folder).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(docs[row.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_a_known_word_is_not_cut_again(monkeypatch):
    import public_tokenizers

    from registrum.llm import bpe_vocab

    vocab = bpe_vocab.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(bpe_vocab, "REMEMBER_WORDS", 2)
    first = vocab.chunk_ids("Thandering")
    cut = []
    fragments = vocab.forced_fragments
    monkeypatch.setattr(vocab, "forced_fragments", lambda word: cut.append(word) or fragments(word))
    marks = vocab.chunk_ids(",")
    # The word moves on to the next generation each time.
    for chunk in ("thandering,", "THANDERING", "other", "Thandering,"):
        assert vocab.chunk_ids(chunk) == (vocab.chunk_ids("other") if chunk == "other" else first + marks * chunk.endswith(","))
    assert cut == [",", "other"]

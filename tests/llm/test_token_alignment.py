import hashlib
import os
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from registrum.llm import perfect_hash, token_alignment
from registrum.llm.queries import op11_perfect_hash_alignment

FILES = token_alignment.Vocabularies(
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
    public_tokenizers.path("piece_bpe_32k.model"),
)
SCHEMA = "doc_id long, text string, row string, first int, n_a long"
TEXTS = [
    "The quick brown fox, it's 12345!", None, "", "the the the", "  two  blanks \n\n and lines\t", "Ünïcödé straße 東京 🙂🙂",
    "<|endoftext|> is <s>plain</s> text <unk>", "a▁b", "The quick brown fox, it's 12345!", "x" * 3000, " odd blank", "!!!???", "<0x41>",
]


@pytest.fixture(scope="module")
def library():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer, sentencepiece.SentencePieceProcessor(model_file=FILES.pieces)


def byte_table() -> dict[str, int]:
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute(library, rows):
    tokenizer, pieces = library
    table, docs = byte_table(), []
    for key, text in rows:
        ends_a = ends_b = []
        if text:
            whole = (" " + text).encode()
            a = tokenizer.encode(" " + text, add_special_tokens=False).ids
            bytes_a = [bytes(table[c] for c in tokenizer.id_to_token(i)) for i in a]
            b = pieces.encode(text)
            names = [pieces.id_to_piece(i) for i in b]
            bytes_b = [bytes([int(n[3:5], 16)]) if pieces.is_byte(i) else n.replace("▁", " ").encode() for i, n in zip(b, names)]
            if b"".join(bytes_a) == whole == b"".join(bytes_b):
                ends_a = list(zip(a, np.cumsum([*map(len, bytes_a)]).tolist(), map(len, bytes_a)))
                ends_b = list(zip(b, np.cumsum([*map(len, bytes_b)]).tolist(), map(len, bytes_b)))
        links = []
        for i, (x, stop, n) in enumerate(ends_a):
            links += [(x, y) for y, end, m in ends_b if end > stop - n and end - m < stop]
        groups, begin = [], 0
        for cut in sorted({e for _, e, _ in ends_a} & {e for _, e, _ in ends_b}):
            sides = [",".join(str(t) for t, e, _ in side if begin < e <= cut) for side in (ends_a, ends_b)]
            groups.append("|".join(sides))
            begin = cut
        docs.append((key, len(ends_a), len(ends_b), groups, links))
    counts = Counter(p for *_, links in docs for p in set(links))
    best: dict[int, int] = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    return sorted(
        (k or -1, a, b, len(g), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for k, a, b, g, links in docs
    )


def found(df):
    return sorted((r.doc_id or -1, *r[1:]) for r in df.collect())


@pytest.mark.parametrize("band_pairs", [1 << 22, 40])
def test_matches_brute_force(spark, library, monkeypatch, band_pairs):
    monkeypatch.setattr(token_alignment, "PIECE_PAIRS", 16)
    monkeypatch.setattr(token_alignment, "VECTOR_SLICE", 8)
    monkeypatch.setattr(token_alignment, "FAN", 2)
    monkeypatch.setattr(token_alignment, "SLICE_CHARS", 40)
    monkeypatch.setattr(token_alignment, "SLICE_TOKENS", 30)
    monkeypatch.setattr(token_alignment, "MERGE_PAIRS", 20)
    rows = [(i, t) for i, t in enumerate(TEXTS, 1)] + [(None, "null id"), (3, "same id"), (3, "same id")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(5)
    assert found(token_alignment.link_counts(df, FILES, band_pairs=band_pairs)) == brute(library, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert token_alignment.link_counts(df, FILES).collect() == []
    nothing = spark.createDataFrame([(1, None, "x", 1, 2)], SCHEMA)
    assert found(token_alignment.link_counts(nothing, FILES)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    rows = [r for r in rows if len(r[1]) < 20_000]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(token_alignment.link_counts(docs, FILES)) == brute(library, rows)
    assert op11_perfect_hash_alignment(spark, folder).count() == 200


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ranks_equal_the_json_file(text):
    from tokenizers import Tokenizer

    global _JSON
    if "_JSON" not in globals():
        _JSON = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        _JSON.encode_special_tokens = True
    ours = token_alignment._pair(FILES).first.encode_ordinary(" " + text)
    assert ours == _JSON.encode(" " + text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 48, n)).astype(np.int64)
    pieces = 1 + n // 500
    own = perfect_hash.piece_of(keys, pieces)
    whole = perfect_hash.PerfectHash.joined([perfect_hash.build_piece(keys[own == p]) for p in range(pieces)])
    assert sorted(whole.numbers(keys)) == list(range(len(keys)))
    assert (whole.numbers(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()
    with pytest.raises(ValueError):
        perfect_hash.build_piece(np.array([7, 7]))

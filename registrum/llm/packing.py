"""Packing by concatenation: all documents are one stream of ids, cut into fixed windows.

Pass one encodes each partition, counts ids from the partition's start and writes the result;
the totals of the partitions (one row each) give every partition's place in the stream. Pass
two adds that place and cuts at multiples of the window. Only the last window is not full.

A window that lies within what one task reads is put out as it is. The parts of the others are
boundary records, which alone are shuffled and joined by their window.

Null text counts as empty; an empty document has the end id alone. A null document id stays
null, repeated rows are packed as often as they occur, an empty table gives no window. Other
columns of the documents are not carried along, so their names cannot clash.
"""

from __future__ import annotations

import functools
import os
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrum.llm.chunk_memo import CHARS
from registrum.llm.forced_bpe import slices
from registrum.session import write_and_reread

WINDOW = 4096
CHUNK_ENTRIES = 200_000
PART_ENTRIES = 150_000
WORD_BATCH = 2_000
# Marks that never join a letter before them; an apostrophe may.
MARKS = '.,;:!?%$#*&@()[]{}"-+=/_|~^`'


@functools.lru_cache(maxsize=2)
def _memo(path: str) -> Memo:
    """What this worker remembers of the tokenizer's ids."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    # Of a word of plain letters only the last token closes a word.
    closing = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, i in tokenizer.get_vocab().items():
        closing[i] = token.endswith("</w>")

    def encode(parts: list[str]) -> list[bytes]:
        found = tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found]

    def encode_words(words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start in range(0, len(words), WORD_BATCH):
            some = words[start : start + WORD_BATCH]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(closing[ids]) + 1)
            if len(ends) != len(some):  # some token of a word is not in the vocabulary
                out += encode(some)
                continue
            whole = ids.tobytes()
            out += [whole[x:y] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
        return out

    return Memo(encode, encode_words)


class Memo:
    """Remembers, in two generations each, the ids of the chunks between blanks and those of their parts.

    A chunk of Latin-1 letters with marks after it has two parts, which the tokenizer takes apart as
    well, the letters without regard to case; any other chunk is one part.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], encode_words: Callable[[list[str]], list[bytes]]) -> None:
        self._encode, self._encode_words = encode, encode_words
        self._chunks: dict[str, bytes] = {"": b""}
        self._older_chunks: dict[str, bytes] = {}
        self._parts: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self._chunks) > CHUNK_ENTRIES:
            # What is met again moves on, the rest goes with the next turn.
            self._chunks, self._older_chunks = {"": b""}, self._chunks
        known, older = self._chunks, self._older_chunks
        rows = pc.split_pattern(pa.array([t.replace("\n", " ") for t in texts], pa.large_string()), " ")
        # Most chunks of the texts occur more than once; each is looked up once.
        found = rows.flatten().dictionary_encode()
        chunks = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = [c for c in chunks if c not in known]
        known.update([(c, older[c]) for c in missing if c in older])
        self._learn([c for c in missing if c not in known])
        each = pa.array(list(map(known.__getitem__, chunks)), pa.large_binary()).take(found.indices)
        joined = pc.binary_join(pa.ListArray.from_arrays(rows.offsets, each), pa.scalar(b"", pa.large_binary()))
        out = joined.to_numpy(zero_copy_only=False).tolist()
        for chunk in missing:
            if len(chunk) > CHARS:
                del known[chunk]
        return out

    def _learn(self, chunks: list[str]) -> None:
        if len(self._parts) > PART_ENTRIES:
            self._parts, self._older = {}, self._parts
        parts, older = self._parts, self._older
        words, marks = [], []
        plain_words, other = set(), set()
        for chunk in chunks:
            word = chunk.rstrip(MARKS)
            if word.isalpha() and (word.isascii() or max(word) <= "ÿ"):
                mark, word = chunk[len(word) :], word.lower()
                plain_words.add(word)
                marks.append(mark)
                words.append(word)
            else:
                other.add(chunk)
                words.append(chunk)
                marks.append("")
        other.update(marks)

        def unknown(some: set[str]) -> list[str]:
            missing = [p for p in some if p not in parts]
            parts.update([(p, older[p]) for p in missing if p in older])
            return [p for p in missing if p not in parts]

        plain, others = unknown(plain_words), unknown(other)
        parts.update(zip(plain, self._encode_words(plain)))
        parts.update(zip(others, self._encode(others)))
        learnt = zip(map(parts.__getitem__, words), map(parts.__getitem__, marks))
        self._chunks.update(zip(chunks, [a + b if b else a for a, b in learnt]))
        for p in (*plain, *others):
            if len(p) > CHARS:
                del parts[p]


def encode_partitions(
    df: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pass one, written to the shared folder: the ids of each document with the end id, its
    partition and the number of ids before it there."""
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "ids", "doc_tokens", "part", "before"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for start, stop in slices(map(len, texts)):
                ids = [b + end for b in _memo(path).ids(texts[start:stop])]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                places = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array(ids, pa.binary()),
                        pa.array(sizes),
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(places),
                    ],
                    names,
                )

    kind = dict(df.dtypes)[doc_id]
    schema = f"doc_id {kind}, ids binary, doc_tokens long, part int, before long"
    return write_and_reread(df.select(doc_id, text).mapInArrow(run, schema), "packing")


def placed(encoded: DataFrame) -> DataFrame:
    """Adds ``place``: the number of ids before the document in the whole stream."""
    totals = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("total"))
    # One row per partition of pass one, whatever the size of the documents.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    joined = encoded.join(F.broadcast(bases), "part")
    return joined.select("doc_id", "ids", "doc_tokens", (F.col("base") + F.col("before")).alias("place"))


def pieces(encoded: DataFrame, window: int = WINDOW) -> DataFrame:
    """Pass two: the part of each document that lies in each window.

    Columns doc_id, start (ids of the document before the piece), length, ids, doc_tokens,
    sequence_id and offset (ids in the window before the piece).
    """
    size, last = F.lit(window).cast("long"), F.col("place") + F.col("doc_tokens") - 1
    cut = placed(encoded).select(
        "*",
        F.explode(F.sequence(F.floor(F.col("place") / size), F.floor(last / size))).alias("sequence_id"),
    )
    first = F.col("sequence_id") * size
    start = F.greatest(first - F.col("place"), F.lit(0).cast("long"))
    stop = F.least(first + size - F.col("place"), F.col("doc_tokens"))
    cut = cut.withColumns({"start": start, "length": stop - start})
    return cut.select(
        "doc_id",
        "start",
        "length",
        F.substring("ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")).alias("ids"),
        "doc_tokens",
        "sequence_id",
        F.greatest(F.col("place") - F.col("sequence_id") * size, F.lit(0).cast("long")).alias("offset"),
    )


def windows(encoded: DataFrame, pad_id: int, window: int = WINDOW) -> DataFrame:
    """The windows: sequence_id, ids (padded to ``window``), n_tokens."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = bytearray(), 0  # ids from place ``at`` on that are not yet put out
        for batch in batches:
            out: list[tuple[int, int, bytes]] = []
            for ids, place in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if place != at + len(held) // 4:
                    out.extend(parts(held, at))
                    held, at = bytearray(), place
                held += ids
                full = (at + len(held) // 4) // window * window  # ids before this place are whole
                if full > at:
                    out.extend(parts(held[: 4 * (full - at)], at))
                    del held[: 4 * (full - at)]
                    at = full
            yield as_batch(out)
        yield as_batch(parts(held, at))

    def parts(held: bytearray, at: int) -> list[tuple[int, int, bytes]]:
        out, done = [], 0
        while done < len(held) // 4:
            sequence, offset = divmod(at + done, window)
            take = min(window - offset, len(held) // 4 - done)
            out.append((sequence, offset, bytes(held[4 * done : 4 * (done + take)])))
            done += take
        return out

    def as_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else ([], [], [])
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["sequence_id", "offset", "ids"]
        )

    def pad(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b, "<u4").astype(np.int32) for b in batch.column(1).to_pylist()]
            whole = [np.pad(x, (0, window - len(x)), constant_values=pad_id) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(whole, pa.list_(pa.int32())), pa.array([len(x) for x in ids], pa.int64())],
                ["sequence_id", "ids", "n_tokens"],
            )

    cut = write_and_reread(
        placed(encoded).select("ids", "place").mapInArrow(run, "sequence_id long, offset long, ids binary"),
        "windows",
    )
    whole = F.length("ids") == 4 * window
    # A window has at most ``window`` boundary records, so a group is bounded.
    joined = cut.where(~whole).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("records")
    )
    empty = F.lit(b"")
    merged = joined.select(
        "sequence_id", F.aggregate("records", empty, lambda done, r: F.concat(done, r["ids"])).alias("ids")
    )
    every = cut.where(whole).select("sequence_id", "ids").unionByName(merged)
    return every.mapInArrow(pad, "sequence_id long, ids array<int>, n_tokens long")

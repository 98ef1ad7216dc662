"""Language-model scores by prediction by partial matching, pretrained on the corpus.

A text is its words (runs of bytes that are no ASCII white space, A-Z lower-cased), each followed
by a blank, and one line feed as the end. Every byte is predicted from the ``ORDER`` bytes before
it. Where that context was not seen, or not with this byte, the model escapes to the next shorter
context: with D symbols that occurred n_s times, T in all, a symbol has (2 n_s - 1) / 2T and the escape
D / 2T; symbols of the longer context are excluded from n, T and D of the shorter one. Below the
empty context all 256 bytes that are not excluded are alike. The probabilities of all token
sequences sum to at most one.

The trie of contexts is a table. Reading contexts backwards, a subtrie is rooted at the three
nearest bytes; subtries are dealt to ``buckets``, and so are the words, whose counts give the base
score. Counts are gathered per slice or task, then merged as a tree, so neither a frequent context
nor a hot bucket meets in one task unmerged. Contexts of up to two bytes hold at most 2^24 counts
whatever the corpus, these are broadcast.

To score, documents are cut into slices of about ``SLICE_BYTES``, one row each and written. A
slice asks every bucket for the code lengths of its distinct grams and the counts of its distinct
words; the bucket is repeated once per ``ASKING`` slices, so the answering groups are bounded too.
Answers return to their slice, where each document's code length is summed over all its bytes.
Keys, counts and texts travel as differences by byte plane, compressed.

Null text counts as empty: one end token. Equal texts get equal scores. Repeated rows learn and
are scored as often as they occur; a null id stays null, and where ``learns`` is null the document
does not learn. With nothing learnt, every byte has 1 / 256. Other columns are not carried along. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.session import write_and_reread

ORDER = 5
ROOT = 3  # bytes that root a subtrie
SLICE_BYTES = 4 << 20
CHUNK = 1 << 22
BLOCK = 1 << 16  # grams sorted together with their positions
ASKING = 512
FAN = 16
WORDS = 300_000  # distinct words that a task counts before it passes them on
END = b"\n"
END_WORD = b" "  # the end token among words, which hold no blank
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def tokens(text: str | None) -> list[bytes]:
    """Words without the end token. ``bytes.split`` cuts at \\x20 and \\x09 to \\x0D."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def body_of(words: list[bytes]) -> bytes:
    return b" ".join([*words, END])


def grams(body: np.ndarray, start: int, stop: int) -> np.ndarray:
    """The gram of each byte from ``start`` to ``stop``: the ORDER bytes before it, nearest first,
    then the byte, as one number. ``body`` has ORDER line feeds before each document."""
    out = np.zeros(stop - start, np.uint64)
    for back in range(1, ORDER + 1):
        out |= body[start - back : stop - back]
        out <<= np.uint64(8)
    out |= body[start:stop]
    return out


@dataclass
class Slice:
    """Documents side by side: ``flat`` has each body with its padding, ``spans`` the bodies."""

    flat: np.ndarray
    spans: np.ndarray  # begin and end of each body

    @classmethod
    def of(cls, bodies: list[bytes]) -> Slice:
        flat = np.frombuffer(b"".join(x for b in bodies for x in (END * ORDER, b)), np.uint8)
        ends = np.cumsum([ORDER + len(b) for b in bodies]).astype(np.int64)
        return cls(flat, np.column_stack([ends - [len(b) for b in bodies], ends]))

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The grams of all bytes, CHUNK at a time, and which of them are no padding."""
        real = np.ones(len(self.flat), bool)
        for back in range(1, ORDER + 1):
            real[self.spans[:, 0] - back] = False
        for start in range(ORDER, len(self.flat), CHUNK):
            stop = min(start + CHUNK, len(self.flat))
            yield grams(self.flat, start, stop), real[start:stop]


def packed(values: np.ndarray) -> bytes:
    """Compressed, byte plane by byte plane."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    return packed(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob, np.uint64), dtype=np.uint64)


def packed_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(END.join(words))


def unpacked_words(blob: bytes) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(blob)
    return whole.split(END) if whole else []


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate([np.empty(0, np.uint64), *keys])
    order = np.argsort(every, kind="stable")
    every, many = every[order], np.concatenate([np.empty(0, np.int64), *counts])[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, np.int64)
    return every[first], np.add.reduceat(many, first) if len(first) else many


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Grams whose contexts agree in their nearest bytes share a bucket."""
    root = keys >> np.uint64(8 * (ORDER + 1 - ROOT))
    mixed = root * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def by_bucket(own: np.ndarray, buckets: int) -> np.ndarray:
    """The order of the buckets; numbers of 16 bits are sorted in one pass, not by comparison."""
    return np.argsort(own.astype(np.min_scalar_type(buckets)), kind="stable")


def sliced(df: DataFrame, learns, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """slice, ids, learns, sizes and text, written: one row per about ``SLICE_BYTES``. Ids are
    long integers or text."""
    kind = "bigint" if df.schema[doc_id].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint") else "string"
    arrow = pa.int64() if kind == "bigint" else pa.string()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids: list = []
        marks: list[bool] = []
        bodies: list[bytes] = []
        size = 0

        def row() -> pa.RecordBatch:
            columns = [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(arrow)),
                pa.array([marks], pa.list_(pa.bool_())),
                pa.array([[len(b) for b in bodies]], pa.list_(pa.int64())),
                pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(bodies))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["slice", "ids", "learns", "sizes", "text"])

        for batch in batches:
            for i in range(batch.num_rows):
                ids.append(batch.column(0)[i].as_py())
                bodies.append(body_of(tokens(batch.column(1)[i].as_py())))
                marks.append(bool(batch.column(2)[i].as_py()))
                size += len(bodies[-1]) + ORDER
                if size >= SLICE_BYTES:
                    yield row()
                    number += 1
                    ids, marks, bodies, size = [], [], [], 0
        if ids:
            yield row()

    source = df.select(F.col(doc_id).cast(kind).alias("id"), F.col(text).alias("text"), learns.alias("learns"))
    schema = f"slice long, ids array<{kind}>, learns array<boolean>, sizes array<long>, text binary"
    return write_and_reread(source.mapInArrow(run, schema), "slices")


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """One slice at a time, whatever the size of the batch, with its bodies."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            whole, at, bodies = zstandard.ZstdDecompressor().decompress(row.pop("text")), 0, []
            for size in row["sizes"]:
                bodies.append(whole[at : at + size])
                at += size
            yield row | {"bodies": bodies}


def words_of(bodies: list[bytes]) -> list[bytes]:
    """The tokens of all bodies; ``END_WORD`` stands for each end."""
    every: list[bytes] = []
    for body in bodies:
        every += body.split()
        every.append(END_WORD)
    return every


@dataclass(frozen=True)
class Model:
    """``trie`` has bucket, keys, counts (sorted grams and how often they occurred), words and
    word_counts, all packed."""

    trie: DataFrame
    buckets: int
    low: tuple[np.ndarray, np.ndarray]  # grams of contexts of up to two bytes, with counts
    tokens: int
    words: int


TRIE = "bucket long, node long, keys binary, counts binary, words binary, word_counts binary"


def _blob(bucket: int, node: int, keys: np.ndarray, counts: np.ndarray, words: dict[bytes, int]) -> pa.RecordBatch:
    many = np.fromiter(words.values(), np.int64, len(words))
    columns = [
        pa.array([bucket], pa.int64()),
        pa.array([node], pa.int64()),
        *(pa.array([p], pa.binary()) for p in (packed_keys(keys), packed(counts), packed_words(list(words)), packed(many))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "node", "keys", "counts", "words", "word_counts"])


def _dealt(words, buckets: int) -> list[list[bytes]]:
    out: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in words:
        out[zlib.crc32(word) % buckets].append(word)
    return out


def fit(slices: DataFrame, buckets: int) -> Model:
    """The trie of all documents that learn, and the counts of their words."""
    none = np.empty(0, np.uint64), np.empty(0, np.int64)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = none
        words: Counter[bytes] = Counter()
        node = TaskContext.get().partitionId()

        def counted() -> Iterator[pa.RecordBatch]:
            for b, mine in enumerate(_dealt(words, buckets)):
                if mine:
                    yield _blob(b, node, *none, {w: words[w] for w in sorted(mine)})

        for row in _rows(batches):
            bodies = [b for b, learns in zip(row["bodies"], row["learns"]) if learns]
            if not bodies:
                continue
            words.update(words_of(bodies))
            if len(words) > WORDS:
                yield from counted()
                words.clear()
            for found, real in Slice.of(bodies).chunks():
                some, many = np.unique(found[real], return_counts=True)
                keys, counts = merged([keys, some], [counts, many])
        yield from counted()
        own = bucket_of(keys, buckets)
        order = by_bucket(own, buckets)
        bounds = np.searchsorted(own[order], np.arange(buckets + 1))
        for b in range(buckets):
            mine = order[bounds[b] : bounds[b + 1]]
            if len(mine):
                yield _blob(b, node, keys[mine], counts[mine], {})

    def add(table: pa.Table) -> pa.Table:
        # Sets of one bucket from FAN nodes.
        keys = [unpacked_keys(v.as_py()) for v in table["keys"]]
        counts = [unpacked(v.as_py(), np.int64) for v in table["counts"]]
        words: dict[bytes, int] = {}
        for some, many in zip(table["words"], table["word_counts"]):
            for word, n in zip(unpacked_words(some.as_py()), unpacked(many.as_py(), np.int64).tolist()):
                words[word] = words.get(word, 0) + n
        bucket, node = table["bucket"][0].as_py(), table["node"][0].as_py()
        return pa.Table.from_batches([_blob(bucket, node, *merged(keys, counts), dict(sorted(words.items())))])

    trie = write_and_reread(slices.select("learns", "sizes", "text").mapInArrow(count, TRIE), "trie")
    tallest = trie.agg(F.max("node")).first()[0] or 0
    while True:
        up = trie.withColumn("node", F.floor(F.col("node") / FAN))
        trie = write_and_reread(up.groupBy("bucket", "node").applyInArrow(add, TRIE), "trie")
        tallest //= FAN
        if not tallest:
            break

    def lower(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column(0), batch.column(1)):
                key = unpacked_keys(keys.as_py())
                short = ((key >> np.uint64(8 * (ORDER - 2 + 1))) << np.uint64(8)) | (key & np.uint64(255))
                some, many = merged([short], [unpacked(counts.as_py(), np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int64)), pa.array(many)], ["gram", "n"])

    def sizes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = [unpacked(v.as_py(), np.int64) for v in batch.column(0)]
            columns = [pa.array([len(m) for m in many], pa.int64()), pa.array([int(m.sum()) for m in many], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["words", "tokens"])

    low = trie.select("keys", "counts").mapInArrow(lower, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    # At most 2^24 rows, however large the corpus.
    table = low.orderBy("gram").toArrow()
    total = trie.select("word_counts").mapInArrow(sizes, "words long, tokens long").agg(
        F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")
    ).first()
    grams_, many = table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy()
    return Model(trie, buckets, (grams_, many), total.tokens, total.words)


class Level:
    """The contexts of one order with their symbols; ``keys`` are sorted context-and-symbol numbers."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys, self.counts = keys, counts
        context = keys >> np.uint64(8)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.empty(0, np.int64)
        self.contexts = context[first]
        self.totals = np.add.reduceat(counts, first) if len(first) else np.empty(0, np.int64)
        self.symbols = np.diff(np.append(first, len(keys)))

    def shorter(self) -> Level:
        """The level of contexts without their farthest byte."""
        short = ((self.keys >> np.uint64(16)) << np.uint64(8)) | (self.keys & np.uint64(255))
        return Level(*merged([short], [self.counts]))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Counts of context-and-symbol numbers, 0 where there is none."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)

    def node(self, contexts: np.ndarray) -> np.ndarray:
        """The place of each context, -1 where there is none."""
        if not len(self.contexts):
            return np.full(len(contexts), -1)
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        return np.where(self.contexts[at] == contexts, at, -1)


def levels(keys: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> list[Level]:
    """Levels from ORDER down to 0: a bucket's own down to ROOT, the shared ones below."""
    out = [Level(keys, counts)]
    while len(out) < ORDER - ROOT + 1:
        out.append(out[-1].shorter())
    out.append(Level(*low))
    while len(out) < ORDER + 1:
        out.append(out[-1].shorter())
    return out


def code_lengths(asked: np.ndarray, every: list[Level]) -> np.ndarray:
    """log10 of the probability of each gram's byte after its context."""
    out = np.zeros(len(asked))
    left = np.arange(len(asked))
    # Node of the longer context that was escaped from, with the level it belongs to.
    above = np.full(len(asked), -1)
    above_level = np.full(len(asked), -1)
    symbol = asked & np.uint64(255)
    # What a longer context excludes from a shorter one, per node of the longer one.
    for depth, level in enumerate(every):
        if not len(left):
            break
        context = asked[left] >> np.uint64(8 * (depth + 1))
        node = level.node(context)
        seen = node >= 0
        rows, node = left[seen], node[seen]
        total, kinds = level.totals[node].copy(), level.symbols[node].copy()
        for upper in range(depth):
            from_here = np.flatnonzero(above_level[rows] == upper)
            if not len(from_here):
                continue
            longer = every[upper]
            nodes, inverse = np.unique(above[rows[from_here]], return_inverse=True)
            gone, many = _excluded(longer, nodes, level, depth - upper)
            total[from_here] -= gone[inverse]
            kinds[from_here] -= many[inverse]
        own = level.find((context[seen] << np.uint64(8)) | symbol[rows])
        hit = own > 0
        out[rows[hit]] += np.log10((2 * own[hit] - 1) / (2 * total[hit]))
        miss = ~hit
        escape = miss & (kinds > 0)
        out[rows[escape]] += np.log10(kinds[escape] / (2 * total[escape]))
        above[rows[miss]], above_level[rows[miss]] = node[miss], depth
        gone = np.zeros(len(left), bool)
        gone[np.flatnonzero(seen)[hit]] = True
        left = left[~gone]
    # No context knows the byte: all that are not excluded are alike.
    known = np.zeros(len(left), np.int64)
    lowest = every[-1]
    if len(lowest.symbols):
        known[:] = lowest.symbols[0]
    out[left] -= np.log10(256 - known)
    return out


def _excluded(longer: Level, nodes: np.ndarray, shorter: Level, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and number of the symbols of ``nodes`` in their shorter context."""
    starts = np.cumsum(longer.symbols) - longer.symbols
    sizes = longer.symbols[nodes]
    before = np.cumsum(sizes) - sizes
    pairs = np.arange(int(sizes.sum())) + np.repeat(starts[nodes] - before, sizes)
    keys = longer.keys[pairs]
    short = ((keys >> np.uint64(8 * (steps + 1))) << np.uint64(8)) | (keys & np.uint64(255))
    # The shorter context has every symbol of the longer one.
    return np.add.reduceat(shorter.find(short), before), sizes


def lookups(slices: DataFrame, model: Model, repeats: int) -> DataFrame:
    """slice, bucket, lengths and counts: the code lengths of the slice's distinct grams of that
    bucket and the counts of its distinct words, in their order. The trie is repeated ``repeats`` times."""
    buckets = model.buckets

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = distinct(Slice.of(row["bodies"]))
            own = bucket_of(keys, buckets)
            order = by_bucket(own, buckets)
            bounds = np.searchsorted(own[order], np.arange(buckets + 1))
            words = _dealt(ranked_words(words_of(row["bodies"]))[0], buckets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(buckets), pa.int64()),
                    pa.array([row["slice"] % repeats] * buckets, pa.int64()),
                    pa.array([row["slice"]] * buckets, pa.int64()),
                    pa.array([packed_keys(keys[order[x:y]]) for x, y in zip(bounds, bounds[1:])], pa.binary()),
                    pa.array([packed_words(w) for w in words], pa.binary()),
                ],
                ["bucket", "copy", "slice", "asked", "asked_words"],
            )

    schema = "bucket long, copy long, slice long, asked binary, asked_words binary"
    asked = slices.select("slice", "sizes", "text").mapInArrow(ask, schema)
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(repeats - 1).cast("long"))).alias("copy")
    copies = model.trie.select("bucket", copy, "keys", "counts", "words", "word_counts")
    shared = slices.sparkSession.sparkContext.broadcast(model.low)

    def answer(mine: pa.Table, trie: pa.Table) -> pa.Table:
        keys, counts, known = np.empty(0, np.uint64), np.empty(0, np.int64), {}
        if trie.num_rows:
            keys = unpacked_keys(trie["keys"][0].as_py())
            counts = unpacked(trie["counts"][0].as_py(), np.int64)
            many = unpacked(trie["word_counts"][0].as_py(), np.int64).tolist()
            known = dict(zip(unpacked_words(trie["words"][0].as_py()), many))
        every = levels(keys, counts, shared.value)
        # Slices share most of their grams; each is worked out once.
        whole = np.empty(0, np.uint64)
        for v in mine["asked"]:
            whole = distinct_sorted(np.concatenate([whole, unpacked_keys(v.as_py())]))
        lengths = code_lengths(whole, every).astype(np.float32)
        out = [packed(lengths[np.searchsorted(whole, unpacked_keys(v.as_py()))]) for v in mine["asked"]]
        found = [
            packed(np.array([known.get(w, 0) for w in unpacked_words(v.as_py())], np.int64)) for v in mine["asked_words"]
        ]
        columns = [mine["slice"], mine["bucket"], pa.array(out, pa.binary()), pa.array(found, pa.binary())]
        return pa.Table.from_arrays(columns, ["slice", "bucket", "lengths", "counts"])

    grouped = asked.groupBy("bucket", "copy").cogroup(copies.groupBy("bucket", "copy"))
    return grouped.applyInArrow(answer, "slice long, bucket long, lengths binary, counts binary")


def distinct(cut: Slice) -> np.ndarray:
    keys = np.empty(0, np.uint64)
    for found, real in cut.chunks():
        some = distinct_sorted(found[real])
        keys = distinct_sorted(np.concatenate([keys, some])) if len(keys) else some
    return keys


def ranked(cut: Slice) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The distinct grams and, for each chunk, which bytes are no padding and their grams' places.

    Grams are sorted together with their position, BLOCK at a time: both fit into one number, and
    a block into the processor's cache. The distinct grams of a block are then looked up in order."""
    low = np.uint64(64 - 8 * (ORDER + 1))  # bits that a gram leaves
    parts: list[tuple[np.ndarray, list]] = []
    for found, real in cut.chunks():
        some, blocks = found[real] << low, []
        for start in range(0, len(some), BLOCK):
            mine = some[start : start + BLOCK]
            mine = np.sort(mine | np.arange(len(mine), dtype=np.uint64))
            gram = mine >> low
            new = np.concatenate([[True], gram[1:] != gram[:-1]])
            inverse = np.empty(len(mine), np.intp)
            inverse[(mine & np.uint64((1 << int(low)) - 1)).astype(np.intp)] = np.cumsum(new) - 1
            blocks.append((gram[new], inverse))
        parts.append((real, blocks))
    none = np.empty(0, np.uint64)
    keys = distinct_sorted(np.concatenate([none, *(own for _, blocks in parts for own, _ in blocks)]))

    def places(blocks: list) -> np.ndarray:
        return np.concatenate([np.empty(0, np.intp), *(np.searchsorted(keys, own)[at] for own, at in blocks)])

    return keys, [(real, places(blocks)) for real, blocks in parts]


def ranked_words(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, ascending, and the place of each word."""
    found = pa.array(words, pa.large_binary()).dictionary_encode()
    order = pc.sort_indices(found.dictionary)
    place = np.empty(len(order), np.intp)
    place[order.to_numpy()] = np.arange(len(order))
    return found.dictionary.take(order).to_numpy(zero_copy_only=False).tolist(), place[found.indices.to_numpy()]


def score(slices: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of every document."""
    lengths = lookups(slices, model, max(1, math.ceil(slices.count() / ASKING)))
    answered = lengths.groupBy("slice").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "lengths", "counts"))).alias("answers")
    )
    total, room, buckets = model.tokens, model.tokens + 0.5 * (model.words + 1), model.buckets
    kind = slices.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            bodies = row["bodies"]
            cut = Slice.of(bodies)
            keys, parts_of = ranked(cut)
            logs = np.empty(len(keys), np.float32)
            found = [unpacked(p["lengths"], np.float32) for p in row["answers"]]
            logs[by_bucket(bucket_of(keys, buckets), buckets)] = np.concatenate(found)
            parts = [np.zeros(ORDER)]
            for real, at in parts_of:
                part = np.zeros(len(real))
                part[real] = logs[at]
                parts.append(part)
            every = np.concatenate(parts)
            words, at = ranked_words(words_of(bodies))
            base: dict[bytes, float] = {}
            for mine, p in zip(_dealt(words, buckets), row["answers"]):
                base.update(zip(mine, np.log10((unpacked(p["counts"], np.int64) + 0.5) / room).tolist()))
            each = np.fromiter(map(base.__getitem__, words), np.float64, len(words))[at]
            sizes = np.array([b.count(b" ") + 1 for b in bodies])
            starts = np.cumsum(sizes) - sizes
            columns = [
                pa.array(row["ids"], pa.int64() if kind == "bigint" else pa.string()),
                pa.array(sizes),
                # A word without a count has the least value there is.
                pa.array(np.add.reduceat((each > math.log10(0.75 / room)).astype(np.int64), starts)),
                pa.array(np.full(len(bodies), total)),
                pa.array(np.add.reduceat(each, starts)),
                pa.array(np.array([every[x:y].sum() for x, y in cut.spans])),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
            )

    schema = f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return slices.join(answered, "slice").mapInArrow(run, schema)

"""Alignment of two tokenizers over one text, with corpus-wide counts of linked tokens.

Both tokenizers cut the bytes of blank + text. Where tokens of both end, a group ends; tokens of
either side whose byte ranges overlap are linked. How many documents hold a pair of ids linked is
counted over all documents with a minimal perfect hash:

1. every document is encoded once; its ids are written to the shared folder;
2. the distinct pairs of all documents are found and hashed, in pieces of bounded size;
3. each task counts documents in a dense vector with a place per pair; the vectors are summed as a
   tree, in slices;
4. a second pass aligns the documents again and looks their links up by hash, checking the key.

What a task holds of the pairs, and what is broadcast, is bounded: pairs are dealt to bands of
about ``BAND_PAIRS`` by a hash, and steps 3 and 4 run band after band. The best count of an id
has a place per id of the first vocabulary.

A null or empty text, or one whose tokens do not spell blank + text in either vocabulary, has no
tokens: zeros and an empty digest. Repeated rows count as documents each and get rows each; a
null id stays null. Other columns are not carried along. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.llm.forced_bpe import slices
from registrum.llm.perfect_hash import PerfectHash, build_piece, mixed, piece_of
from registrum.session import fresh_path, write_and_reread

SLICE_CHARS = 250_000
SLICE_TOKENS = 1 << 17
BAND_PAIRS = 1 << 22
MERGE_PAIRS = 1 << 20
PIECE_PAIRS = 1 << 15
VECTOR_SLICE = 1 << 16
FAN = 16


@dataclass(frozen=True)
class Vocabularies:
    """Files of a byte-level BPE (ranks by line, split by ``pattern``) and of a piece model."""

    ranks: str
    pattern: str
    pieces: str


class _Pair:
    """Both tokenizers, and the bytes each id stands for."""

    def __init__(self, files: Vocabularies) -> None:
        import sentencepiece
        import tiktoken

        with open(files.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        # No special tokens: their strings in a text are plain text.
        self.first = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        size = 1 + max(ranks.values())
        self.first_bytes = [b""] * size
        for token, rank in ranks.items():
            self.first_bytes[rank] = token
        self.second_bytes = []
        for i in range(self.second.get_piece_size()):
            piece = self.second.id_to_piece(i)
            byte = self.second.is_byte(i)
            self.second_bytes.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode())
        # Ids travel in two bytes where both vocabularies fit.
        self.kind = np.dtype("<u2" if max(size, len(self.second_bytes)) <= 1 << 16 else "<u4")
        self.first_lengths = np.array([len(b) for b in self.first_bytes])
        self.second_lengths = np.array([len(b) for b in self.second_bytes])
        # Ids as decimal text, followed by what may come after them.
        ids = range(max(size, len(self.second_bytes)))
        self.printed = np.array([f"{i}{end}" for end in (",", "|", ";", "") for i in ids], object)
        self.print_step = len(ids)


@functools.lru_cache(maxsize=1)
def _pair(files: Vocabularies) -> _Pair:
    return _Pair(files)


def encode(df: DataFrame, files: Vocabularies, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row, doc_id, first and second: the ids as little-endian numbers, written to the shared
    folder. ``row`` tells rows apart."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = _pair(files), TaskContext.get().partitionId() << 33
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for start, stop in slices(lengths.tolist(), SLICE_CHARS):
                some = [t or "" for t in batch.column(1).slice(start, stop - start).to_pylist()]
                seconds = pair.second.encode(some, num_threads=1)
                first, second = [], []
                for t, b in zip(some, seconds):
                    a = pair.first.encode_ordinary(" " + t) if t else []
                    whole = (" " + t).encode()
                    spelled = b"".join(map(pair.second_bytes.__getitem__, b))
                    if not t or spelled != whole or b"".join(map(pair.first_bytes.__getitem__, a)) != whole:
                        a, b = [], []
                    first.append(np.array(a, pair.kind).tobytes())
                    second.append(np.array(b, pair.kind).tobytes())
                ids = batch.column(0).slice(start, stop - start)
                rows = pa.array(np.arange(row, row + stop - start))
                row += stop - start
                yield pa.RecordBatch.from_arrays(
                    [rows, ids, pa.array(first, pa.binary()), pa.array(second, pa.binary())],
                    ["row", "doc_id", "first", "second"],
                )

    kind = dict(df.dtypes)[doc_id]
    schema = f"row long, doc_id {kind}, first binary, second binary"
    return write_and_reread(df.select(doc_id, text).mapInArrow(run, schema), "encoded")


@dataclass
class Aligned:
    """The links of a run of documents."""

    first: np.ndarray  # ids
    second: np.ndarray
    first_counts: np.ndarray  # per document
    second_counts: np.ndarray
    groups: np.ndarray  # of each first token, then of each second token
    groups_second: np.ndarray
    pairs: np.ndarray  # first id and second id of each link as one number
    owners: np.ndarray  # document of each link


def _flat(column: pa.Array, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column and their number per row, without a copy as Python objects."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2] or b""
    size = kind.itemsize
    ids = np.frombuffer(body, kind, (offsets[-1] - offsets[0]) // size, offsets[0]) if offsets[-1] > offsets[0] else []
    return np.asarray(ids, np.int64), np.diff(offsets).astype(np.int64) // size


def align(pair: _Pair, batch: pa.RecordBatch) -> Aligned:
    """``batch`` has first and second."""
    (first, many_first), (second, many_second) = (_flat(batch.column(c), pair.kind) for c in ("first", "second"))
    counts = many_first, many_second
    # Both sides spell the same bytes document by document, so offsets may run on.
    ends, other = np.cumsum(pair.first_lengths[first]), np.cumsum(pair.second_lengths[second])
    begins = ends - pair.first_lengths[first]
    common = np.intersect1d(ends, other, assume_unique=True)
    low = np.searchsorted(other, begins, "right")
    high = np.searchsorted(other, ends, "left")
    many = high - low + 1 if len(first) else np.empty(0, np.int64)
    before = np.cumsum(many) - many
    which = np.arange(int(many.sum())) + np.repeat(low - before, many)
    pairs = (np.repeat(first, many) << 32) | second[which]
    owners = np.repeat(np.repeat(np.arange(batch.num_rows), many_first), many)
    return Aligned(
        first,
        second,
        *counts,
        np.searchsorted(common, ends, "left"),
        np.searchsorted(common, other, "left"),
        pairs,
        owners,
    )


def group_texts(pair: _Pair, found: Aligned) -> list[str]:
    """Each document's groups as text: a1,a2|b1;a3|b2,b3."""
    a, b = found.groups, found.groups_second
    total = (int(a[-1]) + 1) if len(a) else 0
    sizes_a, sizes_b = np.bincount(a, minlength=total), np.bincount(b, minlength=total)
    place_a = np.arange(len(a)) + (np.cumsum(sizes_b) - sizes_b)[a]
    place_b = np.arange(len(b)) + np.cumsum(sizes_a)[b]
    ids = np.empty(len(a) + len(b), np.int64)
    ids[place_a], ids[place_b] = found.first, found.second
    ending = np.zeros(len(ids), np.int64)
    last = np.cumsum(sizes_a + sizes_b) - 1
    ending[last] = 2
    ending[last - sizes_b] = 1
    bounds = np.concatenate([[0], np.cumsum(found.first_counts + found.second_counts)])
    ends = bounds[1:][np.diff(bounds) > 0] - 1
    ending[ends] = 3
    words = pair.printed[ids + ending * pair.print_step].tolist()
    return ["".join(words[x:y]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.binary_length(batch.column("first")).to_numpy()
        for start, stop in slices(sizes.tolist(), 2 * SLICE_TOKENS):
            yield batch.slice(start, stop - start)


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def band_of(pairs: np.ndarray, bands: int) -> np.ndarray:
    return (mixed(pairs, 2000) % np.uint64(bands)).astype(np.int64)


def distinct_pairs(encoded: DataFrame, files: Vocabularies) -> DataFrame:
    """Column pair, written: all pairs of ids that some document links."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        seen = np.empty(0, np.int64)
        held, size = [], 0
        for part in _slices(batches):
            held.append(distinct(align(pair, part).pairs))
            size += len(held[-1])
            if size > MERGE_PAIRS:
                seen = distinct(np.concatenate([seen, *held]))
                held, size = [], 0
            if len(seen) > BAND_PAIRS:  # bounded memory; equal pairs meet in the shuffle
                yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])
                seen = np.empty(0, np.int64)
        seen = distinct(np.concatenate([seen, *held]))
        yield pa.RecordBatch.from_arrays([pa.array(seen)], ["pair"])

    return write_and_reread(encoded.select("first", "second").mapInArrow(run, "pair long").distinct(), "pairs")


def hash_band(pairs: DataFrame, band: int, bands: int, pieces: int) -> DataFrame:
    """The pieces of the perfect hash of a band's pairs, built by tasks and written."""

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            keys = keys[band_of(keys, bands) == band]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(piece_of(keys, pieces))], ["pair", "piece"])

    def build(table: pa.Table) -> pa.Table:
        levels, keys = build_piece(table["pair"].to_numpy())
        columns = [
            table["piece"].slice(0, 1),
            pa.array([[w.tobytes() for w in levels]], pa.list_(pa.binary())),
            pa.array([keys.tobytes()], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, ["piece", "levels", "keys"])

    dealt = pairs.mapInArrow(deal, "pair long, piece long").groupBy("piece")
    # About PIECE_PAIRS rows a group.
    return write_and_reread(dealt.applyInArrow(build, "piece long, levels array<binary>, keys binary"), "pieces")


def joined(built: DataFrame, pieces: int) -> PerfectHash:
    """The pieces of one band side by side: about BAND_PAIRS keys."""
    rows = built.collect()
    found = {r.piece: ([np.frombuffer(w, "<u8") for w in r.levels], np.frombuffer(r.keys, "<u8")) for r in rows}
    nothing = ([], np.empty(0, np.uint64))
    return PerfectHash.joined([found.get(p, nothing) for p in range(pieces)])


def count_band(encoded: DataFrame, files: Vocabularies, shared, size: int) -> DataFrame:
    """Documents per number of the band's hash, written in slices: dense vectors of tasks, summed
    as a tree."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, hashed = _pair(files), shared.value
        counts = np.zeros(size, np.int64)
        some = False
        for part in _slices(batches):
            found = align(pair, part)
            if not len(found.pairs):
                continue
            some = True
            numbers = hashed.numbers(found.pairs)
            own = numbers >= 0
            once = distinct(found.owners[own] * size + numbers[own]) % size
            counts += np.bincount(once, minlength=size)
        if not some:
            return
        task = TaskContext.get().partitionId()
        starts = range(0, size, VECTOR_SLICE)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(starts)), pa.int64()),
                pa.array([task] * len(starts), pa.int64()),
                pa.array([counts[s : s + VECTOR_SLICE].tobytes() for s in starts], pa.binary()),
            ],
            ["slice", "node", "counts"],
        )

    def add(table: pa.Table) -> pa.Table:
        # At most FAN vectors of VECTOR_SLICE places.
        total = sum(np.frombuffer(v.as_buffer(), np.int64) for v in table["counts"])
        columns = [table["slice"].slice(0, 1), table["node"].slice(0, 1), pa.array([total.tobytes()], pa.binary())]
        return pa.Table.from_arrays(columns, ["slice", "node", "counts"])

    schema = "slice long, node long, counts binary"
    vectors = write_and_reread(encoded.select("first", "second").mapInArrow(run, schema), "vectors")
    tallest = vectors.agg(F.max("node")).first()[0]
    while tallest:
        up = vectors.withColumn("node", F.floor(F.col("node") / FAN))
        vectors = write_and_reread(up.groupBy("slice", "node").applyInArrow(add, schema), "vectors")
        tallest //= FAN
    return vectors


def dense(vectors: DataFrame, size: int) -> np.ndarray:
    rows = sorted((r.slice, bytes(r.counts)) for r in vectors.collect())
    return np.frombuffer(b"".join(v for _, v in rows), np.int64) if rows else np.zeros(size, np.int64)


def link_counts(
    df: DataFrame, files: Vocabularies, doc_id: str = "doc_id", text: str = "text", band_pairs: int = BAND_PAIRS
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = df.sparkSession
    encoded = encode(df, files, doc_id, text)
    pairs = distinct_pairs(encoded, files)
    total = pairs.count()
    bands = max(1, math.ceil(total / band_pairs))
    pieces = max(1, math.ceil(total / bands / PIECE_PAIRS))
    best = np.zeros(1, np.int64)
    counted = []  # tables in the shared folder; the driver holds one band at a time
    for band in range(bands):
        built = hash_band(pairs, band, bands, pieces)
        hashed = joined(built, pieces)
        shared = spark.sparkContext.broadcast(hashed)
        vectors = count_band(encoded, files, shared, len(hashed.keys))
        shared.destroy()
        # A place per id of the first vocabulary, whatever the corpus.
        first = (hashed.keys >> np.uint64(32)).astype(np.int64)
        size = max(len(best), int(first.max(initial=0)) + 1)
        best = np.pad(best, (0, size - len(best)))
        np.maximum.at(best, first, dense(vectors, len(hashed.keys)))
        counted.append((built, vectors))
    path = fresh_path(spark, "linked")
    kind = dict(encoded.dtypes)["doc_id"]
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    schema = ", ".join(["row long", f"doc_id {kind}", *(f"{c} long" for c in numbers), "groups_sha256 string"])
    for band, (built, vectors) in enumerate(counted):
        hashed = joined(built, pieces)
        shared = spark.sparkContext.broadcast((hashed, dense(vectors, len(hashed.keys)), best))
        looked = encoded.mapInArrow(_look_up(files, shared, band == 0), schema)
        looked.write.mode("append").parquet(path)
        shared.destroy()
    parts = spark.read.schema(schema).parquet(path)
    # What a row gets from each band adds up; the first band alone brings the rest.
    return parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), *(F.sum(c).alias(c) for c in numbers), F.max("groups_sha256").alias("groups_sha256")
    ).drop("row")


def _look_up(files: Vocabularies, shared, whole: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        hashed, counts, best = shared.value
        places = np.append(counts, 0)
        top = np.append(counts == best[(hashed.keys >> np.uint64(32)).astype(np.int64)], False)
        for batch in _slices(batches):
            found = align(pair, batch)
            n = batch.num_rows
            numbers = hashed.numbers(found.pairs)
            sums = [
                found.first_counts,
                found.second_counts,
                np.zeros(n, np.int64),
                np.bincount(found.owners, minlength=n),
            ]
            digests = [None] * n
            if whole:
                texts = group_texts(pair, found)
                sums[2] = np.array([t.count(";") + 1 if t else 0 for t in texts], np.int64)
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            else:
                sums = [np.zeros(n, np.int64)] * 4
            # Links lie document by document; the sum up to each one gives every document's share.
            upto = np.concatenate([[0], np.cumsum(places[numbers])])
            bounds = np.searchsorted(found.owners, np.arange(n + 1))
            sums += [np.bincount(found.owners[top[numbers]], minlength=n), np.diff(upto[bounds])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    batch.column("doc_id"),
                    *(pa.array(np.asarray(s, np.int64)) for s in sums),
                    pa.array(digests, pa.string()),
                ],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return run

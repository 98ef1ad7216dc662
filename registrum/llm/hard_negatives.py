"""Hard negatives by an inverted multi-index, exact.

Vectors are cut into two halves. A codebook per half, fitted on a bounded sample, gives every
row a cell (one code per half). A row's score with an anchor is at most the sum of two half
bounds: anchor half times code plus length of the anchor half times radius of the code, the
radius being the largest distance of a row of that code, over all rows. Cells are visited from
the largest sum downwards with a heap over the two sorted lists of half bounds (the
multi-sequence walk). A search ends once the next sum certifies its window: either the k-th row
found scores more, or no row left can reach the window's lower end.

Positives are an anchor's best rows of its own label, one window without an upper end. Each
positive's score then opens a window for rows of other labels.

The index is one table, sorted by cell and cut into even ranges, so a cell that holds a third of
all rows spans many tasks. Anchors are taken in blocks of at most ``ANCHOR_BYTES``; a block is
broadcast, its result written, and the broadcast destroyed before the next one.

Rows without an id or a label, or whose vector is null or holds null or non-finite components,
take no part. Shorter vectors are filled up with zeros. Rows that share an id are candidates
each, but never of an anchor with that id; anchors that share an id are told apart by their row
and give rows each. Scores are exact integers; in the result they are clipped to 64 bits. Ties go
to the smaller id. An empty table, or one without anchors, gives an empty result. Other columns
are not carried along.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrum.session import fresh_path, write_and_reread

CODES = 16
SAMPLE_ROWS = 4096
STEPS = 12
ANCHOR_BYTES = 8 << 20
BLOCK_ROWS = 65_536


def integers(df: DataFrame, vec_id: str, embedding: str, label, scale: int) -> DataFrame:
    """id, label and vector (floor of scale times component, as double) of the rows that take part."""
    x = F.col(embedding)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    # Beyond 64 bits ``floor`` would clip; such a component is an integer already.
    big = F.transform(x, lambda v: v.cast("double") * scale)
    vector = F.zip_with(whole, big, lambda a, b: F.when(F.abs(b) < 2.0**62, a).otherwise(b))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = df.where(F.col(vec_id).isNotNull() & x.isNotNull() & label.isNotNull()).where(finite)
    return good.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"), vector.alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _codebook(rows: np.ndarray, codes: int) -> np.ndarray:
    """Centres by farthest-first seeds and a few rounds of means. Deterministic."""
    if not len(rows) or not rows.shape[1]:
        return np.zeros((1, rows.shape[1]))
    centres = [rows[0]]
    near = ((rows - rows[0]) ** 2).sum(1)
    while len(centres) < codes and near.max() > 0:
        centres.append(rows[near.argmax()])
        near = np.minimum(near, ((rows - centres[-1]) ** 2).sum(1))
    book = np.array(centres)
    for _ in range(STEPS):
        own = nearest(rows, book)
        counts = np.bincount(own, minlength=len(book))
        for c in np.flatnonzero(counts):
            book[c] = rows[own == c].mean(0)
    return book


def nearest(rows: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book**2).sum(1) - 2 * (rows @ book.T)).argmin(1)


@dataclass(frozen=True)
class Index:
    """``table`` has id, label, vector (bytes), first and second (codes of the halves)."""

    table: DataFrame
    width: int
    exact: bool  # doubles hold all scores exactly; otherwise Python's integers do
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]


def build(rows: DataFrame, codes: int = CODES, sample_rows: int = SAMPLE_ROWS) -> Index | None:
    """The index of all ``rows`` (id, label, vector). Codebooks rest on at most ``sample_rows``
    rows, the smallest by a hash; they decide what is fast, not what is found."""
    rows = write_and_reread(rows, "mined")
    facts = rows.select(
        F.max(F.size("vector")).alias("width"),
        F.max(F.array_max(F.transform("vector", lambda v: F.abs(v)))).alias("largest"),
    ).first()
    if facts.width is None:
        return None
    width = max(1, facts.width)
    exact = width * (facts.largest or 0.0) ** 2 < 2.0**52
    half = width // 2
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").toArrow()
    sample = _matrix(picked["vector"].combine_chunks(), width)
    books = _codebook(sample[:, :half], codes), _codebook(sample[:, half:], codes)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(2), width)
            parts = vectors[:, :half], vectors[:, half:]
            own = [nearest(p, b).astype(np.int32) for p, b in zip(parts, books)]
            far = [np.sqrt(((p - b[o]) ** 2).sum(1)) for p, b, o in zip(parts, books, own)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    *(pa.array(o) for o in own),
                    *(pa.array(f) for f in far),
                ],
                ["id", "label", "vector", "first", "second", "far_first", "far_second"],
            )

    schema = "id long, label long, vector binary, first int, second int, far_first double, far_second double"
    placed = rows.mapInArrow(place, schema)
    # Even ranges: the id breaks up a cell with many rows.
    placed = placed.repartitionByRange("first", "second", F.xxhash64("id")).sortWithinPartitions("first", "second")
    table = write_and_reread(placed, "multi-index")
    radii = []
    for book, code, far in ((books[0], "first", "far_first"), (books[1], "second", "far_second")):
        found = np.zeros(len(book))
        # One row per code.
        for r in table.groupBy(code).agg(F.max(far).alias("far")).collect():
            found[r[code]] = r.far
        radii.append(found)
    return Index(table.select("id", "label", "vector", "first", "second"), width, exact, books, (radii[0], radii[1]))


class Wanted:
    """The first ``k`` rows, by score and then id, whose score lies from ``low`` to ``high``."""

    def __init__(self, k: int, low=-math.inf, high=math.inf) -> None:
        self.k, self.low, self.high = k, low, high
        self.scores: list = []
        self.ids: list[int] = []

    def certified(self, bound: float) -> bool:
        """No row that scores at most ``bound`` can still enter."""
        return bound < self.low or (len(self.ids) == self.k and self.scores[-1] > bound)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        some = (scores >= self.low) & (scores <= self.high)
        if len(self.ids) == self.k:
            some &= scores >= self.scores[-1]
        if not some.any():
            return
        every = [*zip(self.scores, self.ids), *zip(scores[some].tolist(), ids[some].tolist())]
        every.sort(key=lambda item: (-item[0], item[1]))
        self.scores = [s for s, _ in every[: self.k]]
        self.ids = [i for _, i in every[: self.k]]


class Cells:
    """The rows of a block by cell."""

    def __init__(self, index_facts, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, first, second) -> None:
        self.books, self.radii, self.exact, self.half = index_facts
        self.of: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        cell = first.astype(np.int64) * len(self.books[1]) + second
        order = np.argsort(cell, kind="stable")
        bounds = np.flatnonzero(np.diff(cell[order])) + 1
        for own in np.split(order, bounds):
            if len(own):
                rows = vectors[own]
                if not self.exact:
                    rows = as_integers(rows)
                self.of[(int(first[own[0]]), int(second[own[0]]))] = ids[own], labels[own], rows
        self.firsts = np.unique(first)
        self.seconds = np.unique(second)

    def search(self, anchor: np.ndarray, anchor_id: int, label: int, same: bool, wanted: list[Wanted]) -> None:
        """Offers rows with or without the anchor's label, cell by cell in the order of their bounds."""
        halves = anchor[: self.half], anchor[self.half :]
        tops = []
        for codes, part, book, radius in zip((self.firsts, self.seconds), halves, self.books, self.radii):
            length = math.sqrt(float((part**2).sum()))
            top = book[codes] @ part + length * radius[codes]
            # Room for rounding.
            top = top + 1e-9 * (length * (np.sqrt((book[codes] ** 2).sum(1)) + radius[codes])) + 1e-6
            order = np.argsort(-top, kind="stable")
            tops.append((top[order].tolist(), codes[order].tolist()))
        (high, firsts), (right, seconds) = tops
        query = anchor if self.exact else as_integers(anchor[None, :])[0]
        heap = [(-(high[0] + right[0]), 0, 0)]
        while heap:
            minus, i, j = heapq.heappop(heap)
            if all(w.certified(-minus) for w in wanted):
                return
            # Each pair is pushed once: downwards from every pair, sideways from the top row.
            if i + 1 < len(high):
                heapq.heappush(heap, (-(high[i + 1] + right[j]), i + 1, j))
            if i == 0 and j + 1 < len(right):
                heapq.heappush(heap, (-(high[0] + right[j + 1]), 0, j + 1))
            rows = self.of.get((firsts[i], seconds[j]))
            if rows is None:
                continue
            ids, labels, vectors = rows
            some = (labels == label) == same
            some &= ids != anchor_id
            if some.any():
                scores = vectors[some] @ query
                for w in wanted:
                    w.offer(scores, ids[some])


def as_integers(rows: np.ndarray) -> np.ndarray:
    out = np.empty(rows.shape, object)
    out[...] = [[int(v) for v in row] for row in rows]
    return out


def _over_blocks(index: Index, search, schema: str) -> DataFrame:
    """``search(cells)`` yields result rows; a task holds one block of the index at a time."""
    facts = index.books, index.radii, index.exact, index.width // 2
    width = index.width
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string() if part.split()[1] == "string" else pa.int64() for part in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            vectors = np.frombuffer(b"".join(rows["vector"].to_pylist())).reshape(len(rows), width)
            own = (rows[c].to_numpy() for c in ("first", "second"))
            cells = Cells(facts, rows["id"].to_numpy(), rows["label"].to_numpy(), vectors, *own)
            out: list[tuple] = []
            for row in search(cells):
                out.append(row)
                if len(out) == 20_000:
                    yield as_batch(out)
                    out = []
            yield as_batch(out)

        def as_batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= BLOCK_ROWS:
                yield from result(held)
                held, size = [], 0
        if held:
            yield from result(held)

    return index.table.mapInArrow(run, schema)


def _exactly(score: str, exact: bool):
    """Sort keys that order decimal numbers of any length from high to low."""
    if exact:
        return [F.desc(score)]
    negative = F.col(score).startswith("-")
    digits = F.regexp_replace(score, "^-", "")
    size = F.when(negative, -F.length(digits)).otherwise(F.length(digits))
    turned = F.when(negative, F.translate(digits, "0123456789", "9876543210")).otherwise(digits)
    return [negative.asc(), size.desc(), turned.desc()]


def _clipped(score: str, exact: bool):
    if exact:
        return F.col(score)
    ends = F.when(F.col(score).startswith("-"), F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1))
    return F.coalesce(F.expr(f"try_cast({score} AS bigint)"), ends)


def mine(
    df: DataFrame,
    label=None,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    least_percent: int = 30,
    most_percent: int = 90,
    scale: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    codes: int = CODES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. Of an anchor's ``positives`` best rows
    of its label each opens a window: the first ``negatives`` rows of other labels whose score is
    from ``least_percent`` to ``most_percent`` of the positive's.
    """
    spark = df.sparkSession
    label = F.col("label") if label is None else label
    index = build(integers(df, vec_id, embedding, label, scale), codes)
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if index is None:
        return spark.createDataFrame([], empty)
    anchors = index.table.where(F.pmod("id", F.lit(every)) == 0)
    count = anchors.count()
    blocks = math.ceil(count * (index.width * 8 + 32) / ANCHOR_BYTES)
    path = fresh_path(spark, "negatives")
    kind = "long" if index.exact else "string"
    plain = int if index.exact else str
    # Anchors that share an id are different rows.
    number = F.row_number().over(Window.partitionBy("id").orderBy("label", "vector"))
    anchors = write_and_reread(anchors.select("id", "label", "vector", number.alias("copy")), "anchors")
    for block in range(blocks):
        mine_now = anchors.where(F.pmod(F.xxhash64("id", "copy"), F.lit(blocks)) == block).toArrow().to_pylist()
        if not mine_now:
            continue
        held = [(r["id"], r["copy"], r["label"], np.frombuffer(r["vector"])) for r in mine_now]
        shared = spark.sparkContext.broadcast(held)

        def best(cells: Cells, shared=shared):
            for key, copy, own, vector in shared.value:
                wanted = Wanted(positives)
                cells.search(vector, key, own, True, [wanted])
                for score, found in zip(wanted.scores, wanted.ids):
                    yield key, copy, found, plain(score)

        schema = f"anchor_id long, copy long, positive_id long, score {kind}"
        near = _over_blocks(index, best, schema)
        order = Window.partitionBy("anchor_id", "copy").orderBy(*_exactly("score", index.exact), "positive_id")
        near = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives)
        # At most ``positives`` rows per anchor of the block.
        chosen: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for r in near.collect():
            chosen.setdefault((r.anchor_id, r.copy), []).append((r.place, r.positive_id, int(r.score)))
        opened = spark.sparkContext.broadcast(chosen)

        def below(cells: Cells, shared=shared, opened=opened):
            for key, copy, own, vector in shared.value:
                pairs = [p for p in opened.value.get((key, copy), ()) if p[2] >= 0]
                wanted = [
                    Wanted(negatives, -((-least_percent * s) // 100), (most_percent * s) // 100) for _, _, s in pairs
                ]
                if not wanted:
                    continue
                cells.search(vector, key, own, False, wanted)
                for (place, positive, s), w in zip(pairs, wanted):
                    for score, found in zip(w.scores, w.ids):
                        yield key, copy, place, positive, plain(s), found, plain(score)

        schema = (
            f"anchor_id long, copy long, place long, positive_id long, positive_score {kind}, "
            f"negative_id long, negative_score {kind}"
        )
        order = Window.partitionBy("anchor_id", "copy", "place").orderBy(
            *_exactly("negative_score", index.exact), "negative_id"
        )
        found = _over_blocks(index, below, schema).withColumn("rank", F.row_number().over(order))
        found.where(F.col("rank") <= negatives).select(
            "anchor_id",
            "positive_id",
            "rank",
            "negative_id",
            _clipped("positive_score", index.exact).alias("positive_score"),
            _clipped("negative_score", index.exact).alias("negative_score"),
        ).write.mode("append").parquet(path)
        shared.destroy()
        opened.destroy()
    if not blocks:
        return spark.createDataFrame([], empty)
    return spark.read.schema(empty).parquet(path)

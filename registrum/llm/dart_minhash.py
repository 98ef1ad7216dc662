"""Near-duplicate documents by DartMinHash signatures and a banded join.

Elements are shingles of five words (lower case, punctuation at the ends of words dropped; a
shorter text is one shingle), their weight is the number of occurrences. Above each unit of an
element's weight lies a strip of ranks, cut into slabs that double in width. Hashing the
element, the unit and the slab gives the number of darts there (Poisson, one per unit of area)
and their ranks; each dart has one of ``SAMPLES`` coordinates. A document keeps the earliest
dart of every coordinate. It throws slab after slab until no coordinate is empty: for a text of
n shingles about n hashes per slab instead of n per coordinate. As all documents see the same
darts, two agree in a coordinate with a probability equal to their weighted Jaccard similarity.

Signatures are cut into ``BANDS`` bands; documents that share a band are candidates. At
``THRESHOLD`` a pair shares none with probability (1 - 0.8 ** 4) ** 24, about 3 in a million.
Candidates are compared exactly, and classes are the connected components of the links.

In a bucket every member is first compared with a few representatives only. Where the members
then belong to one class, nothing can be missing. Elsewhere, those outside the largest class of
the bucket are compared with all members, so no link between classes is lost, while a large
group of copies never gives all its pairs. Equal texts are one node from the start.

Defined results: every row is returned. Null and empty texts have no shingle and form one class.
Rows without an id belong to the class of their text; a class without any id has a null class
id. Repeated rows get equal classes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.llm.components import components
from registrum.llm.forced_bpe import slices
from registrum.llm.unit_dedup import ENDS, free_name
from registrum.session import write_and_reread

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
SAMPLES = BANDS * ROWS
REPRESENTATIVES = 3
# Outsiders and members of a bucket that one task compares.
OUTSIDERS = 256
MEMBERS = 512
# Width of the first slab: a text of 4096 shingles or more needs no other.
FIRST_SLAB = 2.0 ** -3
_WORDS = 300_000
# What a text costs besides its characters, and the cost of those sketched together.
_SHORT = 4_000
_TOGETHER = 400_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)) * 2.0**-53


class Words:
    """Hashes of words, remembered within bounds; 0 for what has no letter or digit."""

    def __init__(self) -> None:
        self._known: dict[str, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        known, chunks = self._known, text.split()
        if len(known) > _WORDS:
            known.clear()
        for chunk in set(chunks).difference(known):
            word = ENDS.sub("", chunk.lower())
            digest = blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
            known[chunk] = int.from_bytes(digest, "little") | 1 if word else 0
        found = np.fromiter(map(known.__getitem__, chunks), np.uint64, len(chunks))
        return found[found != 0]


def shingle_units(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of one text with their weights."""
    return shingles_of(words, np.array([len(words)]))[:2]


def shingles_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of texts that follow one another (their numbers of words in
    ``sizes``): shingles, weights, number of the text, in the order of the texts."""
    counts = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    stops = np.cumsum(counts)
    owner = np.repeat(np.arange(len(sizes)), counts)
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + np.arange(len(owner)) - np.repeat(stops - counts, counts)
    width = np.minimum(sizes, SHINGLE)[owner]
    shingles = width.astype(np.uint64)
    for size in np.unique(width).tolist():
        here = width == size
        part, first = shingles[here], starts[here]
        for i in range(size):
            part = mix(part * _STEP + words[first + i])
        shingles[here] = part
    sort_within(shingles, stops)
    first = np.flatnonzero(starts_of_runs(shingles, owner))
    return shingles[first], np.diff(first, append=len(shingles)), owner[first]


def sort_within(values: np.ndarray, stops: np.ndarray) -> None:
    """Sorts each text's stretch of ``values`` in place."""
    start = 0
    for stop in stops.tolist():
        values[start:stop].sort()
        start = stop


def starts_of_runs(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before it in the same text."""
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return new


def _poisson(mean: float) -> np.ndarray:
    """The distribution function of the number of darts in a cell."""
    terms = [np.exp(-mean)]
    for n in range(1, 24):
        terms.append(terms[-1] * mean / n)
    return np.cumsum(terms)


def signature(elements: np.ndarray, weights: np.ndarray, samples: int = SAMPLES) -> np.ndarray:
    """The earliest dart of each coordinate. Weights may be fractions; zeros take no part."""
    return signatures(elements, weights, np.zeros(len(elements), np.int64), 1, samples)[0]


def signatures(
    elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, samples: int = SAMPLES
) -> np.ndarray:
    """``signature`` of many texts at once, one row each; ``owner`` is the text of an element.
    All texts throw the darts of a slab together, and those without an empty coordinate leave."""
    weights = np.asarray(weights, np.float64)
    elements, owner, weights = elements[weights > 0], owner[weights > 0], weights[weights > 0]
    units = np.ceil(weights).astype(np.int64)
    number = np.arange(units.sum()) - np.repeat(np.cumsum(units) - units, units)
    strips = mix(np.repeat(elements, units) + mix(number.astype(np.uint64) + _STEP))
    room = np.minimum(np.repeat(weights, units) - number, 1.0)
    whole = bool((room == 1.0).all())
    base = np.repeat(owner, units) * samples
    best = np.zeros(texts * samples, np.uint64)
    empty = np.ones(texts * samples, bool)
    low, width, slab = 0.0, FIRST_SLAB, 0
    while len(strips):
        # Wide slabs are cut so that a cell holds one dart on average.
        cells = max(1, round(width))
        keys = strips if cells == 1 else (strips[:, None] + np.arange(cells, dtype=np.uint64) * _M1).ravel()
        keys = mix(keys ^ mix(np.full(1, slab + 1, np.uint64)))
        counts = np.searchsorted(_poisson(width / cells), uniform(mix(keys + _M2)), side="right")
        hit = np.flatnonzero(counts)
        of = np.repeat(hit, counts[hit])
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts[hit]) - counts[hit], counts[hit])
        darts = mix(keys[of] + (nth.astype(np.uint64) + np.uint64(1)) * _STEP)
        if not whole:
            inside = uniform(mix(darts ^ _M1)) < room[of // cells]
            of, darts = of[inside], darts[inside]
        places = base[of // cells] + (mix(darts ^ _STEP) % np.uint64(samples)).astype(np.int64)
        due = empty[places]
        of, darts, places = of[due], darts[due], places[due]
        ranks = low + (of % cells + uniform(mix(darts ^ _M2))) * (width / cells)
        # From the last dart to the first, so that the first stays.
        order = np.argsort(ranks, kind="stable")[::-1]
        best[places[order]] = darts[order]
        empty[places] = False
        going = empty.reshape(texts, samples).any(axis=1)[base // samples]
        if not going.all():
            strips, room, base = strips[going], room[going], base[going]
        low, width, slab = low + width, low + width, slab + 1
    return best.reshape(texts, samples)


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """The keys of the bands of each signature, one row each."""
    rows = sigs.reshape(-1, BANDS, ROWS)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(rows), 1))
    for i in range(ROWS):
        keys = mix(keys * _STEP + rows[:, :, i])
    return keys.view(np.int64)


def sketched(own: list[np.ndarray]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Nodes, band keys and units of texts, given the hashes of their words."""
    nodes = [int.from_bytes(blake2b(w.tobytes(), digest_size=8).digest(), "little", signed=True) for w in own]
    sizes = np.fromiter(map(len, own), np.int64, len(own))
    elements, weights, owner = shingles_of(np.concatenate(own), sizes)
    keys = band_keys(signatures(elements, weights, owner, len(own)))[sizes > 0]
    bounds = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
    nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    cells = mix(np.repeat(elements, weights) + nth.astype(np.uint64) * _STEP)
    units, owner = (cells >> np.uint64(32)).astype("<u4"), np.repeat(owner, weights)
    sort_within(units, np.cumsum(np.bincount(owner, minlength=len(own))))
    new = starts_of_runs(units, owner)
    units, owner = units[new], owner[new]
    stops = np.cumsum(np.bincount(owner, minlength=len(own))) * units.itemsize
    ends = np.concatenate([[0], stops]).astype(np.int32)
    return (
        pa.array(nodes, pa.int64()),
        pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys.ravel())),
        pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(units)]),
    )


def sketches(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Written to the shared folder: id, hash of the text, node (a hash of the words), keys of the bands, and the
    units of all shingles as sorted 32-bit hashes."""
    names = ["id", "version", "node", "keys", "units"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for start, stop in slices(map(len, texts)):
                # A short text throws about a thousand darts, a long one about one per eight words.
                costs = [_SHORT + len(t) for t in texts[start:stop]]
                for low, high in slices(costs, _TOGETHER):
                    own = [words.hashes(t) for t in texts[start + low : start + high]]
                    ids = [batch.column(c).slice(start + low, high - low) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*ids, *sketched(own)], names)

    schema = T.StructType([
        T.StructField("id", df.schema[doc_id].dataType),
        T.StructField("version", T.LongType()),
        T.StructField("node", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("units", T.BinaryType()),
    ])
    own = df.select(doc_id, F.xxhash64(text).alias("_v"), text)
    return write_and_reread(own.mapInArrow(run, schema), "sketches")


def similarity(one: bytes, other: bytes) -> float:
    a, b = np.frombuffer(one, "<u4"), np.frombuffer(other, "<u4")
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


class Forest:
    """Classes that grow by links, with path halving."""

    def __init__(self) -> None:
        self._parent: dict[int, int] = {}

    def top(self, node: int) -> int:
        parent = self._parent
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = node = parent[above]
        return node

    def join(self, one: int, other: int) -> None:
        self._parent[self.top(one)] = self.top(other)


def verified(pairs: DataFrame, contents: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) among the pairs (node, rep), compared exactly.

    A task leaves out what its earlier links connect already, so it returns fewer links than it
    has nodes, and the classes stay the same.
    """
    one = contents.select("node", F.col("units").alias("units_a"))
    other = contents.select(F.col("node").alias("rep"), F.col("units").alias("units_b"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            like = []
            for i, (x, y) in enumerate(zip(a, b)):
                new = forest.top(x) != forest.top(y)
                new = new and similarity(batch.column(2)[i].as_py(), batch.column(3)[i].as_py()) >= threshold
                if new:
                    forest.join(x, y)
                like.append(new)
            yield batch.select([0, 1]).rename_columns(["a", "b"]).filter(pa.array(like, pa.bool_()))

    # Sizes alone rule out many pairs before anything is compared.
    small, large = F.least(F.length("units_a"), F.length("units_b")), F.greatest(F.length("units_a"), F.length("units_b"))
    # The join by node comes last: all pairs of a node then meet in one task.
    joined = pairs.join(other, "rep").join(one, "node").where(small >= threshold * large)
    return joined.select("node", "rep", "units_a", "units_b").mapInArrow(run, "a long, b long")


def labelled(own: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The label of the class of every node that shares a band: see the head of this file."""
    members = own.select(F.explode("keys").alias("key"), "node").distinct()
    members = write_and_reread(members, "bands")
    # The member that comes first in several orders: aggregates, combined before the shuffle.
    nearest = [F.min_by("node", F.xxhash64("node", F.lit(i))).alias(f"r{i}") for i in range(REPRESENTATIVES)]
    buckets = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *nearest).where("n > 1")
    buckets = write_and_reread(buckets, "buckets")
    members = write_and_reread(members.join(buckets, "key"), "members")
    stars = members.select(
        "node", F.explode(F.array_distinct(F.array(*[f"r{i}" for i in range(REPRESENTATIVES)]))).alias("rep")
    ).where("node <> rep")
    # Two representatives of each other are one pair.
    ends = stars.groupBy(F.least("node", "rep").alias("low"), F.greatest("node", "rep").alias("high"))
    stars = ends.agg(F.min("node").alias("node"))
    stars = stars.select("node", F.when(F.col("node") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("rep"))
    shared = members.select("node").distinct()
    contents = own.join(shared, "node", "left_semi").dropDuplicates(["node"]).select("node", "keys", "units")
    contents = write_and_reread(contents, "contents")
    found = write_and_reread(verified(stars, contents, threshold), "verified")

    labels = components(found)
    classed = members.select("key", "node").join(labels, "node", "left")
    classed = write_and_reread(classed.select("key", "node", F.coalesce("label", "node").alias("label")), "classed")
    # Buckets whose members are not all of one class yet.
    sizes = classed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("classes"), F.max_by("label", F.struct("n", "label")).alias("main"),
        F.sum("n").alias("n"), (F.sum("n") - F.max("n")).alias("others"),
    )
    open_buckets = write_and_reread(largest.where("classes > 1"), "open")
    rest = classed.join(open_buckets, "key").select("key", "node", "label", "main", "others", "n")
    # Whole classes are joined from here on, so only their labels take part.
    merged = components(across(rest, contents, threshold)).select(F.col("node").alias("label"), F.col("label").alias("to"))
    nodes = classed.select("node", "label").distinct().join(merged, "label", "left")
    return nodes.select("node", F.coalesce("to", "label").alias("label"))


def across(rest: DataFrame, contents: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the labels of classes that have similar members in one bucket.

    Those outside the main class of a bucket are compared with all members of other classes.
    Outsiders are dealt to groups of about OUTSIDERS and members to chunks of about MEMBERS; a
    task compares one group with one chunk. A pair that shares several bands is compared in the
    first of them. Classes that a task has linked already are not compared again, so it returns
    fewer links than it has classes.
    """
    groups = F.ceil(F.col("others") / OUTSIDERS).cast("int")
    chunks = F.ceil(F.col("n") / MEMBERS).cast("int")
    loose = F.col("label") != F.col("main")
    own_group = F.pmod(F.xxhash64("node"), groups).cast("int")
    own_chunk = F.pmod(F.xxhash64("node", F.lit(1)), chunks).cast("int")
    rest = rest.withColumns({"loose": loose, "groups": groups, "chunks": chunks})
    every_group, every_chunk = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("groups", "chunks"))
    kept = ["key", "node", "label", "loose"]
    outsiders = rest.where("loose").select(
        *kept, own_group.alias("group"), F.explode(every_chunk).alias("chunk"), F.lit(True).alias("first")
    )
    members = rest.select(
        *kept, F.explode(every_group).alias("group"), own_chunk.alias("chunk"), F.lit(False).alias("first")
    )
    dealt = outsiders.unionByName(members).join(contents, "node")

    def compare(table: pa.Table) -> pa.Table:
        is_first = np.asarray(table["first"].to_pylist(), bool)
        outer, inner = table.filter(pa.array(is_first)), table.filter(pa.array(~is_first))
        a, b, forest = [], [], Forest()
        if not len(outer) or not len(inner):
            return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
        columns = inner.select(["node", "label", "loose"]).to_pydict()
        nodes, labels, loose = (np.asarray(columns[c]) for c in ("node", "label", "loose"))
        keys = np.asarray(inner["keys"].to_pylist())
        # The units of all members in one order: a search finds who shares each unit of a text.
        units = [np.frombuffer(u, "<u4") for u in inner["units"].to_pylist()]
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        units, owner = np.concatenate(units), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        order = np.argsort(units, kind="stable")
        units, owner = units[order], owner[order]
        for x in outer.to_pylist():
            shared = keys == np.asarray(x["keys"])
            here = np.asarray(x["keys"])[shared.argmax(axis=1)] == x["key"]
            own = np.frombuffer(x["units"], "<u4")
            alike = np.minimum(sizes, len(own)) >= threshold * np.maximum(sizes, len(own))
            due = here & alike & (labels != x["label"]) & ~(loose & (nodes <= x["node"]))
            if not due.any():
                continue
            low, high = np.searchsorted(units, own), np.searchsorted(units, own, side="right")
            runs = high - low
            at = np.repeat(low - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
            both = np.bincount(owner[at], minlength=len(sizes))
            for i in np.flatnonzero(due & (both / (sizes + len(own) - both) >= threshold)).tolist():
                other = int(labels[i])
                if forest.top(x["label"]) != forest.top(other):
                    forest.join(x["label"], other)
                    a.append(x["label"])
                    b.append(other)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy("key", "group", "chunk").applyInArrow(compare, "a long, b long")


def _placed(df: DataFrame, doc_id: str, text: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Every row with the label of its class, and the first row of each class."""
    own = sketches(df, doc_id, text)
    labels = labelled(own, threshold)
    placed = own.select("id", "version", "node").join(labels, "node", "left")
    placed = write_and_reread(placed.select("id", "version", F.coalesce("label", "node").alias("label")), "placed")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "version")).alias("first")
    heads = placed.groupBy("label").agg(first).select("label", F.col("first.id").alias("class_id"), "first.version")
    return placed, write_and_reread(heads, "heads")


def classes(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """One row per row of ``df``: the id and ``class_id``, the smallest id of its class."""
    placed, heads = _placed(df, doc_id, text, threshold)
    return placed.join(heads.drop("version"), "label").select(F.col("id").alias(doc_id), "class_id")


def one_of_each(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``df`` with one row of each class, that with the smallest id. All columns are kept."""
    heads = _placed(df, doc_id, text, threshold)[1]
    heads = heads.select(F.col("class_id").alias("_id"), F.col("version").alias("_version"))
    of = free_name(df, "_of")
    rows = df.withColumn(of, F.xxhash64(text))
    kept = rows.join(heads, (rows[of] == heads["_version"]) & rows[doc_id].eqNullSafe(heads["_id"]), "left_semi")
    return kept.dropDuplicates([doc_id, of]).drop(of)

"""Removal of repeated passages by hashing lines and the sentences within them.

A unit is a line, or a sentence of a line. Units are normalised (lower case, white space
collapsed, punctuation at the ends of words dropped) and their digests grouped over all
documents. The occurrence in the document with the smallest id, and there the first, stays;
later ones are repeats. Repeats that follow one another form a run. A run of ``min_words``
words or more is removed; shorter ones, such as a common greeting, are left where they are.
Units of fewer than ``unit_words`` words are too common to prove anything one by one: they neither
make nor break a run and go with it when they lie within it. Where they follow one another (lists,
menus, verse), every stretch of them that just reaches ``min_words`` words is hashed as a whole, from
each of them on, and is removed where an earlier document has it.

Both limits are parameters: with ``min_words=1, unit_words=1`` every repeated line or sentence but the
earliest goes, however short, and nothing is left where it is.

Only digests are grouped, and the smallest id is a partial aggregate, so a line that a third
of all documents share is one row per task before the shuffle. Going back from a digest to its
occurrences is a sort-merge join of two exchanges, which adaptive execution splits when a
digest is hot. Spans of a document are gathered by document.

Defined results: null and empty texts are unchanged and have no spans. Rows without an id rank
last: what they share with a row that has one is removed, among themselves nothing is. Rows
that share an id and a text are one document and keep the same units. All columns are kept;
``removed`` must not be one of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.llm.forced_bpe import slices
from registrum.session import write_and_reread

UNIT = re.compile(r"\S.*?(?:[.!?…。！？]+(?=\s|$)|$)", re.MULTILINE)
ENDS = re.compile(r"^\W+|\W+$")


def normalised(unit: str) -> list[str]:
    words = (ENDS.sub("", w) for w in unit.lower().split())
    return [w for w in words if w]


def stretches(short: list[tuple[int, int, list[str]]], min_words: int) -> Iterator[tuple[int, int, list[str]]]:
    """From each of some neighbouring units (start, stop, words) on, the fewest that have
    ``min_words`` words: start, stop, words."""
    last, count = 0, 0
    for i, (start, _, own) in enumerate(short):
        while last < len(short) and count < min_words:
            count += len(short[last][2])
            last += 1
        if count < min_words:
            return
        yield start, short[last - 1][1], [w for _, _, words in short[i:last] for w in words]
        count -= len(own)


def hashed(text: str) -> int:
    digest = blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


def units(df: DataFrame, doc_id: str, text: str, unit_words: int, min_words: int) -> DataFrame:
    """One row per unit of at least ``unit_words`` words: id, hash of the text, number of the
    unit in the text, start and stop in code points, words, digest. Stretches of shorter units
    have numbers below zero, neighbours of each other neighbouring ones."""
    names = ["id", "version", "unit", "start", "stop", "words", "digest"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            versions = batch.column(1).to_pylist()
            for first, last in slices(map(len, texts)):
                rows, found = [], []
                for i in range(first, last):
                    number, below = 0, -1
                    short: list[tuple[int, int, list[str]]] = []

                    def add_stretches() -> None:
                        nonlocal below
                        for start, stop, words in stretches(short, min_words):
                            rows.append(i)
                            # No unit has a line end, so none has this digest by its text.
                            found.append((versions[i], below, start, stop, len(words), hashed("\n" + " ".join(words))))
                            below -= 1
                        below -= 1
                        short.clear()

                    for match in UNIT.finditer(texts[i]):
                        words = normalised(match[0])
                        if len(words) < unit_words:
                            if words:
                                short.append((*match.span(), words))
                            continue
                        if short:
                            add_stretches()
                        rows.append(i)
                        found.append((versions[i], number, *match.span(), len(words), hashed(" ".join(words))))
                        number += 1
                    add_stretches()
                columns = zip(*found) if found else [()] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        *[pa.array(c, k) for c, k in zip(columns, kinds)],
                    ],
                    names,
                )

    schema = T.StructType([
        T.StructField("id", df.schema[doc_id].dataType),
        T.StructField("version", T.LongType()),
        *[T.StructField(n, T.IntegerType()) for n in names[2:6]],
        T.StructField("digest", T.LongType()),
    ])
    return df.select(doc_id, F.xxhash64(text).alias("_v"), text).mapInArrow(run, schema)


def repeats(found: DataFrame) -> DataFrame:
    """The units of ``units`` that are not the earliest of their digest. Stretches of short units
    overlap, so they count as repeats of other documents only."""
    shared = found.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = write_and_reread(shared.where("n > 1").select("digest", "first"), "unit-digests")
    again = found.join(shared, "digest")
    later = again.where("first is not null and (id is null or id > first)").drop("first")
    # Repeats within the earliest document itself.
    first = F.min("unit").over(Window.partitionBy("digest", "id", "version"))
    inner = again.where("id = first and unit >= 0").drop("first").withColumn("_first", first).where("unit > _first")
    return later.unionByName(inner.drop("_first"))


def spans(repeated: DataFrame, min_words: int) -> DataFrame:
    """Runs of repeated units with ``min_words`` words or more, an ordered list per document."""
    own = Window.partitionBy("id", "version", "short").orderBy("unit")
    # Repeated rows name the same units. One exchange serves all that follows.
    once = repeated.repartition("id", "version").dropDuplicates(["id", "version", "unit"])
    runs = (
        once.withColumn("short", F.col("unit") < 0)
        .withColumn("run", F.col("unit") - F.row_number().over(own))
        .groupBy("id", "version", "short", "run")
        .agg(F.sum("words").alias("words"), F.min("start").alias("start"), F.max("stop").alias("stop"))
        .where(F.col("words") >= min_words)
    )
    ordered = runs.groupBy("id", "version").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("all"))

    def merged(done: Column, span: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        overlaps = (F.size(done) > 0) & (last["stop"] > span["start"])
        return F.when(overlaps, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(span))
        )

    # Stretches lie within runs or overlap one another.
    none = F.array().cast("array<struct<start:int,stop:int>>")
    return ordered.select("id", "version", F.aggregate("all", none, merged).alias("removed"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer where a column has it already."""
    while name in df.columns:
        name += "_"
    return name


def remove_repeats(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_words: int = 25,
    unit_words: int = 4,
) -> DataFrame:
    """``df`` with repeated passages cut out of ``text``, and ``removed``: their start and stop
    in the original text, in code points."""
    if "removed" in df.columns:
        raise ValueError("there is a column removed already")
    found = write_and_reread(units(df, doc_id, text, unit_words, min_words), "units")
    cut = spans(repeats(found), min_words).select(
        F.col("id").alias("_id"), F.col("version").alias("_version"), "removed"
    )
    of = free_name(df, "_of")
    own = df.withColumn(of, F.xxhash64(text))
    joined = own.join(cut, (own[of] == cut["_version"]) & own[doc_id].eqNullSafe(cut["_id"]), "left")
    # What lies between the end of one span and the start of the next.
    kept = F.transform(
        F.sequence(F.lit(0), F.size("removed")),
        lambda i: F.substring(
            F.col(text),
            F.coalesce(F.get("removed", i - 1)["stop"], F.lit(0)) + 1,
            F.coalesce(F.get("removed", i)["start"], F.length(text))
            - F.coalesce(F.get("removed", i - 1)["stop"], F.lit(0)),
        ),
    )
    none = F.array().cast("array<struct<start:int,stop:int>>")
    return joined.select(
        *[
            F.when(F.col("removed").isNull(), F.col(c)).otherwise(F.array_join(kept, "")).alias(c)
            if c == text
            else own[c]
            for c in df.columns
        ],
        F.coalesce("removed", none).alias("removed"),
    )

"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A feature says whether an n-gram occurs in a text (lower case, white space as one blank, a
blank at either end). Its value is the log ratio of the smoothed shares of toxic and other
documents that have it; a logistic regression weighs these values. N-grams are hashed into
``BUCKETS`` places.

Fitting reads at most about ``max_docs`` labelled documents, picked by a hash of the id. Counts
per feature are summed in each task first. Of the features whose shares differ clearly, at most
``max_features`` go to the driver with the few values of each sampled document they occur in,
so what the driver holds is bounded by these parameters, not by the corpus. Scoring reads every
text whole, in slices, with two tables of fixed size, and moves no rows.

Null and empty texts have no feature but blanks and get the score of such a text. Repeated
rows get equal scores. A null label or id takes no part in fitting; with one class only, or
no labels, every score is the share of toxic labels. All columns are kept; ``output`` must not
be one of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.llm.forced_bpe import slices
from registrum.session import write_and_reread

SIZES = (4, 5)
BUCKETS = 1 << 20
MAX_DOCS = 12_000
MAX_FEATURES = 4_000
MIN_DOCS = 4
LEAST_Z = 4.0
# A task holds about a hundred bytes per character of a slice.
SLICE_CHARS = 400_000


@dataclass(frozen=True)
class Model:
    """``weights`` has a place per bucket; most are 0."""

    weights: np.ndarray
    bias: float


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of all texts, and the number of its text."""
    clean = [" " + " ".join(t.lower().split()) + " " for t in texts]
    lengths = np.array([len(t) for t in clean])
    points = np.frombuffer("".join(clean).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum(lengths)
    of = np.repeat(np.arange(len(texts)), lengths)
    room = np.repeat(ends, lengths) - np.arange(len(points))  # characters from here to the end
    buckets, owners = [], []
    for n in SIZES:
        count = len(points) - n + 1
        if count <= 0:
            continue
        mixed = np.full(count, n, np.uint32)
        for i in range(n):
            mixed = (mixed ^ points[i : i + count]) * np.uint32(0x9E3779B1)
            mixed ^= mixed >> np.uint32(15)
        whole = room[:count] >= n
        buckets.append((mixed[whole] & np.uint32(BUCKETS - 1)).astype(np.int64))
        owners.append(of[:count][whole])
    if not buckets:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def present(texts: list[str], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the texts and the places of the features they have, each pair once.
    ``place`` maps buckets to places, -1 for buckets that are no feature."""
    buckets, owners = _hashes(texts)
    places = place[buckets]
    some = places >= 0
    pairs = np.unique(owners[some] * len(place) + places[some])
    return pairs // len(place), pairs % len(place)


def _sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, max_docs: int) -> DataFrame:
    marked = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label"))
    marked = marked.where("id is not null and label in (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    total = marked.count()
    share = min(1.0, max_docs / max(1, total))
    picked = marked.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # At most about max_docs ids and labels: a few hundred kilobytes.
    own = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return write_and_reread(own.join(F.broadcast(picked), "id"), "labelled")


def _counts(sample: DataFrame) -> DataFrame:
    """Documents with each bucket, by label."""
    every = np.arange(BUCKETS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            texts, labels = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for start, stop in slices(map(len, texts), SLICE_CHARS):
                owners, buckets = present(texts[start:stop], every)
                for value in (0, 1):
                    seen[value] += np.bincount(
                        buckets[labels[start:stop][owners] == value], minlength=BUCKETS
                    ).astype(np.int32)
        some = np.flatnonzero(seen.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), pa.array(seen[1][some].astype(np.int64)), pa.array(seen[0][some].astype(np.int64))],
            ["bucket", "toxic", "other"],
        )

    by_task = sample.select("text", "label").mapInArrow(run, "bucket long, toxic long, other long")
    return by_task.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_docs: int = MAX_DOCS,
    max_features: int = MAX_FEATURES,
    smoothing: float = 0.5,
) -> Model:
    sample = _sample(docs, labels, doc_id, text, label, max_docs)
    classes = {r.label: r.n for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = classes.get(1, 0), classes.get(0, 0)
    weights = np.zeros(BUCKETS, np.float32)
    if not toxic or not other:
        share = (toxic + smoothing) / (toxic + other + 2 * smoothing)
        return Model(weights, math.log(share / (1 - share)))

    share = (F.col("toxic") + F.col("other")) / (toxic + other)
    spread = F.sqrt(share * (1 - share) * (1 / toxic + 1 / other))
    z = F.abs(F.col("toxic") / toxic - F.col("other") / other) / spread
    clear = (
        _counts(sample)
        .where((F.col("toxic") + F.col("other") >= MIN_DOCS) & (share < 1))
        .withColumn("z", z)
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "bucket")
        .limit(max_features)
        .collect()
    )
    if not clear:
        return Model(weights, math.log(toxic / other))
    buckets = np.array([r.bucket for r in clear])
    ratio = np.log((np.array([r.toxic for r in clear]) + smoothing) / (toxic + 2 * smoothing)) - np.log(
        (np.array([r.other for r in clear]) + smoothing) / (other + 2 * smoothing)
    )
    place = np.full(BUCKETS, -1, np.int64)
    place[buckets] = np.arange(len(buckets))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column(0).to_pylist(), batch.column(1)
            for start, stop in slices(map(len, texts), SLICE_CHARS):
                owners, places = present(texts[start:stop], place)
                bounds = np.searchsorted(owners, np.arange(stop - start + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(places.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([marks.slice(start, stop - start), lists], ["label", "places"])

    design = sample.select("text", "label").mapInArrow(rows, "label int, places array<int>").toArrow()
    design = design.combine_chunks()
    y = design["label"].to_numpy().astype(np.float64)
    lists = design["places"].combine_chunks()
    columns = lists.flatten().to_numpy().astype(np.int64)
    owners = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    w, bias = logistic(owners, columns, ratio, y)
    weights[buckets] = w * ratio
    return Model(weights, bias)


def logistic(
    owners: np.ndarray, columns: np.ndarray, scale: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 400
) -> tuple[np.ndarray, float]:
    """Logistic regression by Adam on the full (bounded) sample. Deterministic."""
    w, bias = np.zeros(len(scale)), math.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    first, second = np.zeros(len(scale) + 1), np.zeros(len(scale) + 1)
    values = scale[columns]
    for step in range(1, steps + 1):
        margin = bias + np.bincount(owners, values * w[columns], minlength=len(y))
        error = 1 / (1 + np.exp(-np.clip(margin, -40, 40))) - y
        slope = np.bincount(columns, values * error[owners], minlength=len(scale)) + ridge * w
        gradient = np.append(slope, error.sum()) / len(y)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        w -= move[:-1]
        bias -= move[-1]
    return w, float(bias)


def score(df: DataFrame, model: Model, text: str = "text", output: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic."""
    if output in df.columns:
        raise ValueError(f"there is a column {output} already")
    at = df.columns.index(text)
    used = np.flatnonzero(model.weights)
    weights, bias = model.weights[used].astype(np.float64), model.bias

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(BUCKETS, -1, np.int64)
        place[used] = np.arange(len(used))
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for start, stop in slices(map(len, texts), SLICE_CHARS):
                owners, places = present(texts[start:stop], place)
                margin = bias + np.bincount(owners, weights[places], minlength=stop - start)
                part = batch.slice(start, stop - start)
                scores = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(scores)], [*batch.schema.names, output]
                )

    schema = T.StructType([*df.schema.fields, T.StructField(output, T.DoubleType())])
    return df.mapInArrow(run, schema)

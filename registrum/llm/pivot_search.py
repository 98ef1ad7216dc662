"""Exact top-k search by inner product with pivot-table elimination.

A further coordinate gives all vectors one length, which turns the largest inner product into
the smallest distance. The distances of every vector to ``PIVOTS`` pivots are computed once and
written. By the triangle inequality the largest difference between a query's and a candidate's
distances to a pivot is a lower bound of their distance, hence an upper bound of their score.
Candidates are scored in the order of that bound until the next bound is below the k-th score
found; where a bound excludes little (in many dimensions it does), the remaining candidates of
a block are scored together by one matrix product, which is exact as well.

Queries are taken in blocks of at most ``QUERY_BYTES``, which is what is broadcast at a time.
A task reads its candidates in blocks of ``BLOCK_ROWS``; only its k best per query are shuffled.

Components become floor(scale * x). Vectors that are null or hold null or non-finite components
take no part; shorter ones are filled up with zeros. Scores are exact integers, beyond 64 bits
they are clipped in the result only. Rows without an id take no part. Rows that share an id are
candidates each, but never of a query with that id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrum.session import write_and_reread

PIVOTS = 16
FIRST_ROUND = 64
BLOCK_ROWS = 32_768
QUERY_ROWS = 64
QUERY_BYTES = 16 << 20


def integers(df: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    x = F.col(embedding)
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = df.where(F.col(vec_id).isNotNull() & x.isNotNull()).where(finite)
    return good.select(F.col(vec_id).alias("id"), whole.alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


class Bounds:
    """Pivots in the space with the added coordinate."""

    def __init__(self, pivots: np.ndarray, longest: float) -> None:
        self.pivots, self.longest = pivots, longest
        self.added = np.sqrt(np.maximum(longest - (pivots**2).sum(1), 0))

    def candidates(self, vectors: np.ndarray) -> np.ndarray:
        added = np.sqrt(np.maximum(self.longest - (vectors**2).sum(1), 0))
        inner = vectors @ self.pivots.T + added[:, None] * self.added
        return np.sqrt(np.maximum(2 * self.longest - 2 * inner, 0))

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        own = (vectors**2).sum(1)[:, None] + self.longest
        return np.sqrt(np.maximum(own - 2 * (vectors @ self.pivots.T), 0))

    def scores(self, queries: np.ndarray, distances: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores, with room for rounding."""
        least = np.zeros((len(queries), len(table)))
        for p in range(table.shape[1]):
            np.maximum(least, np.abs(distances[:, p, None] - table[None, :, p]), out=least)
        own = (queries**2).sum(1)[:, None] + self.longest
        return (own - least**2) / 2 + 1e-6 * own + 1


class Best:
    """The k best (score, id) of a query so far; ties go to the smaller id."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids = k, np.empty(0), np.empty(0, np.int64)

    @property
    def least(self) -> float:
        return self.scores[-1] if len(self.scores) == self.k else -math.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, best: list[Best], vectors: np.ndarray, ids: np.ndarray,
    table: np.ndarray, bounds: Bounds,
) -> None:
    """Offers the vectors of a block to each query."""
    for start in range(0, len(queries), QUERY_ROWS):
        own = slice(start, start + QUERY_ROWS)
        q, mine = queries[own], best[own]
        upper = bounds.scores(q, bounds.queries(q), table)
        upper[query_ids[own][:, None] == ids[None, :]] = -math.inf
        first = min(FIRST_ROUND, len(ids))
        order = np.argpartition(-upper, first - 1, axis=1)[:, :first]
        for i, picked in enumerate(order):
            picked = picked[upper[i, picked] > -math.inf]
            mine[i].add(vectors[picked] @ q[i], ids[picked])
            upper[i, picked] = -math.inf
        least = np.array([b.least for b in mine])
        left = upper >= least[:, None]
        left &= upper > -math.inf
        if left.sum() > left.size // 8:
            scores = q @ vectors.T
            left &= scores >= least[:, None]
            for i in range(len(q)):
                rest = np.flatnonzero(left[i])
                if len(rest):
                    mine[i].add(scores[i, rest], ids[rest])
            continue
        for i in range(len(q)):
            rest = np.flatnonzero(left[i])
            rest = rest[np.argsort(-upper[i, rest], kind="stable")]
            for at in range(0, len(rest), FIRST_ROUND):
                picked = rest[at : at + FIRST_ROUND]
                if upper[i, picked[0]] < mine[i].least:
                    break
                mine[i].add(vectors[picked] @ q[i], ids[picked])


def top_k(
    df: DataFrame, every: int = 20, k: int = 20, scale: int = 64, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose id is divisible by ``every``."""
    spark = df.sparkSession
    prepared = write_and_reread(integers(df, vec_id, embedding, scale), "vectors")
    length = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v * v)
    is_query = F.pmod("id", F.lit(every)) == 0
    facts = prepared.select(
        F.max(length).alias("longest"), F.max(F.size("vector")).alias("width"),
        F.max(F.array_max(F.transform("vector", lambda v: F.abs(v)))).alias("largest"),
        F.count_if(is_query).alias("queries"),
    ).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not facts.queries:
        return empty
    width = max(1, facts.width)
    # Doubles hold the scores exactly up to here; beyond it Python's integers do.
    exact = width * (facts.largest or 0.0) ** 2 < 2.0**53
    if not exact:
        return _by_integers(prepared, is_query, k)
    picked = prepared.orderBy(F.xxhash64("id"), "id").limit(PIVOTS).select("vector").toArrow()
    bounds = Bounds(_matrix(picked["vector"].combine_chunks(), width), facts.longest)

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column(1), width)
            flat = [pa.array([r.tobytes() for r in m], pa.binary()) for m in (vectors, bounds.candidates(vectors))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *flat], ["id", "vector", "distances"])

    table = write_and_reread(prepared.mapInArrow(measure, "id long, vector binary, distances binary"), "pivots")
    blocks = math.ceil(facts.queries * width * 8 / QUERY_BYTES)
    found = None
    for block in range(blocks):
        mine = prepared.where(is_query & (F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)).toArrow().combine_chunks()
        if not mine.num_rows:
            continue
        shared = spark.sparkContext.broadcast(
            (mine["id"].to_numpy(), _matrix(mine["vector"].combine_chunks(), width))
        )
        part = table.mapInArrow(_searcher(shared, bounds, width, k), "query_id long, vec_id long, score long")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def _searcher(shared, bounds: Bounds, width: int, k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        best = [Best(k) for _ in query_ids]

        def offer(held: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(held)
            ids = rows["id"].to_numpy()
            vectors = np.frombuffer(b"".join(rows["vector"].to_pylist())).reshape(len(ids), width)
            distances = np.frombuffer(b"".join(rows["distances"].to_pylist())).reshape(len(ids), -1)
            search_block(queries, query_ids, best, vectors, ids, distances, bounds)

        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BLOCK_ROWS:
                offer(held)
                held, rows = [], 0
        if held:
            offer(held)
        for start in range(0, len(best), 512):
            some = best[start : start + 512]
            counts = [len(b.ids) for b in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(query_ids[start : start + 512], counts)),
                    pa.array(np.concatenate([b.ids for b in some])),
                    pa.array(np.concatenate([b.scores for b in some]).astype(np.int64)),
                ],
                ["query_id", "vec_id", "score"],
            )

    return run


def _by_integers(prepared: DataFrame, is_query, k: int) -> DataFrame:
    """For components too large for doubles: the same result from exact integers, block by block."""
    spark = prepared.sparkSession
    queries = prepared.where(is_query)
    found = None
    blocks = max(1, math.ceil(queries.count() / 1000))
    for block in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        shared = spark.sparkContext.broadcast([(r.id, [int(v) for v in r.vector]) for r in rows])

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            import heapq

            best: dict[int, list[tuple[int, int]]] = {q: [] for q, _ in shared.value}
            for batch in batches:
                for own, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    whole = [int(v) for v in vector]
                    for q, theirs in shared.value:
                        if q != own:
                            item = (sum(a * b for a, b in zip(theirs, whole)), -own)
                            if len(best[q]) < k:
                                heapq.heappush(best[q], item)
                            else:
                                heapq.heappushpop(best[q], item)
            rows = [(q, -i, str(s)) for q, items in best.items() for s, i in items]
            columns = zip(*rows) if rows else ((), (), ())
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)], ["query_id", "vec_id", "exact"]
            )

        part = prepared.mapInArrow(run, "query_id long, vec_id long, exact string")
        found = part if found is None else found.unionByName(part)
    # Digits sort as numbers by sign, length and text.
    digits = F.regexp_replace("exact", "^-", "")
    negative = F.col("exact").startswith("-")
    size = F.when(negative, -F.length(digits)).otherwise(F.length(digits))
    turned = F.when(negative, F.translate(digits, "0123456789", "9876543210")).otherwise(digits)
    order = Window.partitionBy("query_id").orderBy(negative, size.desc(), turned.desc(), "vec_id")
    ends = F.when(negative, F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1))
    score = F.coalesce(F.expr("try_cast(exact AS bigint)"), ends)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", score.alias("score")
    )

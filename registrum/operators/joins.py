"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup of this many narrow rows is a few megabytes on every executor.
BROADCAST_ROWS = 100_000


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Reads at most ``rows`` + 1 rows to find out."""
    return df.limit(rows + 1).count() <= rows


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "left",
    share: float = 0.001,
) -> DataFrame:
    """Equi-join in which no key puts more than ``share`` of the left rows into one task.

    Keys above that share are counted first. There can be at most 1 / ``share`` of them,
    which bounds the broadcast. Their left rows are dealt out to numbered pieces and their
    right rows are repeated once per piece; all other rows keep piece 0. Left rows with a
    null key match nothing and are spread too. For joins that keep left rows (inner, left,
    left_semi, left_anti).

    The piece is a hash of the left row, so a recomputed task deals its rows out alike.
    Copies of one row share a piece; if they are many, adaptive execution splits it.
    """
    limit = left.select(F.count(F.lit(1)) * F.lit(share)).scalar()
    counted = left.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = counted.where(F.col("_n") > limit).select(
        *on, F.ceil(F.col("_n") / limit).cast("int").alias("_pieces")
    )
    hot = F.broadcast(hot)
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    pieces = F.when(no_key, F.lit(int(1 / share))).otherwise(F.coalesce("_pieces", F.lit(1)))
    hashed = [f.name for f in left.schema.fields if "map<" not in f.dataType.simpleString()]
    dealt = left.join(hot, on, "left").withColumn(
        "_piece", F.pmod(F.xxhash64(*hashed), pieces).cast("int")
    )
    repeated = right.join(hot, on, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1))
    )
    joined = dealt.drop("_pieces").join(repeated.drop("_pieces"), [*on, "_piece"], how)
    return joined.drop("_piece")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join to a lookup: broadcast when it is measured to be small, balanced otherwise."""
    if fits_broadcast(lookup, broadcast_rows):
        return df.join(F.broadcast(lookup), on, how)
    return balanced_join(df, lookup, on, how)

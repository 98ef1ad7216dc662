"""Inverted index of code lists: for each code the numbers of the rows that have it, as bitmaps.

Row numbers are cut into buckets of 32768; a bitmap of 4 KB tells which rows of a bucket have a
code. "All of" and "any of" are AND and OR of the bitmaps of a bucket, so lists are not read. The
index is written in order of codes, and a search reads the row groups of its codes only. Bitmaps
are aggregated in each task first, so a code that a third of all rows have is one row per task and
bucket before the shuffle.

Row numbers should be dense (``dense_rows`` makes such), or buckets are mostly empty. Null lists,
null codes and null row numbers are not indexed; a row number that comes twice has the codes of
both rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registrum.session import write_and_reread

BITS = 32768
IN_PARTITION = 33  # bits of a monotonic id below the partition number; fixed by Spark


def dense_rows(df: DataFrame, name: str = "row") -> DataFrame:
    """``df`` with row numbers from 0 without gaps, stored once so that they stay the same.

    Numbers within a task are shifted by the totals of the tasks before it, one row per task."""
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    staged = write_and_reread(df.withColumn(name, F.monotonically_increasing_id()), "numbered-rows")
    part = F.shiftright(name, IN_PARTITION)
    totals = staged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    joined = staged.join(F.broadcast(shifts), part == F.col("_part"))
    place = F.col(name).bitwiseAND(F.lit((1 << IN_PARTITION) - 1))
    return joined.select(*df.columns, (place + F.col("_shift")).alias(name))


def code_index(df: DataFrame, row: str, codes: str) -> DataFrame:
    """code, bucket, rows (a bitmap)."""
    pairs = df.select(F.col(row).cast("long").alias("row"), F.explode(codes).alias("code"))
    bucket = F.floor(F.col("row") / BITS).alias("bucket")
    return (
        pairs.dropna()
        .groupBy("code", bucket)
        .agg(F.bitmap_construct_agg(F.pmod("row", F.lit(BITS))).alias("rows"))
    )


def write_code_index(df: DataFrame, row: str, codes: str, path: str, allow_overwrite: bool = False) -> DataFrame:
    """The written index, in order of codes, so that a filter on codes reaches the scan."""
    index = code_index(df, row, codes)
    mode = "overwrite" if allow_overwrite else "errorifexists"
    ordered = index.repartitionByRange("code", "bucket").sortWithinPartitions("code", "bucket")
    ordered.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(index.schema).parquet(path)


def _of_codes(index: DataFrame, codes: Sequence) -> DataFrame:
    kind = index.schema["code"].dataType
    return index.where(F.col("code").isin(*[F.lit(c).cast(kind) for c in codes]))


def rows_with_any(index: DataFrame, codes: Sequence) -> DataFrame:
    """Numbers of the rows that have one of the codes; none for no codes."""
    found = _of_codes(index, codes).groupBy("bucket").agg(F.bitmap_or_agg("rows").alias("rows"))
    return row_numbers(found)


def rows_with_all(index: DataFrame, codes: Sequence) -> DataFrame:
    """Numbers of the rows that have each of the codes."""
    wanted = set(codes)
    if not wanted:
        raise ValueError("every row has all of no codes; name one")
    found = (
        _of_codes(index, sorted(wanted))
        .groupBy("bucket")
        .agg(F.bitmap_and_agg("rows").alias("rows"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") == len(wanted))
    )
    return row_numbers(found)


def count_rows(index: DataFrame, codes: Sequence) -> DataFrame:
    """code, rows: how many rows have each of the codes, without naming them."""
    return _of_codes(index, codes).groupBy("code").agg(F.sum(F.bitmap_count("rows")).alias("rows"))


def row_numbers(bitmaps: DataFrame) -> DataFrame:
    """The row numbers of bitmaps (bucket, rows)."""
    octets = F.transform(
        F.sequence(F.lit(0), F.lit(BITS // 8 - 1)),
        lambda i: F.struct(i.alias("at"), F.conv(F.hex(F.substring("rows", i + 1, F.lit(1))), 16, 10).cast("int").alias("octet")),
    )
    used = bitmaps.select("bucket", F.explode(F.filter(octets, lambda o: o["octet"] != 0)).alias("o"))
    bits = F.filter(
        F.array(*[F.lit(b) for b in range(8)]), lambda b: F.expr("o.octet").bitwiseAND(F.pow(F.lit(2), b).cast("int")) != 0
    )
    return used.select("bucket", "o.at", F.explode(bits).alias("bit")).select(
        (F.col("bucket") * BITS + F.col("at") * 8 + F.col("bit")).cast("long").alias("row")
    )

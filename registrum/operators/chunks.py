"""Chunk numbers: the unit of telemetry and of the quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"


def chunk_by(df: DataFrame, number: Column) -> DataFrame:
    """Chunk number from an expression of the caller (a batch id, a load date, a key block)."""
    return df.withColumn(CHUNK, number.cast("long"))


def chunk_of_key(df: DataFrame, key: str, chunk_size: int) -> DataFrame:
    """Blocks of ``chunk_size`` consecutive values of a zero-based key, from 1."""
    return chunk_by(df, F.floor(F.col(key) / chunk_size) + 1)


def chunk_by_position(df: DataFrame, chunk_size: int) -> DataFrame:
    """Consecutive blocks of ``chunk_size`` rows in scan order, from 1.

    ``df`` must be a plain scan, so that both passes see the same partitions. The first
    pass counts rows per partition; the window then runs over one row per partition.
    """
    placed = df.withColumns(
        {
            "_partition": F.spark_partition_id(),
            "_offset": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    sizes = placed.groupBy("_partition").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_partition", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start")
    )
    position = F.col("_start") + F.col("_offset")
    return chunk_by(
        placed.join(F.broadcast(starts), "_partition"), F.floor(position / chunk_size) + 1
    ).drop("_partition", "_offset", "_start")


def chunk_by_place(df: DataFrame, chunk_size: int, file: str, position: str) -> DataFrame:
    """Blocks of ``chunk_size`` records of each file, from the records' places in it, counted from 0.

    The key is text: file and block number. It is the same for any split of the files and any
    partitioning of ``df``; no pass and no shuffle is needed.
    """
    block = F.floor(F.col(position) / chunk_size).cast("string")
    return df.withColumn(CHUNK, F.concat_ws("#", F.coalesce(file, F.lit("")), block))


def chunk_by_content(df: DataFrame, chunk_size: int) -> DataFrame:
    """Chunks of about ``chunk_size`` rows for rows without a place, from 1.

    As many chunks as the count of rows asks for; a hash of the whole row picks one. The same rows
    give the same chunks in any order and partitioning, and equal rows share a chunk, so one may be
    larger. Costs one count.
    """
    chunks = max(1, -(-df.count() // chunk_size))
    if chunks == 1:
        return df.withColumn(CHUNK, F.lit(1).cast("long"))
    hashed = [F.col(quoted(f.name)) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return chunk_by(df, F.pmod(F.xxhash64(*hashed), F.lit(chunks)) + 1)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def chunk_by_file(df: DataFrame, chunk_size: int, file: str = "_file") -> DataFrame:
    """Blocks within the scanned splits of each file, without a second pass.

    The key is text: file, split and block number. Blocks do not cross splits.
    """
    block = F.floor(
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) / chunk_size
    ).cast("string")
    return df.withColumn(
        CHUNK, F.concat_ws("#", F.col(file), F.spark_partition_id().cast("string"), block)
    )

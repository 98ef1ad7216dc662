"""Table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.functions.codes import array_literal
from registrum.functions.text import STATES

PART = "uf_part"
OTHER_STATES = "default"


def save_mode(allow_overwrite: bool) -> str:
    return "overwrite" if allow_overwrite else "errorifexists"


def write_table(df: DataFrame, path: str, allow_overwrite: bool = False) -> None:
    df.write.mode(save_mode(allow_overwrite)).parquet(path)


def save_bucketed(
    df: DataFrame, table: str, keys: list[str], buckets: int, allow_overwrite: bool = False
) -> None:
    """A catalog table bucketed and sorted by key: point lookups read one bucket, and joins
    of tables with the same buckets need no shuffle."""
    writer = df.write.mode(save_mode(allow_overwrite)).format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def exchange_text(df: DataFrame) -> DataFrame:
    """Columns as text: arrays as '{a,b}', the rest by cast."""

    def text(field: T.StructField) -> Column:
        c = F.col(field.name)
        is_array = isinstance(field.dataType, T.ArrayType)
        return (array_literal(c) if is_array else c.cast("string")).alias(field.name)

    return df.select(*[text(f) for f in df.schema.fields])


def write_exchange(
    df: DataFrame, path: str, allow_overwrite: bool = False, encoding: str = "UTF-8"
) -> None:
    """';' text without header; quotes doubled; null and '' are both empty."""
    options = {
        "sep": ";",
        "header": False,
        "quote": '"',
        "escape": '"',
        "nullValue": "",
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "encoding": encoding,
    }
    exchange_text(df).write.mode(save_mode(allow_overwrite)).options(**options).csv(path)


def state_partition(state: Column, states: tuple[str, ...] = STATES) -> Column:
    """The state, or ``default`` for null and unknown ones."""
    return F.when(state.isin(*states), state).otherwise(F.lit(OTHER_STATES))


def write_by_state(
    df: DataFrame, path: str, state: str = "uf", allow_overwrite: bool = False,
    sort: Sequence[str] = (),
) -> None:
    """One folder per state. Rebalancing splits a state that holds much of the table over
    several tasks and files, and joins small ones. ``sort`` orders the rows of each file."""
    parted = df.withColumn(PART, state_partition(F.col(state))).hint("rebalance", PART)
    if sort:
        parted = parted.sortWithinPartitions(PART, *sort)
    (
        parted.write.mode(save_mode(allow_overwrite))
        .partitionBy(PART)
        .parquet(path)
    )


def clustered(df: DataFrame, columns: list[str], tie: list[str]) -> DataFrame:
    """Range-partitioned and sorted. ``tie`` (the key) lets a range boundary fall inside a
    value of ``columns``, so a frequent value spans several tasks."""
    return df.repartitionByRange(*columns, *tie).sortWithinPartitions(*columns, *tie)

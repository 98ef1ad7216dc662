"""Stored statistics that merge: distinct values and quantiles per chunk and column.

A state is built once when a chunk is loaded and kept as a row. Statistics of a table, of some of
its chunks or of all loads so far come from merging states; the data is not read again. Distinct
values are HyperLogLog states of ``2 ** lg_k`` places (relative standard error ``error(lg_k)``),
quantiles of numbers are KLL states.

Nulls are not counted. A column without values has 0 distinct values and null quantiles. Columns
that are neither text, binary nor whole numbers are counted by their text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.operators.repair import quoted

LG_K = 12


def error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / math.sqrt(1 << lg_k)


def column_sketches(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K
) -> DataFrame:
    """One row per group of ``by`` and column: column, values, distinct_state, quantile_state."""
    aggs, rows = [], []
    for i, name in enumerate(columns):
        kind, c = df.schema[name].dataType, F.col(quoted(name))
        plain = isinstance(kind, (T.StringType, T.BinaryType, T.IntegerType, T.LongType))
        aggs += [
            F.count(c).alias(f"_n{i}"),
            F.hll_sketch_agg(c if plain else c.cast("string"), lg_k).alias(f"_d{i}"),
        ]
        state = F.lit(None).cast("binary")
        if isinstance(kind, T.NumericType):
            aggs.append(F.kll_sketch_agg_double(c.cast("double")).alias(f"_q{i}"))
            state = F.col(f"_q{i}")
        rows.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col(f"_n{i}").alias("values"),
                F.col(f"_d{i}").alias("distinct_state"),
                state.alias("quantile_state"),
            )
        )
    grouped = df.groupBy(*by).agg(*aggs)
    return grouped.select(*by, F.inline(F.array(*rows)))


def merged(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of ``column_sketches`` or of ``merged``, one row per group of ``by`` and column."""
    return states.groupBy(*by, "column").agg(
        F.sum("values").alias("values"),
        F.hll_union_agg("distinct_state", F.lit(True)).alias("distinct_state"),
        F.kll_merge_agg_double("quantile_state").alias("quantile_state"),
    )


def estimates(states: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Distinct values, their share of the values, and quantiles of each row of states."""
    some = F.col("quantile_state").isNotNull() & (F.kll_sketch_get_n_double("quantile_state") > 0)

    def quantile(q: float) -> Column:
        return F.when(some, F.kll_sketch_get_quantile_double("quantile_state", F.lit(q)))

    distinct = F.hll_sketch_estimate("distinct_state")
    return states.select(
        *[c for c in states.columns if c not in ("distinct_state", "quantile_state")],
        distinct.alias("distinct"),
        (distinct / F.nullif(F.col("values"), F.lit(0))).alias("selectivity"),
        F.array(*[quantile(q) for q in quantiles]).alias("quantiles"),
    )

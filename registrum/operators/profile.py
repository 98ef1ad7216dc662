"""Counts, samples and statistics of tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.functions.contact import e164
from registrum.functions.taxid import full_id
from registrum.operators.quality import as_text, changed
from registrum.operators.repair import BEFORE, INVALID_ID, data_columns, quoted
from registrum.options import Options


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls, least and greatest value per column, compared in the column's own type."""
    columns = list(columns or data_columns(df))
    arrays = {f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)}
    aggs, rows = [], []

    def text(value: str, name: str) -> str:
        if name in arrays:
            return f"concat('{{', array_join(CAST({value} AS ARRAY<STRING>), ','), '}}')"
        return f"CAST({value} AS STRING)"

    for i, c in enumerate(columns):
        name = quoted(c)
        aggs += [
            F.expr(f"count_if({name} IS NULL) AS _n{i}"),
            F.expr(f"min({name}) AS _l{i}"),
            F.expr(f"max({name}) AS _g{i}"),
        ]
        rows.append(
            f"named_struct('column', '{c}', 'nulls', _n{i}, 'min', {text(f'_l{i}', c)}, "
            f"'max', {text(f'_g{i}', c)})"
        )
    return df.agg(*aggs).select(F.expr(f"inline(array({', '.join(rows)}))"))


def sample_diffs(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], k: int = 10
) -> DataFrame:
    """The first ``k`` changed values of each column, before and after.

    Spark limits the rank per input partition first, so at most ``k`` rows per column and
    partition are shuffled.
    """
    pairs = [
        F.when(
            changed(df, c),
            F.struct(
                F.lit(c).alias("column"),
                as_text(df, f"{BEFORE}.{c}").alias("before"),
                as_text(df, c).alias("after"),
            ),
        )
        for c in columns
    ]
    long = df.select(
        F.struct(*order_by).alias("_order"),
        F.explode(F.array_compact(F.array(*pairs))).alias("_pair"),
    ).select("_order", "_pair.*")
    first = Window.partitionBy("column").orderBy("_order", "before", "after")
    return (
        long.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= k)
        .select("column", "_order.*", "before", "after")
    )


def invalid_id_examples(
    df: DataFrame, parts: Sequence[str], order_by: Sequence[str], k: int = 10
) -> DataFrame:
    flagged = df.where(INVALID_ID).orderBy(*order_by).limit(k)
    return flagged.select(*order_by, full_id(*[F.col(p) for p in parts]).alias("example"))


def e164_examples(
    df: DataFrame, area: str, number: str, order_by: Sequence[str], k: int = 10
) -> DataFrame:
    canonical = df.select(
        *order_by, F.lit(number).alias("column"), e164(F.col(area), F.col(number)).alias("e164")
    )
    return canonical.where(F.col("e164").isNotNull()).orderBy(*order_by).limit(k)


def totals(gated: DataFrame, opts: Options) -> DataFrame:
    """One row of totals; changed values and nulls only over accepted chunks."""
    accepted = gated.where(~F.col("gated"))
    skipped = F.col("invalid_ids") if opts.skip_invalid_ids else F.lit(0)
    loaded = F.col("rows") - skipped
    open_chunk = ~F.col("gated")

    def summed(column: str):
        per_key = (
            accepted.select(F.explode(column).alias("key", "n"))
            .groupBy("key")
            .agg(F.sum("n").alias("n"))
        )
        # One entry per table column, so the list is short.
        entries = F.sort_array(F.collect_list(F.struct("key", "n")))
        return per_key.agg(F.map_from_entries(entries)).scalar()

    return gated.agg(
        F.coalesce(F.sum(F.when(open_chunk, loaded)), F.lit(0)).alias("rows_total"),
        F.count_if(open_chunk & (loaded > 0)).alias("chunks_processed"),
        F.count_if("gated").alias("quality_gate_chunks"),
        F.coalesce(F.sum(F.when(open_chunk, skipped)), F.lit(0))
        .cast("long")
        .alias("invalid_cnpj_rows_skipped"),
    ).withColumns(
        {
            "changed_totals": summed("changed_counts"),
            "null_delta_totals": summed("null_deltas"),
        }
    )


def summary(spec, gated: DataFrame, stats: DataFrame, opts: Options) -> DataFrame:
    """The table's one summary row: totals and a map of column statistics."""
    entries = F.collect_list(F.struct("column", F.struct("nulls", "min", "max")))
    by_column = stats.agg(F.map_from_entries(F.sort_array(entries))).scalar()
    return totals(gated, opts).select(
        F.lit(spec.table).alias("table"),
        F.lit(spec.name).alias("config"),
        "*",
        by_column.alias("column_stats"),
        F.current_timestamp().alias("timestamp"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def selectivity(df: DataFrame, columns: Sequence[str], rsd: float = 0.05) -> DataFrame:
    """Approximate distinct values per column and their share of the non-null values."""
    aggs = []
    for c in columns:
        aggs += [
            F.approx_count_distinct(c, rsd).alias(f"_d_{c}"),
            F.count(c).alias(f"_n_{c}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"_n_{c}").alias("values"),
            F.col(f"_d_{c}").alias("distinct"),
            (F.col(f"_d_{c}") / F.nullif(F.col(f"_n_{c}"), F.lit(0))).alias("selectivity"),
        )
        for c in columns
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def refresh_statistics(spark: SparkSession, tables: Sequence[str]) -> None:
    """Statistics of catalog tables, for the cost-based optimizer."""
    for table in tables:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")

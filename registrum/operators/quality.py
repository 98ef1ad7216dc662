"""Chunk telemetry, quality gates and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.functions.codes import array_literal
from registrum.operators.chunks import CHUNK
from registrum.operators.joins import lookup_join
from registrum.operators.membership import GIVEN, VIOLATED
from registrum.operators.repair import BEFORE, INVALID_ID, OVERFLOW, data_columns, quoted
from registrum.options import Options
from registrum.sources.delimited import FILE, LINE
from registrum.specs import TableSpec

TRIGGERS = (
    "map<string,struct<type:string,ratio:double,count:bigint,delta:bigint,"
    "null_delta_ratio:double,null_delta:bigint>>"
)


def as_text(df: DataFrame, name: str) -> Column:
    """Text form of a value; arrays as '{a,b}'."""
    kind = df.schema
    for part in name.split("."):
        kind = kind[part].dataType
    c = F.col(name)
    return array_literal(c) if isinstance(kind, T.ArrayType) else c.cast("string")


def changed(df: DataFrame, name: str) -> Column:
    """Whether the repair changed the value. Null to null is no change, nor is text that
    became the number it spells."""
    before = as_text(df, f"{BEFORE}.{name}")
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        before = F.coalesce(before.try_cast(kind).cast("string"), before)
    return ~before.eqNullSafe(as_text(df, name))


def _count_map(counts: dict[str, str]) -> Column:
    entries = ", ".join(f"'{name}', {value}" for name, value in counts.items())
    return F.expr(f"CAST(map({entries}) AS MAP<STRING, BIGINT>)")


def telemetry(
    df: DataFrame, spec: TableSpec, level: str = "basic", chunk: str = CHUNK
) -> DataFrame:
    """One row per chunk: rows, nulls after the repair, their change, changed values.

    A single aggregation over the repaired frame; only one row per chunk is shuffled.
    """
    columns = data_columns(df)
    before = set(df.schema[BEFORE].dataType.names)
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(INVALID_ID)).alias("invalid_ids")]
    nulls, deltas, changes = {}, {}, {}
    if level != "none":
        for i, c in enumerate(columns):
            name = quoted(c)
            nulls[c], deltas[c] = f"_n{i}", "0"
            aggs.append(F.expr(f"count_if({name} IS NULL) AS _n{i}"))
            if c in before:  # a column that no step touched keeps its nulls
                more = f"CAST({name} IS NULL AS INT) - CAST({BEFORE}.{name} IS NULL AS INT)"
                deltas[c] = f"_d{i}"
                aggs.append(F.expr(f"sum({more}) AS _d{i}"))
    if level == "aggressive":
        for i, c in enumerate(t for t in spec.tracked if t in columns and t in before):
            changes[c] = f"_c{i}"
            aggs.append(F.count_if(changed(df, c)).alias(changes[c]))
    return (
        df.groupBy(chunk)
        .agg(*aggs)
        .select(
            F.lit(spec.table).alias("table"),
            F.lit(spec.name).alias("config"),
            F.col(chunk).alias("chunk"),
            "rows",
            F.lit(level).alias("level"),
            F.lit(columns).alias("columns"),
            _count_map(nulls).alias("after_nulls"),
            _count_map(deltas).alias("null_deltas"),
            F.map_filter(_count_map(changes), lambda _, n: n > 0).alias("changed_counts"),
            "invalid_ids",
            F.current_timestamp().alias("timestamp"),
        )
    )


def with_gate(records: DataFrame, opts: Options) -> DataFrame:
    """Adds ``trigger_columns`` and ``gated`` to telemetry records.

    A chunk of enough rows is gated when the share of changed values or of the change in
    nulls of any column is strictly above its limit.
    """

    def share(n: Column) -> Column:
        return F.abs(n) / F.col("rows")

    changes = F.map_filter(
        "changed_counts", lambda _, n: share(n) > opts.gate_changed_ratio
    )
    nulls = F.map_filter("null_deltas", lambda _, n: share(n) > opts.gate_null_delta_ratio)

    def trigger(c: Column) -> Column:
        n, d = F.try_element_at("_changes", c), F.try_element_at("_nulls", c)
        by_change = n.isNotNull()
        return F.struct(
            F.when(by_change, F.lit("changed")).otherwise(F.lit("null_delta")).alias("type"),
            F.when(by_change, share(n)).otherwise(share(d)).alias("ratio"),
            n.alias("count"),
            F.when(~by_change, d).alias("delta"),
            F.when(by_change, share(d)).alias("null_delta_ratio"),
            F.when(by_change, d).alias("null_delta"),
        )

    names = F.array_union(F.map_keys("_changes"), F.map_keys("_nulls"))
    found = F.map_from_entries(F.transform(names, lambda c: F.struct(c, trigger(c))))
    active = F.lit(opts.gates) & (F.col("rows") >= opts.gate_min_rows)
    return (
        records.withColumns({"_changes": changes, "_nulls": nulls})
        .withColumn("_found", found.cast(TRIGGERS))
        .withColumn("gated", active & (F.size("_found") > 0))
        .withColumn(
            "trigger_columns",
            F.when(F.col("gated"), F.col("_found")).otherwise(F.create_map().cast(TRIGGERS)),
        )
        .drop("_changes", "_nulls", "_found")
    )


def accepted_rows(df: DataFrame, gated: DataFrame, chunk: str = CHUNK) -> DataFrame:
    """Drops the rows of gated chunks.

    Pass telemetry that has been written: the few gated chunk numbers are counted, then broadcast
    instead of shuffling the table, however many chunks there are.
    """
    dropped = gated.where("gated").select(F.col("chunk").alias(chunk))
    return lookup_join(df, dropped, [chunk], "left_anti")


def gate_records(gated: DataFrame) -> DataFrame:
    """Quarantine records of gated chunks."""
    return gated.where("gated").select(
        "table",
        "config",
        "chunk",
        F.lit("quality_gate").alias("reason"),
        F.map_keys("trigger_columns").alias("fields"),
        F.to_json(F.struct("rows", "trigger_columns")).alias("row"),
        F.current_timestamp().alias("timestamp"),
    )


def line_records(lines: DataFrame, spec: TableSpec) -> DataFrame:
    """Quarantine records of lines (``_file``, ``line``) that have more fields than the table, or
    that are no rows for the reason in ``_reject_reason``."""
    known = "_reject_reason" in lines.columns
    reason = F.coalesce("_reject_reason", F.lit("malformed_line")) if known else F.lit("malformed_line")
    return lines.select(
        F.lit(spec.table).alias("table"),
        F.lit(spec.name).alias("config"),
        F.col(FILE).alias("chunk"),
        reason.alias("reason"),
        F.array().cast("array<string>").alias("fields"),
        F.to_json(F.struct(LINE)).alias("row"),
        F.current_timestamp().alias("timestamp"),
    )


def missing_critical(spec: TableSpec, columns: Sequence[str]) -> Column:
    checks = [F.col(c).isNull() for c in spec.critical if c in columns]
    return reduce(or_, checks) if checks else F.lit(False)


def row_records(
    df: DataFrame, spec: TableSpec, skip_invalid: bool = False, chunk: str = CHUNK
) -> DataFrame:
    """Quarantine records of rows: missing critical fields, invalid ids, foreign codes,
    values that do not fit their target type.

    One pass: the reasons of a row are collected in an array and exploded (the outer form,
    because Spark pushes a copy of the array into a filter for the inner one). Rows with missing
    critical fields stay in the load. ``row`` is the row as JSON, for foreign codes with the
    code already nulled.
    """
    columns = data_columns(df)
    critical = [c for c in spec.critical if c in columns]
    given = set(df.schema[GIVEN].dataType.names) if GIVEN in df.columns else set()
    now = F.to_json(F.struct(*columns))
    as_given = F.to_json(
        F.struct(*[F.col(f"{GIVEN}.{c}").alias(c) if c in given else F.col(c) for c in columns])
    )

    def reason(name: str, fields: Column, row: Column) -> Column:
        return F.struct(F.lit(name).alias("reason"), fields.alias("fields"), row.alias("row"))

    def names(values: Sequence[str]) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast("array<string>")

    kept = ~F.col(INVALID_ID) if skip_invalid else F.lit(True)
    misfits = F.col(OVERFLOW) if OVERFLOW in df.columns else names([])
    found = F.array_compact(
        F.array(
            F.when(
                missing_critical(spec, columns),
                F.array(reason("critical_fields_null", names(critical), as_given)),
            ),
            F.when(
                F.col(INVALID_ID), F.array(reason("invalid_cnpj", names(spec.id_parts), as_given))
            ),
            F.when(
                kept & (F.size(VIOLATED) > 0),
                F.transform(VIOLATED, lambda c: reason("fk_violation", F.array(c), now)),
            ),
            F.when(kept & (F.size(misfits) > 0), F.array(reason("type_overflow", misfits, now))),
        )
    )
    return (
        df.select(chunk, F.flatten(found).alias("_found"))
        .select(F.col(chunk).alias("chunk"), F.explode_outer("_found").alias("_one"))
        .where(F.col("_one").isNotNull())
        .select(
            F.lit(spec.table).alias("table"),
            F.lit(spec.name).alias("config"),
            "chunk",
            "_one.reason",
            "_one.fields",
            "_one.row",
            F.current_timestamp().alias("timestamp"),
        )
    )


def skip_invalid_ids(df: DataFrame) -> DataFrame:
    return df.where(~F.col(INVALID_ID))

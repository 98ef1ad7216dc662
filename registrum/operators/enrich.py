"""Filling city codes and states from lookup maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.functions.text import digits_of_length, name_key, strip
from registrum.operators.joins import BROADCAST_ROWS, lookup_join

CITY, CITY_SOURCE = "municipio_codigo", "municipio_source"
STATE, STATE_SOURCE = "uf", "uf_source"
STATE_BEFORE = "_uf_before"


def _source(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def _fill(df: DataFrame, target: str, source: str, fill: Column, value: Column, tag: str):
    """Sets ``target`` and its provenance where ``fill`` holds."""
    kind = df.schema[target].dataType
    return {
        target: F.when(fill, value.try_cast(kind)).otherwise(F.col(target)),
        source: F.when(fill, F.lit(tag)).otherwise(_source(df, source)),
    }


def enrich_by_postal_code(
    df: DataFrame,
    postal_map: DataFrame,
    *,
    postal: str = "cep",
    only_if_null: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """City code and state from a map keyed by ``cep`` or by its first five digits.

    The map is reduced to one row per key (smallest city code). The state is set where it
    is null or, with ``only_if_null`` off, also where the map differs. Adds ``_uf_before``.
    """
    exact = "cep" in postal_map.columns
    key = "cep" if exact else "cep_prefix"
    tag = "cep_map_exact" if exact else "cep_map_prefix"
    width = 8 if exact else 5
    code = F.col(CITY).try_cast("int")
    one_each = (
        postal_map.select(
            digits_of_length(F.col(key), width).alias("_postal"),
            code.alias("_city"),
            F.upper(strip(F.col(STATE))).alias("_state"),
        )
        .dropna(subset=["_postal"])
        .groupBy("_postal")
        .agg(
            F.min("_city").alias("_map_city"),
            # The state of that city, the smallest one if the map names several.
            F.coalesce(
                F.min(F.when(F.col("_city").isNotNull() & F.col("_state").isNotNull(), F.struct("_city", "_state")))[
                    "_state"
                ],
                F.min("_state"),
            ).alias("_map_state"),
        )
    )
    keyed = df.withColumn(
        "_postal", F.substring(digits_of_length(F.col(postal), 8), 1, width)
    )
    joined = lookup_join(keyed, one_each, ["_postal"], "left", broadcast_rows)
    changes = {}
    if CITY in df.columns:
        infer = F.col(CITY).isNull() & F.col("_map_city").isNotNull()
        changes |= _fill(df, CITY, CITY_SOURCE, infer, F.col("_map_city"), tag)
    if STATE in df.columns:
        differs = F.col(STATE).isNull()
        if not only_if_null:
            differs = differs | (F.col(STATE) != F.col("_map_state"))
        correct = F.col("_map_state").isNotNull() & differs
        changes |= _fill(df, STATE, STATE_SOURCE, correct, F.col("_map_state"), tag)
        changes[STATE_BEFORE] = F.col(STATE)
    return joined.withColumns(changes).drop("_postal", "_map_city", "_map_state")


def enrich_by_city_name(
    df: DataFrame,
    name_map: DataFrame,
    *,
    name: str = "municipio_nome",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """City code from the normalized city name, and the state when the map has one."""
    by_state = STATE in name_map.columns and STATE in df.columns
    on = ["_name", "_in_state"] if by_state else ["_name"]

    def keys(frame: DataFrame) -> DataFrame:
        keyed = frame.withColumn("_name", name_key(F.col(name)))
        return (
            keyed.withColumn("_in_state", F.upper(strip(F.col(STATE)))) if by_state else keyed
        )

    one_each = (
        keys(name_map)
        .dropna(subset=on)
        .groupBy(*on)
        .agg(F.min(F.col(CITY).try_cast("int")).alias("_map_city"))
    )
    joined = lookup_join(keys(df), one_each, on, "left", broadcast_rows)
    infer = F.col(CITY).isNull() & F.col("_map_city").isNotNull()
    changes = _fill(df, CITY, CITY_SOURCE, infer, F.col("_map_city"), "mun_name_map")
    return joined.withColumns(changes).drop(*on, "_map_city")


def enrichment_counts(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Filled rows per provenance, optionally per chunk."""
    kinds = {
        "municipio_inferred": F.col(CITY_SOURCE).startswith("cep_map_"),
        "municipio_inferred_by_name": F.col(CITY_SOURCE) == "mun_name_map",
        "uf_corrected": F.col(STATE_SOURCE).startswith("cep_map_"),
    }
    counts = [F.count_if(cond).alias(f"{name}_count") for name, cond in kinds.items()]
    return df.groupBy(*(by or [])).agg(*counts)


def enrichment_examples(
    df: DataFrame, column: str, source: str, key: str, tag: str, order_by: list[str], k: int = 10
) -> DataFrame:
    """The first ``k`` filled values of one provenance."""
    return (
        df.where(F.col(source) == tag)
        .orderBy(*order_by)
        .limit(k)
        .select(*dict.fromkeys([*order_by, key, column]))
    )

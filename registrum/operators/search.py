"""Queries over the loaded tables: lookups, filters, name and code search, the star join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.operators.joins import balanced_join, fits_broadcast, lookup_join

SIMILARITY = 0.3


def where_equal(df: DataFrame, **values) -> DataFrame:
    """Rows with the given column values; plain equality, so it reaches the scan."""
    for column, value in values.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def by_full_id(df: DataFrame, whole: str) -> DataFrame:
    """Establishment of a 14-digit id; the parts are compared one by one."""
    return where_equal(df, cnpj_basico=whole[:8], cnpj_ordem=whole[8:12], cnpj_dv=whole[12:])


def name_contains(df: DataFrame, column: str, part: str) -> DataFrame:
    """Case-insensitive substring; '%', '_' and '\\' in ``part`` stand for themselves."""
    escaped = part.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return df.where(F.col(column).ilike(f"%{escaped}%"))


def trigrams(c: Column) -> Column:
    """Distinct 3-letter pieces of each word, padded by two blanks before and one after."""
    words = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}]+)"))

    def pieces(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        starts = F.sequence(F.lit(1), F.length(word) + 1)
        return F.transform(starts, lambda i: F.substring(padded, i, F.lit(3)))

    return F.array_distinct(F.flatten(F.transform(words, pieces)))


def trigram_similarity(ta: Column, tb: Column) -> Column:
    """Shared trigrams over all trigrams of both sides; 0 when there are none."""
    shared = F.size(F.array_intersect(ta, tb))
    every = F.size(ta) + F.size(tb) - shared
    return F.when(every > 0, shared / every).otherwise(F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    return trigram_similarity(trigrams(a), trigrams(b))


def similar_names(
    df: DataFrame, column: str, terms: Sequence[str], threshold: float = SIMILARITY
) -> DataFrame:
    """Rows similar to any of the given terms, one row per match: a scan, no join.

    Trigrams of a row are taken once and scored against those of the terms, which are
    constants of the plan.
    """
    wanted = F.array(
        *[F.struct(F.lit(t).alias("term"), trigrams(F.lit(t)).alias("tri")) for t in terms]
    )

    def scored(t: Column) -> Column:
        return F.struct(
            t["term"].alias("term"),
            trigram_similarity(F.col("_tri"), t["tri"]).alias("similarity"),
        )

    matches = F.filter(F.transform(wanted, scored), lambda m: m["similarity"] >= threshold)
    return (
        df.withColumn("_tri", trigrams(F.col(column)))
        .select(*df.columns, F.explode(matches).alias("_match"))
        .select(*df.columns, "_match.*")
    )


def has_all_codes(df: DataFrame, column: str, codes: Sequence[int]) -> DataFrame:
    kind = df.schema[column].dataType.elementType
    for code in codes:
        df = df.where(F.array_contains(column, F.lit(code).cast(kind)))
    return df


def has_any_code(df: DataFrame, column: str, codes: Sequence[int]) -> DataFrame:
    kind = df.schema[column].dataType
    return df.where(F.arrays_overlap(column, F.array(*[F.lit(c) for c in codes]).cast(kind)))


def active_establishments(df: DataFrame) -> DataFrame:
    return where_equal(df, situacao_cadastral=2)


def micro_entrepreneurs(df: DataFrame) -> DataFrame:
    return where_equal(df, opcao_pelo_mei="S")


def newest(df: DataFrame, column: str, k: int = 1) -> DataFrame:
    """The ``k`` greatest distinct values."""
    return df.select(column).dropna().distinct().orderBy(F.desc(column)).limit(k)


def with_company(
    establishments: DataFrame, companies: DataFrame, on: str = "cnpj_basico"
) -> DataFrame:
    """Establishments and their company. A company may own a third of all establishments,
    so beyond broadcast size the join is the balanced one."""
    if fits_broadcast(companies):
        return establishments.join(F.broadcast(companies), on)
    return balanced_join(establishments, companies, [on], "inner")


def with_labels(
    df: DataFrame, domains: Mapping[str, DataFrame], key: str = "codigo", label: str = "nome"
) -> DataFrame:
    """Adds ``<column>_nome`` for each code column and its domain."""
    for column, domain in domains.items():
        named = domain.select(F.col(key).alias(column), F.col(label).alias(f"{column}_nome"))
        df = lookup_join(df, named, [column])
    return df

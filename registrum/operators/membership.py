"""Membership of code columns in their domains."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.functions.text import STATES
from registrum.operators.joins import BROADCAST_ROWS, fits_broadcast, lookup_join
from registrum.session import write_and_reread
from registrum.specs import TableSpec

VIOLATED = "_violated"
GIVEN = "_given"
SAMPLE = 10

log = logging.getLogger(__name__)


class MembershipError(ValueError):
    """Codes outside their domain, in strict mode."""


class EmptyDomainError(RuntimeError):
    """A domain that must be loaded first has no rows."""


@dataclass(frozen=True)
class Rule:
    """``column`` must be in ``domain[key]``, or in the literal ``allowed`` set."""

    column: str
    domain: DataFrame | None = None
    key: str = "codigo"
    allowed: tuple[str, ...] = ()


def rules_for(spec: TableSpec, domains: Mapping[str, DataFrame]) -> list[Rule]:
    rules = []
    for ref in spec.references:
        if not ref.checked_on_load:
            continue
        if ref.parent is None:
            rules.append(Rule(ref.column, allowed=STATES))
        elif ref.parent in domains:
            rules.append(Rule(ref.column, domains[ref.parent], ref.key))
    return rules


def domain_keys(domain: DataFrame, key: str) -> DataFrame:
    return domain.select(key).dropna().distinct()


def members(df: DataFrame, column: str, domain: DataFrame, key: str = "codigo") -> DataFrame:
    """Rows whose code is in the domain."""
    keys = domain_keys(domain, key).withColumnRenamed(key, column)
    return lookup_join(df, keys, [column], "left_semi")


def codes_in_use(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, code, rows`` of all given columns in one scan.

    Rows are counted per code before the shuffle, so a frequent code costs one row.
    """
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("code")) for c in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("code").isNotNull())
        .groupBy("column", "code")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def foreign_codes(used: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Those of the codes in use that are outside the domain of their column."""
    parts = []
    for rule in rules:
        mine = used.where(F.col("column") == rule.column)
        if rule.domain is None:
            parts.append(mine.where(~F.col("code").isin(*rule.allowed)))
            continue
        keys = rule.domain.select(F.col(rule.key).alias("_key"))
        kind = keys.schema["_key"].dataType
        parts.append(
            mine.withColumn("_key", F.col("code").try_cast(kind))
            .join(keys, "_key", "left_anti")
            .select("column", "code", "rows")
        )
    return reduce(DataFrame.unionByName, parts)


def require_members(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Raises with the number of bad rows and up to ten of the codes of each column.

    The table is scanned once; its codes are then checked from a small written table.
    """
    rules = [rule for rule in rules if rule.column in df.columns]
    if not rules:
        return
    used = write_and_reread(codes_in_use(df, [rule.column for rule in rules]), "codes")
    bad = foreign_codes(used, rules)
    found = []
    for row in bad.groupBy("column").agg(F.sum("rows").alias("rows")).orderBy("column").collect():
        codes = bad.where(F.col("column") == row["column"]).orderBy("code").limit(SAMPLE)
        sample = [r["code"] for r in codes.collect()]
        found.append(f"{row['column']}: {row['rows']} rows outside the domain, codes {sample}")
    if found:
        raise MembershipError("; ".join(found))


def relax_members(
    df: DataFrame, rules: Sequence[Rule], broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Sets codes outside their domain to null and lists the columns in ``_violated``.

    Codes are compared in the type of the domain key, so text '013' is code 13.
    ``_given`` keeps the codes as they came, for the quarantine records.

    A domain that is too large for a broadcast is joined to the distinct codes in use; only the few
    that it lacks are then looked up for the rows, so the table itself is not shuffled.
    """
    given = df
    order = df.columns
    known = {}
    for rule in rules:
        column = rule.column
        if column not in order:
            continue
        if rule.domain is None:
            known[column] = F.col(column).isin(*rule.allowed)
            continue
        mark, key = f"_known_{column}", f"_key_{column}"
        keys = domain_keys(rule.domain, rule.key).withColumnRenamed(rule.key, key)
        code = F.col(column).try_cast(keys.schema[key].dataType)
        df = df.withColumn(key, code)
        if fits_broadcast(keys, broadcast_rows):
            df = df.join(F.broadcast(keys.withColumn(mark, F.lit(True))), key, "left")
            known[column] = F.col(mark).isNotNull()
            continue
        used = given.select(code.alias(key)).dropna().distinct()
        foreign = write_and_reread(used.join(keys, key, "left_anti"), "foreign-codes")
        df = lookup_join(df, foreign.withColumn(mark, F.lit(True)), [key], "left", broadcast_rows)
        known[column] = F.col(key).isNotNull() & F.col(mark).isNull()
    bad = {c: F.col(c).isNotNull() & ~k for c, k in known.items()}
    listed = F.array(*[F.when(b, F.lit(c)) for c, b in bad.items()])
    kept = [F.when(~bad[c], F.col(c)).alias(c) if c in bad else F.col(c) for c in order]
    if not bad:
        return without_violations(df)
    return df.select(*kept, F.struct(*bad).alias(GIVEN), F.array_compact(listed).alias(VIOLATED))


def without_violations(df: DataFrame) -> DataFrame:
    return df.withColumn(VIOLATED, F.array().cast("array<string>"))


def check_members(
    df: DataFrame,
    rules: Sequence[Rule],
    strict: bool = True,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    if not strict:
        return relax_members(df, rules, broadcast_rows)
    require_members(df, rules)
    return without_violations(df)


def require_loaded(domains: Mapping[str, DataFrame | None], strict: bool = True) -> list[str]:
    """Names of the domains that are missing or have no rows; raises in strict mode."""
    empty = [name for name, df in domains.items() if df is None or df.isEmpty()]
    if empty and strict:
        raise EmptyDomainError(f"domains without rows: {empty}")
    for name in empty:
        log.warning("domain %s has no rows; its check is relaxed", name)
    return empty

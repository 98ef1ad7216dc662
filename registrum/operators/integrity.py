"""Keys and references between tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.session import write_and_reread


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent and their row counts: ``key``, ``rows``.

    Child rows are counted per key first (partly before the shuffle), so a key that holds a
    third of the rows enters the join once.
    """
    counted = (
        child.select(F.col(column).alias(key))
        .dropna()
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return counted.join(parent.select(key), key, "left_anti")


def backfill(
    parent: DataFrame,
    key: str,
    children: Sequence[tuple[DataFrame, str]],
    label_column: str,
    label: str,
) -> DataFrame:
    """The parent and one placeholder row per key that only its children know."""
    used = reduce(
        DataFrame.union, [child.select(F.col(column).alias(key)) for child, column in children]
    )
    kind = parent.schema[key].dataType
    missing = (
        orphan_keys(used, key, parent, key)
        .select(F.col(key).cast(kind).alias(key))
        .withColumn(label_column, F.lit(label))
    )
    return parent.unionByName(missing, allowMissingColumns=True)


def primary_key_report(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Rows with a null in the key, keys that repeat, and the rows beyond the first."""
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeats = ~no_key & (F.col("_n") > 1)
    return per_key.agg(
        F.coalesce(F.sum(F.when(no_key, F.col("_n"))), F.lit(0)).alias("null_key_rows"),
        F.count_if(repeats).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeats, F.col("_n") - 1)), F.lit(0)).alias("extra_rows"),
    ).select(F.lit(table).alias("table"), F.lit(",".join(keys)).alias("key"), "*")


@dataclass(frozen=True)
class Relation:
    child: str
    column: str
    parent: str
    key: str


def keys_in_use(tables: dict[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """``relation`` (its number), ``key`` (as text of the parent's type) and ``rows``, written: the
    keys that each child uses. A child is scanned once for all its relations; rows are counted per
    key before the shuffle, so a key that holds a third of the rows costs one row per task."""
    parts = []
    for child in dict.fromkeys(r.child for r in relations):
        df = tables[child]
        pairs = [
            F.struct(F.lit(i).alias("relation"), _as_key(F.col(r.column), tables[r.parent], r.key).alias("key"))
            for i, r in enumerate(relations)
            if r.child == child
        ]
        parts.append(df.select(F.inline(F.array(*pairs))).where(F.col("key").isNotNull()))
    used = reduce(DataFrame.unionByName, parts)
    counted = used.groupBy("relation", "key").agg(F.count(F.lit(1)).alias("rows"))
    return write_and_reread(counted, "keys-in-use")


def _as_key(column: Column, parent: DataFrame, key: str) -> Column:
    """The column as text of the parent key's type, so '013' and 13 are one key."""
    kind = parent.schema[key].dataType
    typed = column if isinstance(kind, T.StringType) else F.coalesce(column.try_cast(kind).cast("string"), column.cast("string"))
    return typed.cast("string")


def orphans_in_use(used: DataFrame, tables: dict[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """The rows of ``keys_in_use`` whose key the parent lacks.

    The parents' keys form one table, marked by the relations they serve, so one join settles all
    relations; each parent key column is read once.
    """
    parts = []
    for parent, key in dict.fromkeys((r.parent, r.key) for r in relations):
        own = [i for i, r in enumerate(relations) if (r.parent, r.key) == (parent, key)]
        keys = tables[parent].select(F.col(key).cast("string").alias("key")).dropna().distinct()
        parts.append(keys.select(F.explode(F.array(*map(F.lit, own))).alias("relation"), "key"))
    known = reduce(DataFrame.unionByName, parts)
    return used.join(known, ["relation", "key"], "left_anti")


def report_of(orphans: DataFrame, tables: dict[str, DataFrame], relations: Sequence[Relation]) -> DataFrame:
    """Orphan rows, orphan keys and the least of them, a row per relation."""
    spark = orphans.sparkSession
    named = spark.createDataFrame(
        [(i, r.child, r.column, r.parent) for i, r in enumerate(relations)],
        "relation int, child string, column string, parent string",
    )
    numeric = {i for i, r in enumerate(relations) if isinstance(tables[r.parent].schema[r.key].dataType, T.NumericType)}
    # Least as a number where the key is one.
    as_number = F.col("relation").isin(*numeric) if numeric else F.lit(False)
    rank = F.struct(F.when(as_number, F.col("key").try_cast("decimal(38,10)")).alias("number"), F.col("key").alias("key"))
    found = orphans.groupBy("relation").agg(
        F.sum("rows").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_keys"), F.min(rank)["key"].alias("first_key")
    )
    joined = F.broadcast(named).join(found, "relation", "left")
    return joined.select(
        "child",
        "column",
        "parent",
        F.coalesce("orphan_rows", F.lit(0)).alias("orphan_rows"),
        F.coalesce("orphan_keys", F.lit(0)).alias("orphan_keys"),
        "first_key",
    )


def foreign_key_report(
    tables: dict[str, DataFrame], relations: Sequence[Relation]
) -> DataFrame:
    """Orphan rows, orphan keys and the least of them, per relation; each child is read once."""
    used = keys_in_use(tables, relations)
    return report_of(orphans_in_use(used, tables, relations), tables, relations)


def backfilled_by(
    orphans: DataFrame, tables: dict[str, DataFrame], relations: Sequence[Relation], labels: dict[int, tuple[str, str]]
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Parents with a placeholder row per orphan key of the relations in ``labels`` (relation number to
    label column and label), and the orphans that are left. Both rest on the one table of orphans."""
    out = dict(tables)
    filled = None
    for parent in dict.fromkeys(relations[i].parent for i in labels):
        own = [i for i in labels if relations[i].parent == parent]
        key, (column, label) = relations[own[0]].key, labels[own[0]]
        kind = tables[parent].schema[key].dataType
        keys = orphans.where(F.col("relation").isin(*own)).select("key").distinct()
        typed = keys.select(F.col("key").try_cast(kind).alias(key)).dropna()
        out[parent] = tables[parent].unionByName(
            typed.withColumn(column, F.lit(label)), allowMissingColumns=True
        )
        # The new key serves every relation of its parent.
        served = [i for i, r in enumerate(relations) if r.parent == parent]
        one = keys.where(F.col("key").try_cast(kind).isNotNull()).select(
            F.explode(F.array(*map(F.lit, served))).alias("relation"), "key"
        )
        filled = one if filled is None else filled.unionByName(one)
    left = orphans if filled is None else orphans.join(filled, ["relation", "key"], "left_anti")
    return out, left


def orphan_sample(
    child: DataFrame, column: str, parent: DataFrame, key: str, k: int = 10
) -> DataFrame:
    return orphan_keys(child, column, parent, key).orderBy(key).limit(k)


class IntegrityError(ValueError):
    """A primary or foreign key does not hold."""


def require_keys(report: DataFrame, counts: Sequence[str]) -> None:
    """Raises when any count of a key report is not zero."""
    broken = report.where(reduce(or_, [F.col(c) > 0 for c in counts])).collect()
    if broken:
        raise IntegrityError("; ".join(str(row.asDict()) for row in broken))

"""The integrity pass over loaded tables: keys, backfill, references."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from registrum.operators.integrity import (
    Relation, backfill, backfilled_by, keys_in_use, orphans_in_use, primary_key_report, report_of, require_keys,
)
from registrum.options import Options
from registrum.session import write_and_reread
from registrum.specs import TABLES

LABELS = {"empresas": "razao_social"}
NAMES = {spec.table: name for name, spec in TABLES.items()}
REPORT = "child string, column string, parent string, orphan_rows long, orphan_keys long, first_key string"


@dataclass(frozen=True)
class IntegrityResult:
    tables: dict[str, DataFrame]
    primary_keys: DataFrame
    foreign_keys: DataFrame


def relations() -> list[Relation]:
    """The ten enforced references."""
    return [
        Relation(spec.table, ref.column, ref.parent, ref.key)
        for spec in TABLES.values()
        for ref in spec.references
        if ref.enforced and ref.parent is not None
    ]


def backfilled(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Parents completed with placeholder rows for keys that their children use."""
    out = dict(tables)
    for spec in TABLES.values():
        for ref in spec.references:
            if ref.backfill is None or ref.parent not in out or spec.table not in tables:
                continue
            label = LABELS.get(ref.parent, "nome")
            out[ref.parent] = backfill(
                out[ref.parent], ref.key, [(tables[spec.table], ref.column)], label, ref.backfill
            )
    return out


def integrity_pass(
    tables: Mapping[str, DataFrame], opts: Options = Options(), strict: bool = False
) -> IntegrityResult:
    """Primary key report, backfill, foreign key report. ``strict`` raises on a broken key.

    The keys in use are counted in one scan per child; backfill and report both come from the
    orphans among them, which are written once.
    """
    keyed = [s for s in TABLES.values() if s.key and s.table in tables]
    primary = reduce(
        DataFrame.unionByName,
        [primary_key_report(tables[s.table], s.key, s.table) for s in keyed],
    )
    given = dict(tables)
    present = [r for r in relations() if r.child in given and r.parent in given]
    if not present:
        return IntegrityResult(given, primary, primary.sparkSession.createDataFrame([], REPORT))
    orphans = orphans_in_use(keys_in_use(given, present), given, present)
    orphans = write_and_reread(orphans, "orphans")
    complete, left = given, orphans
    if opts.backfill:
        labels = {
            i: (LABELS.get(r.parent, "nome"), ref.backfill)
            for i, r in enumerate(present)
            for ref in TABLES[NAMES[r.child]].references
            if (ref.column, ref.parent) == (r.column, r.parent) and ref.backfill is not None
        }
        complete, left = backfilled_by(orphans, given, present, labels)
    foreign = report_of(left, given, present)
    if strict:
        require_keys(primary, ["null_key_rows", "repeated_keys"])
        require_keys(foreign, ["orphan_rows"])
    return IntegrityResult(complete, primary, foreign)

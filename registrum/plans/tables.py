"""Building tables: one, or all nine with parents first."""

from __future__ import annotations

import logging
from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.operators.chunks import CHUNK, chunk_by_content, chunk_by_place
from registrum.operators.enrich import (
    CITY, CITY_SOURCE, STATE, STATE_SOURCE, enrich_by_city_name, enrich_by_postal_code,
)
from registrum.operators.membership import (
    relax_members, require_loaded, require_members, rules_for, without_violations,
)
from registrum.operators.profile import column_stats, summary, totals
from registrum.operators.quality import (
    accepted_rows, gate_records, line_records, row_records, skip_invalid_ids, telemetry, with_gate,
)
from registrum.operators.repair import conform, repair
from registrum.options import Options
from registrum.session import short_methods, write_and_reread
from registrum.sinks.records import metric_lines, write_json_lines, write_metrics, write_summary
from registrum.sinks.tables import clustered, write_by_state, write_table
from registrum.sources import archives
from registrum.sources.delimited import FILE, LINE, malformed, read_delimited
from registrum.sources.whole_records import POSITION, REASON, REJECTED, read_rows, rows_of
from registrum.specs import TABLES, TableSpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Maps:
    """Lookup maps for the enrichment of establishments."""

    postal: DataFrame | None = None
    city_names: DataFrame | None = None


@dataclass(frozen=True)
class BuildResult:
    """What a table build gives. All frames are lazy but the telemetry, which is written."""

    spec: TableSpec
    clean: DataFrame
    quarantine: DataFrame
    telemetry: DataFrame
    stats: DataFrame
    summary: DataFrame
    totals: DataFrame


def repaired_rows(
    raw: DataFrame, spec: TableSpec, opts: Options, maps: Maps = Maps()
) -> DataFrame:
    """Hook, cleaners, id flag and enrichment."""
    postal = (
        maps.postal if opts.level == "aggressive" and opts.postal_enrichment else None
    )
    postal = postal if postal is not None and "cep" in raw.columns else None
    names = maps.city_names if opts.level != "none" else None
    names = names if names is not None and "municipio_nome" in raw.columns else None
    filled = (CITY, CITY_SOURCE) if postal is not None or names is not None else ()
    filled += (STATE, STATE_SOURCE) if postal is not None else ()
    df = repair(raw, spec, opts.level, filled)
    if postal is not None:
        df = enrich_by_postal_code(df, postal, only_if_null=opts.correct_state_only_if_null)
    if names is not None:
        df = enrich_by_city_name(df, names)
    return df


def build_table(
    raw: DataFrame,
    spec: TableSpec,
    domains: Mapping[str, DataFrame] | None = None,
    opts: Options = Options(),
    maps: Maps = Maps(),
    chunk: Column | None = None,
    rejected: DataFrame | None = None,
) -> BuildResult:
    """One table from its text rows.

    ``chunk`` numbers the chunks unless ``raw`` has ``_chunk`` already. Otherwise rows with a place in
    their file (``_file``, ``_position``, as ``read_rows`` gives them) form blocks of ``chunk_size``
    there, others are dealt by a hash of the row: the gate sees the same chunks however the rows
    are partitioned. The telemetry is written to the shared folder first: the gate reads it back, small
    and of known size. The repaired rows are written too, unless ``opts.stage`` is off: telemetry, codes,
    load, record sizes and quarantine then read columns of one table instead of repairing again. Rows of ``raw`` with a text in ``_rejected`` are lines that cannot be rows; they go to
    quarantine with their reason; ``rejected`` (``_file``, ``line``) does the same for rows read without it.
    """
    domains = domains or {}
    if REJECTED in raw.columns:
        if FILE not in raw.columns:
            raw = raw.withColumn(FILE, F.lit(spec.name))
        lines = raw.where(F.col(REJECTED).isNotNull()).select(FILE, F.col(REJECTED).alias(LINE), REASON)
        raw = raw.where(F.col(REJECTED).isNull()).drop(REJECTED, REASON)
        rejected = lines
    if chunk is not None:
        raw = raw.withColumn(CHUNK, chunk)
    elif CHUNK not in raw.columns:
        if FILE in raw.columns and POSITION in raw.columns:
            raw = chunk_by_place(raw, opts.chunk_size, FILE, POSITION)
        else:
            raw = chunk_by_content(raw, opts.chunk_size)
    raw = raw.drop(POSITION)
    repaired = repaired_rows(raw, spec, opts, maps)
    with short_methods(raw.sparkSession):
        if opts.stage:
            repaired = write_and_reread(repaired, spec.name)
        records = write_and_reread(
            with_gate(telemetry(repaired, spec, opts.level), opts), f"{spec.name}-telemetry"
        )
    # Without gates no chunk is gated, so nothing is looked up.
    accepted = accepted_rows(repaired, records) if opts.gates else repaired

    parents = {name: domains.get(name) for name in spec.parents()}
    empty = require_loaded(parents, opts.strict_membership)
    rules = rules_for(spec, {n: d for n, d in parents.items() if n not in empty})
    if opts.strict_membership:
        judged = skip_invalid_ids(accepted) if opts.skip_invalid_ids else accepted
        require_members(judged, rules)
        checked = without_violations(accepted)
    else:
        checked = relax_members(accepted, rules)
    typed = conform(checked, spec)

    loaded = skip_invalid_ids(typed) if opts.skip_invalid_ids else typed
    clean = loaded.select(*[c for c in spec.column_names if c in loaded.columns])
    stats = column_stats(clean)
    quarantine = row_records(typed, spec, opts.skip_invalid_ids).unionByName(gate_records(records))
    if rejected is not None:
        as_text = quarantine.withColumn("chunk", F.col("chunk").cast("string"))
        quarantine = as_text.unionByName(line_records(rejected, spec))
    return BuildResult(
        spec=spec,
        clean=clean,
        quarantine=quarantine,
        telemetry=records,
        stats=stats,
        summary=summary(spec, records, stats, opts),
        totals=totals(records, opts),
    )


def write_result(result: BuildResult, out: str, opts: Options = Options()) -> None:
    """Table, quarantine, telemetry, summary and metrics under ``out``."""
    spec, target = result.spec, f"{out}/tables/{result.spec.table}"
    by_state = "uf" in result.clean.columns
    sort = ["uf", *spec.key] if opts.cluster_by_state else []
    if opts.partition_by_state and by_state:
        write_by_state(result.clean, target, allow_overwrite=opts.allow_overwrite, sort=sort)
    elif opts.cluster_by_state and by_state:
        write_table(clustered(result.clean, ["uf"], list(spec.key)), target, opts.allow_overwrite)
    else:
        write_table(result.clean, target, opts.allow_overwrite)
    # Statistics come from the written columns, not from another run of the repair.
    written = result.clean.sparkSession.read.schema(result.clean.schema).parquet(target)
    stats = column_stats(written)
    for name, df in (("quarantine", result.quarantine), ("telemetry", result.telemetry)):
        write_json_lines(
            df,
            f"{out}/{name}/{spec.name}",
            max_bytes=opts.json_max_bytes,
            daily=opts.daily_rotation,
        )
    write_summary(summary(spec, result.telemetry, stats, opts), f"{out}/summary/{spec.name}")
    if opts.metrics:
        write_metrics(metric_lines(result.totals, spec.table), f"{out}/metrics/{spec.name}")


def selected(
    only: Collection[str] | None = None, exclude: Collection[str] | None = None
) -> list[TableSpec]:
    """Tables to build, parents first."""
    return [
        spec
        for name, spec in TABLES.items()
        if (not only or name in only) and name not in (exclude or ())
    ]


def build_all(
    raw: Mapping[str, DataFrame],
    opts: Options = Options(),
    maps: Maps = Maps(),
    loaded: Mapping[str, DataFrame] | None = None,
    only: Collection[str] | None = None,
    exclude: Collection[str] | None = None,
    rejected: Mapping[str, DataFrame] | None = None,
) -> dict[str, BuildResult]:
    """Builds the selected tables that have rows in ``raw``; ``loaded`` are parent tables
    from earlier runs, ``rejected`` the lines left out per table (see ``read_rejected``). A table
    without input is skipped with a warning."""
    domains = dict(loaded or {})
    results = {}
    for spec in selected(only, exclude):
        if spec.name not in raw:
            log.warning("no input for table %s; skipped", spec.name)
            continue
        lines = (rejected or {}).get(spec.name)
        result = build_table(raw[spec.name], spec, domains, opts, maps, rejected=lines)
        results[spec.name] = result
        domains[spec.table] = result.clean
    return results


def read_folder(spark: SparkSession, folder: str, opts: Options = Options()) -> dict:
    """Text rows of every table that has a folder of files below ``folder``, with their places.
    Quoted fields may hold line breaks. Lines that cannot be rows come along in ``_rejected``, and
    ``build_table`` puts them into quarantine."""
    found = {}
    for name, spec in TABLES.items():
        try:
            found[name] = read_rows(spark, spec, f"{folder}/{name}", opts)
        except AnalysisException:
            log.warning("no files for table %s", name)
    return found


def read_archived(
    spark: SparkSession, folder: str, opts: Options = Options(), categories: Mapping[str, str] | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Text rows of every table from the zip archives of ``folder``, as ``read_folder`` gives them, and
    the members that cannot be read (``path``, ``member``, ``reason``). The letters a file name begins
    with tell its table; ``categories`` maps them to table names where they differ."""
    listed = archives.archive_entries(archives.list_files(spark, folder))
    entries = write_and_reread(archives.numbered_members(listed), "archive-entries")
    named = entries.withColumn("category", archives.category(F.col("path")))
    good = named.where("reason is null")
    sums = good.groupBy("category").agg(F.count(F.lit(1)).alias("members"), F.sum("size").alias("size"))
    present = {r.category: r for r in sums.collect()}
    cores = spark.sparkContext.defaultParallelism
    found = {}
    for name, spec in TABLES.items():
        own = [c for c in present if (categories or {}).get(c, c) == name]
        if not own:
            log.warning("no archives for table %s", name)
            continue
        tasks = archives.reading_tasks(
            sum(present[c].members for c in own), sum(present[c].size for c in own), cores
        )
        records = archives.member_records(good.where(F.col("category").isin(own)), opts.encoding, tasks)
        found[name] = rows_of(records, spec, opts)
    return found, entries.where("reason is not null").select("path", "member", "reason")


def read_rejected(spark: SparkSession, folder: str, opts: Options = Options()) -> dict:
    """The overlong lines of a folder, per table, for rows that were read by ``read_table``."""
    found = {}
    for name, spec in TABLES.items():
        try:
            df = read_delimited(spark, f"{folder}/{name}", spec.read_schema(), opts)
        except AnalysisException:
            continue
        found[name] = malformed(df, len(spec.source_columns))
    return found


def all_quarantine(results: Mapping[str, BuildResult]) -> DataFrame:
    frames = [
        r.quarantine.withColumn("chunk", F.col("chunk").cast("string"))
        for r in results.values()
    ]
    return reduce(DataFrame.unionByName, frames)


"""Registry of queries, each with the survey ids it covers and, where SQL can express it,
the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from checks import inputs
from registrum.operators.membership import without_violations
from registrum.operators.repair import conform, repair
from registrum.session import fresh_path, short_methods
from registrum.specs import COMPANIES, ESTABLISHMENTS, PARTNERS, REGIMES, TableSpec


@dataclass(frozen=True)
class Check:
    run: Callable[[Tables], DataFrame]
    ids: tuple[str, ...]
    sql: str | None


SOURCES = {
    "empresas": "raw_empresas",
    "estabelecimentos": "raw_estab",
    "simples": "raw_simples",
    "socios": "raw_socios",
}
WRITTEN: dict[tuple[str, str, str], str] = {}
ROWS_PER_FILE = 500_000


def spread(df: DataFrame, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Deals the rows out to partitions of a bounded size, however many there are, and to one per
    core at least. Apply it to the narrow given columns, before wide text is made of them."""
    wanted = -(-df.count() // rows_per_file)
    return df.repartition(max(wanted, df.sparkSession.sparkContext.defaultParallelism))


class Loaded(Mapping[str, DataFrame]):
    """Tables by name, each made when it is first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]) -> None:
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


class Tables:
    """The given tables and the text tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _derived(self, name: str) -> DataFrame:
        source, stages = inputs.DERIVED[name]

        def made(df: DataFrame) -> DataFrame:
            for stage in stages[:-1]:
                df = df.selectExpr("*", *[f"{e} AS {n}" for n, e in stage.items()])
            return df.selectExpr(*[f"{e} AS {n}" for n, e in stages[-1].items()])

        given = getattr(self, source)
        if name in inputs.DOMAINS:
            return made(given)
        return self._written(name, lambda: made(spread(given)))

    def _written(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Written once per session, as a source of several files that queries read column
        by column. The files are those of the frame's partitions: the wide rows are not shuffled."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in WRITTEN:
            path = fresh_path(self.spark, f"checks/{name}")
            with short_methods(self.spark):
                make().write.parquet(path)
            WRITTEN[key] = path
        return self.spark.read.parquet(WRITTEN[key])

    @cached_property
    def raw_estab(self) -> DataFrame:
        return self._derived("raw_estab")

    @cached_property
    def raw_empresas(self) -> DataFrame:
        return self._derived("raw_empresas")

    @cached_property
    def raw_socios(self) -> DataFrame:
        return self._derived("raw_socios")

    @cached_property
    def raw_simples(self) -> DataFrame:
        return self._derived("raw_simples")

    @cached_property
    def domains(self) -> dict[str, DataFrame]:
        return {name: self._derived(name) for name in inputs.DOMAINS}


    def _typed(self, spec: TableSpec) -> DataFrame:
        raw = getattr(self, SOURCES[spec.name])
        typed = conform(without_violations(repair(raw, spec)), spec)
        kept = ["k", *spec.column_names] if spec is ESTABLISHMENTS else spec.column_names
        return typed.select(*[c for c in kept if c in typed.columns])

    @cached_property
    def loaded(self) -> Mapping[str, DataFrame]:
        """All tables as loaded, without the checks against their parents. Each is written when a
        query asks for it."""
        makers = {name: partial(self._derived, name) for name in inputs.DOMAINS}
        for spec in (COMPANIES, ESTABLISHMENTS, REGIMES, PARTNERS):
            makers[spec.table] = partial(self._written, f"loaded_{spec.table}", partial(self._typed, spec))
        return Loaded(makers)


CHECKS: dict[str, Check] = {}


def check(name: str, ids: str, sql: str | None = None):
    """Registers a query. ``ids`` are survey ids, separated by blanks."""

    def register(fn: Callable[[Tables], DataFrame]):
        assert name not in CHECKS, name
        CHECKS[name] = Check(fn, tuple(ids.split()), inputs.with_inputs(sql) if sql else None)
        return fn

    return register

"""Keys, references and backfill."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.cleaning import s
from checks.quality import CNAE_BAD, MUN_BAD, PAIS_BAD
from checks.registry import Tables, check
from registrum.operators.integrity import (
    Relation, backfill, foreign_key_report, orphan_keys, orphan_sample, primary_key_report,
)
from registrum.operators.profile import row_counts
from registrum.operators.repair import repair
from registrum.options import Options
from registrum.plans.integrity import integrity_pass
from registrum.specs import ESTABLISHMENTS, UNKNOWN_CODE, UNKNOWN_COMPANY


@check(
    "missing_parents",
    "J5",
    """SELECT cnpj_basico, count(*) AS rows FROM rep_basic r WHERE cnpj_basico IS NOT NULL
       AND NOT EXISTS (SELECT 1 FROM raw_empresas e WHERE e.cnpj_basico = r.cnpj_basico)
       GROUP BY cnpj_basico""",
)
def missing_parents(t: Tables) -> DataFrame:
    tables = t.loaded
    return orphan_keys(
        tables["estabelecimentos"], "cnpj_basico", tables["empresas"], "cnpj_basico"
    )


@check(
    "missing_parent_sample",
    "J5 W2",
    """SELECT l_partkey AS c_custkey, count(*) AS rows FROM lineitem
       WHERE l_partkey NOT IN (SELECT c_custkey FROM customer)
       GROUP BY l_partkey ORDER BY l_partkey LIMIT 10""",
)
def missing_parent_sample(t: Tables) -> DataFrame:
    return orphan_sample(t.lineitem, "l_partkey", t.customer, "c_custkey")


@check(
    "backfilled_domain",
    "U2",
    f"""SELECT n_nationkey AS codigo, n_name AS nome FROM nation
        UNION ALL SELECT DISTINCT CAST(pais_codigo AS INT), '{UNKNOWN_CODE}' FROM rep_basic
        WHERE {PAIS_BAD}""",
)
def backfilled_domain(t: Tables) -> DataFrame:
    child = t.raw_estab.select(F.col("pais_codigo").cast("int").alias("pais_codigo"))
    once = backfill(
        t.domains["paises"], "codigo", [(child, "pais_codigo")], "nome", UNKNOWN_CODE
    )
    # A second pass finds nothing to add.
    return backfill(once, "codigo", [(child, "pais_codigo")], "nome", UNKNOWN_CODE)


@check(
    "primary_keys",
    "A11",
    """SELECT 'lineitem' AS tbl, 'l_orderkey,l_linenumber' AS key,
         CAST(0 AS BIGINT) AS null_key_rows, count(*) FILTER (n > 1) AS repeated_keys,
         CAST(sum(n - 1) AS BIGINT) AS extra_rows
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
       UNION ALL SELECT 'orders', 'o_orderkey', 0, count(*) FILTER (n > 1),
         CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
       UNION ALL SELECT 'estabelecimentos', 'cnpj_basico',
         CAST((SELECT count(*) FROM rep_basic WHERE cnpj_basico IS NULL) AS BIGINT),
         count(*) FILTER (n > 1), CAST(coalesce(sum(n - 1), 0) AS BIGINT)
       FROM (SELECT count(*) AS n FROM rep_basic WHERE cnpj_basico IS NOT NULL
         GROUP BY cnpj_basico)""",
)
def primary_keys(t: Tables) -> DataFrame:
    estab = repair(t.raw_estab, ESTABLISHMENTS)
    reports = [
        primary_key_report(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem"),
        primary_key_report(t.orders, ["o_orderkey"], "orders"),
        primary_key_report(estab, ["cnpj_basico"], "estabelecimentos"),
    ]
    return reports[0].union(reports[1]).union(reports[2]).withColumnRenamed("table", "tbl")


def _relation_sql(child: str, column: str, parent: str, key: str) -> str:
    return f"""SELECT '{child}' AS child, '{column}' AS col, '{parent}' AS parent,
        count(*) AS orphan_rows, count(DISTINCT {column}) AS orphan_keys,
        CAST(min({column}) AS VARCHAR) AS first_key FROM {child} c
        WHERE {column} IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column})"""


RELATIONS = [
    Relation("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Relation("lineitem", "l_partkey", "customer", "c_custkey"),
    Relation("orders", "o_custkey", "customer", "c_custkey"),
    Relation("orders", "o_custkey", "supplier", "s_suppkey"),
    Relation("events", "user_id", "supplier", "s_suppkey"),
]


@check(
    "foreign_keys",
    "A12",
    " UNION ALL ".join(_relation_sql(r.child, r.column, r.parent, r.key) for r in RELATIONS),
)
def foreign_keys(t: Tables) -> DataFrame:
    names = {r.child for r in RELATIONS} | {r.parent for r in RELATIONS}
    tables = {name: getattr(t, name) for name in names}
    return foreign_key_report(tables, RELATIONS).withColumnRenamed("column", "col")


@check(
    "table_row_counts",
    "A13",
    " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, count(*) AS rows FROM {n}" for n in ("orders", "lineitem", "events")
    ),
)
def table_row_counts(t: Tables) -> DataFrame:
    counted = row_counts({n: getattr(t, n) for n in ("orders", "lineitem", "events")})
    return counted.withColumnRenamed("table", "tbl")


PASS = f"""
    SELECT 'estabelecimentos' AS child, 'cnpj_basico' AS col, 'empresas' AS parent,
      CAST(0 AS BIGINT) AS orphan_rows
    UNION ALL SELECT 'estabelecimentos', 'pais_codigo', 'paises', 0
    UNION ALL SELECT 'estabelecimentos', 'municipio_codigo', 'municipios', 0
    UNION ALL SELECT 'estabelecimentos', 'cnae_fiscal_principal_codigo', 'cnaes', 0
    UNION ALL SELECT 'empresas', 'natureza_juridica_codigo', 'naturezas_juridicas', 0
    UNION ALL SELECT 'empresas', 'qualificacao_responsavel', 'qualificacoes_socios', count(*)
      FROM raw_empresas WHERE TRY_CAST(qualificacao_responsavel AS INT)
        NOT IN (SELECT r_regionkey FROM region)
    UNION ALL SELECT 'socios', 'pais_codigo', 'paises', count(*) FROM raw_socios
      WHERE TRY_CAST(pais_codigo AS INT) NOT IN (SELECT n_nationkey FROM nation)
      AND TRY_CAST(pais_codigo AS INT) NOT IN
        (SELECT TRY_CAST(pais_codigo AS INT) FROM rep_basic WHERE pais_codigo IS NOT NULL)
    UNION ALL SELECT 'socios', 'qualificacao_socio_codigo', 'qualificacoes_socios', count(*)
      FROM raw_socios WHERE TRY_CAST(qualificacao_socio_codigo AS INT)
        NOT IN (SELECT r_regionkey FROM region)
    UNION ALL SELECT 'socios', 'cnpj_basico', 'empresas', count(*) FROM raw_socios s
      WHERE NOT EXISTS (SELECT 1 FROM raw_empresas e WHERE e.cnpj_basico = s.cnpj_basico)
      AND NOT EXISTS (SELECT 1 FROM rep_basic r WHERE r.cnpj_basico = s.cnpj_basico)
    UNION ALL SELECT 'simples', 'cnpj_basico', 'empresas', 0"""


@check("integrity_pass", "P3 A12 U2", PASS)
def integrity_of_all(t: Tables) -> DataFrame:
    report = integrity_pass(t.loaded).foreign_keys
    return report.select("child", F.col("column").alias("col"), "parent", "orphan_rows")


@check(
    "backfilled_parents",
    "U2 P3",
    f"""SELECT 'paises' AS tbl, CAST(count(DISTINCT pais_codigo) AS BIGINT) AS added
          FROM rep_basic WHERE {PAIS_BAD}
        UNION ALL SELECT 'municipios', count(DISTINCT municipio_codigo) FROM rep_basic
          WHERE {MUN_BAD}
        UNION ALL SELECT 'cnaes', count(DISTINCT cnae_fiscal_principal_codigo) FROM rep_basic
          WHERE {CNAE_BAD}
        UNION ALL SELECT 'empresas', count(DISTINCT cnpj_basico) FROM rep_basic r
          WHERE cnpj_basico IS NOT NULL AND NOT EXISTS
            (SELECT 1 FROM raw_empresas e WHERE e.cnpj_basico = r.cnpj_basico)
        UNION ALL SELECT 'naturezas_juridicas', count(DISTINCT natureza_juridica_codigo)
          FROM raw_empresas WHERE TRY_CAST(natureza_juridica_codigo AS INT)
            NOT IN (SELECT r_regionkey FROM region)""",
)
def backfilled_parents(t: Tables) -> DataFrame:
    before = t.loaded
    after = integrity_pass(before).tables
    out = None
    for name in ("paises", "municipios", "cnaes", "empresas", "naturezas_juridicas"):
        label = "razao_social" if name == "empresas" else "nome"
        filled = after[name].where(
            F.col(label).isin(UNKNOWN_CODE, UNKNOWN_COMPANY)
        )
        one = filled.agg(F.count(F.lit(1)).alias("added")).select(F.lit(name).alias("tbl"), "added")
        out = one if out is None else out.union(one)
    return out.select("tbl", s("added").cast("long").alias("added"))


def _full_sql(child: str, column: str, parent: str, source: str, known: str, number: bool) -> str:
    key = f"TRY_CAST({column} AS INT)" if number else column
    return f"""SELECT '{child}' AS child, '{column}' AS col, '{parent}' AS parent,
        CAST(count(*) AS BIGINT) AS orphan_rows, count(DISTINCT {key}) AS orphan_keys,
        CAST(min({key}) AS VARCHAR) AS first_key FROM {source}
        WHERE {key} IS NOT NULL AND {key} NOT IN ({known})"""


NATIONS, CITIES_IN = "SELECT n_nationkey FROM nation", "SELECT s_suppkey FROM supplier"
REGIONS, PARTS, FIRMS = "SELECT r_regionkey FROM region", "SELECT p_partkey FROM part", "SELECT cnpj_basico FROM raw_empresas"


@check(
    "orphans_of_all",
    "A12 P3",
    " UNION ALL ".join(
        _full_sql(*r)
        for r in (
            ("empresas", "natureza_juridica_codigo", "naturezas_juridicas", "raw_empresas", REGIONS, True),
            ("empresas", "qualificacao_responsavel", "qualificacoes_socios", "raw_empresas", REGIONS, True),
            ("estabelecimentos", "cnpj_basico", "empresas", "rep_basic", FIRMS, False),
            ("estabelecimentos", "pais_codigo", "paises", "rep_basic", NATIONS, True),
            ("estabelecimentos", "municipio_codigo", "municipios", "rep_basic", CITIES_IN, True),
            ("estabelecimentos", "cnae_fiscal_principal_codigo", "cnaes", "rep_basic", PARTS, True),
            ("simples", "cnpj_basico", "empresas", "(SELECT * FROM raw_simples WHERE length(cnpj_basico) = 8)", FIRMS, False),
            ("socios", "cnpj_basico", "empresas", "raw_socios", FIRMS, False),
            ("socios", "pais_codigo", "paises", "raw_socios", NATIONS, True),
            ("socios", "qualificacao_socio_codigo", "qualificacoes_socios", "raw_socios", REGIONS, True),
        )
    ),
)
def orphans_of_all(t: Tables) -> DataFrame:
    """Every column of the report, before any backfill: all relations from one scan per child."""
    report = integrity_pass(t.loaded, Options(backfill=False)).foreign_keys
    return report.withColumnRenamed("column", "col")

"""The nine registry tables: columns by position, target types, keys and references."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.functions.codes import split_list
from registrum.functions.text import decimal_comma, ymd_date


@dataclass(frozen=True)
class Reference:
    """A child column and its parent table. ``parent`` None means a literal set of states."""

    column: str
    parent: str | None = None
    key: str = "codigo"
    checked_on_load: bool = True
    enforced: bool = True
    backfill: str | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    table: str
    columns: tuple[tuple[str, str], ...]
    derived: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    critical: tuple[str, ...] = ()
    tracked: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    id_parts: tuple[str, ...] = ()
    hook: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def source_columns(self) -> list[str]:
        return [name for name in self.column_names if name not in self.derived]

    def read_schema(self) -> T.StructType:
        """All text: types are applied later, by explicit casts."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.source_columns])

    def parents(self) -> list[str]:
        """Parent tables the load check needs."""
        seen = dict.fromkeys(
            r.parent for r in self.references if r.checked_on_load and r.parent is not None
        )
        return list(seen)


def _each(df: DataFrame, names: tuple[str, ...], fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: fn(F.col(c)) for c in names if c in df.columns})


def parse_dates(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return _each(df, names, ymd_date)


def company_hook(df: DataFrame) -> DataFrame:
    return _each(df, ("capital_social",), decimal_comma)


def establishment_hook(df: DataFrame) -> DataFrame:
    dated = parse_dates(
        df, ("data_situacao_cadastral", "data_inicio_atividade", "data_situacao_especial")
    )
    return _each(dated, ("cnae_fiscal_secundaria",), split_list)


def partner_hook(df: DataFrame) -> DataFrame:
    return parse_dates(df, ("data_entrada_sociedade",))


def regime_hook(df: DataFrame) -> DataFrame:
    return parse_dates(
        df,
        (
            "data_opcao_pelo_simples",
            "data_exclusao_do_simples",
            "data_opcao_pelo_mei",
            "data_exclusao_do_mei",
        ),
    )


# Tables, columns by position, target types, keys and references.
UNKNOWN_CODE = "NAO CONSTA NA ORIGEM"
UNKNOWN_COMPANY = "EMPRESA INEXISTENTE NA ORIGEM - GERADA AUTOMATICAMENTE"


def _domain(name: str, table: str, code: str, label_length: int) -> TableSpec:
    return TableSpec(
        name=name,
        table=table,
        columns=(("codigo", code), ("nome", f"varchar({label_length})")),
        key=("codigo",),
    )


COUNTRIES = _domain("paises", "paises", "smallint", 100)
CITIES = _domain("municipios", "municipios", "smallint", 150)
QUALIFICATIONS = _domain("qualificacoes", "qualificacoes_socios", "smallint", 100)
LEGAL_NATURES = _domain("naturezas", "naturezas_juridicas", "smallint", 150)
ACTIVITIES = _domain("cnaes", "cnaes", "int", 500)

COMPANIES = TableSpec(
    name="empresas",
    table="empresas",
    columns=(
        ("cnpj_basico", "char(8)"),
        ("razao_social", "varchar(255)"),
        ("natureza_juridica_codigo", "smallint"),
        ("qualificacao_responsavel", "smallint"),
        ("capital_social", "decimal(18,2)"),
        ("porte_empresa", "smallint"),
        ("ente_federativo_responsavel", "varchar(100)"),
    ),
    key=("cnpj_basico",),
    critical=("cnpj_basico",),
    tracked=("cnpj_basico", "razao_social"),
    references=(
        Reference("natureza_juridica_codigo", "naturezas_juridicas", backfill=UNKNOWN_CODE),
        Reference("qualificacao_responsavel", "qualificacoes_socios"),
    ),
    hook=company_hook,
)

ESTABLISHMENTS = TableSpec(
    name="estabelecimentos",
    table="estabelecimentos",
    columns=(
        ("cnpj_basico", "char(8)"),
        ("cnpj_ordem", "char(4)"),
        ("cnpj_dv", "char(2)"),
        ("identificador_matriz_filial", "smallint"),
        ("nome_fantasia", "varchar(255)"),
        ("situacao_cadastral", "smallint"),
        ("data_situacao_cadastral", "date"),
        ("motivo_situacao_cadastral", "smallint"),
        ("nome_cidade_exterior", "varchar(100)"),
        ("pais_codigo", "smallint"),
        ("data_inicio_atividade", "date"),
        ("cnae_fiscal_principal_codigo", "int"),
        ("cnae_fiscal_secundaria", "array<int>"),
        ("tipo_logradouro", "varchar(50)"),
        ("logradouro", "varchar(255)"),
        ("numero", "varchar(20)"),
        ("complemento", "varchar(255)"),
        ("bairro", "varchar(100)"),
        ("cep", "char(8)"),
        ("uf", "char(2)"),
        ("municipio_codigo", "smallint"),
        ("ddd_1", "varchar(4)"),
        ("telefone_1", "varchar(9)"),
        ("ddd_2", "varchar(4)"),
        ("telefone_2", "varchar(9)"),
        ("ddd_fax", "varchar(4)"),
        ("fax", "varchar(9)"),
        ("correio_eletronico", "varchar(255)"),
        ("situacao_especial", "varchar(100)"),
        ("data_situacao_especial", "date"),
        ("municipio_nome", "varchar(150)"),
        ("uf_source", "varchar(20)"),
        ("municipio_source", "varchar(20)"),
    ),
    derived=("municipio_nome", "uf_source", "municipio_source"),
    key=("cnpj_basico", "cnpj_ordem", "cnpj_dv"),
    critical=("cnpj_basico", "cnpj_ordem", "cnpj_dv"),
    tracked=(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "uf", "cep",
        "cnae_fiscal_principal_codigo", "cnae_fiscal_secundaria", "correio_eletronico",
    ),
    references=(
        Reference(
            "cnpj_basico", "empresas", key="cnpj_basico",
            checked_on_load=False, backfill=UNKNOWN_COMPANY,
        ),
        Reference("pais_codigo", "paises", backfill=UNKNOWN_CODE),
        Reference("municipio_codigo", "municipios", backfill=UNKNOWN_CODE),
        Reference("cnae_fiscal_principal_codigo", "cnaes", backfill=UNKNOWN_CODE),
        Reference("uf", enforced=False),
    ),
    id_parts=("cnpj_basico", "cnpj_ordem", "cnpj_dv"),
    hook=establishment_hook,
)

REGIMES = TableSpec(
    name="simples",
    table="simples",
    columns=(
        ("cnpj_basico", "char(8)"),
        ("opcao_pelo_simples", "char(1)"),
        ("data_opcao_pelo_simples", "date"),
        ("data_exclusao_do_simples", "date"),
        ("opcao_pelo_mei", "char(1)"),
        ("data_opcao_pelo_mei", "date"),
        ("data_exclusao_do_mei", "date"),
    ),
    key=("cnpj_basico",),
    critical=("cnpj_basico",),
    tracked=("cnpj_basico",),
    references=(
        Reference("cnpj_basico", "empresas", key="cnpj_basico", checked_on_load=False),
    ),
    hook=regime_hook,
)

PARTNERS = TableSpec(
    name="socios",
    table="socios",
    columns=(
        ("cnpj_basico", "char(8)"),
        ("identificador_socio", "smallint"),
        ("nome_socio_ou_razao_social", "varchar(255)"),
        ("cnpj_cpf_socio", "varchar(14)"),
        ("qualificacao_socio_codigo", "smallint"),
        ("data_entrada_sociedade", "date"),
        ("pais_codigo", "smallint"),
        ("representante_legal_cpf", "varchar(11)"),
        ("nome_representante_legal", "varchar(255)"),
        ("qualificacao_representante_legal_codigo", "smallint"),
        ("faixa_etaria", "smallint"),
    ),
    critical=("cnpj_basico", "cnpj_cpf_socio"),
    tracked=("cnpj_basico", "cnpj_cpf_socio", "representante_legal_cpf"),
    references=(
        Reference("cnpj_basico", "empresas", key="cnpj_basico", checked_on_load=False),
        Reference("pais_codigo", "paises"),
        Reference("qualificacao_socio_codigo", "qualificacoes_socios"),
        Reference(
            "qualificacao_representante_legal_codigo", "qualificacoes_socios", enforced=False
        ),
    ),
    hook=partner_hook,
)

# Parents come before their children.
TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        COUNTRIES, CITIES, QUALIFICATIONS, LEGAL_NATURES, ACTIVITIES,
        COMPANIES, ESTABLISHMENTS, REGIMES, PARTNERS,
    )
}

"""Repair profiles: which cleaner applies to which column, per table and level."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.functions import codes, contact, taxid, text
from registrum.specs import TableSpec

BEFORE = "_before"
INVALID_ID = "_invalid_id"
OVERFLOW = "_overflow"

Cleaner = Callable[[Column], Column]


def length(n: int) -> Cleaner:
    return partial(text.digits_of_length, n=n)


def then(*steps: Cleaner) -> Cleaner:
    def chained(c: Column) -> Column:
        for step in steps:
            c = step(c)
        return c

    return chained


AREA_COLUMNS = ("ddd_1", "ddd_2", "ddd_fax")
PHONE_COLUMNS = ("telefone_1", "telefone_2", "fax")
PHONE_PAIRS = tuple(zip(AREA_COLUMNS, PHONE_COLUMNS))
NAME_COLUMNS = (
    "nome_fantasia", "tipo_logradouro", "logradouro", "complemento", "bairro",
    "situacao_especial", "nome_cidade_exterior", "municipio_nome",
)


def _companies() -> dict[str, Cleaner]:
    return {
        "cnpj_basico": length(8),
        "razao_social": text.blank_to_null,
        "ente_federativo_responsavel": text.blank_to_null,
    }


def _establishments(aggressive: bool) -> dict[str, Cleaner]:
    rules: dict[str, Cleaner] = {
        "cnpj_basico": length(8),
        "cnpj_ordem": length(4),
        "cnpj_dv": length(2),
        "cep": length(8),
        "uf": text.state,
        "correio_eletronico": text.email,
        "cnae_fiscal_principal_codigo": codes.activity_code,
        "cnae_fiscal_secundaria": codes.codes_in,
        "numero": text.digits_or_null,
    }
    rules |= dict.fromkeys(NAME_COLUMNS, text.blank_to_null)
    rules |= dict.fromkeys(AREA_COLUMNS + PHONE_COLUMNS, text.digits_or_null)
    if aggressive:
        rules["correio_eletronico"] = text.email_both
        rules["cnae_fiscal_secundaria"] = then(codes.codes_in, codes.code_set)
        rules |= dict.fromkeys(AREA_COLUMNS, then(text.digits_or_null, contact.area_code))
        rules |= dict.fromkeys(PHONE_COLUMNS, then(text.digits_or_null, contact.phone))
    return rules


def _partners() -> dict[str, Cleaner]:
    return {
        "cnpj_basico": length(8),
        "cnpj_cpf_socio": taxid.any_tax_id,
        "representante_legal_cpf": taxid.person_id,
        "nome_socio_ou_razao_social": text.blank_to_null,
        "nome_representante_legal": text.blank_to_null,
    }


def profile(table: str, level: str) -> dict[str, Cleaner]:
    """Cleaners by column. Level ``none`` and the code domains have none."""
    if level == "none":
        return {}
    return {
        "empresas": _companies(),
        "estabelecimentos": _establishments(level == "aggressive"),
        "socios": _partners(),
        "simples": {"cnpj_basico": length(8)},
    }.get(table, {})


def data_columns(df: DataFrame) -> list[str]:
    """Columns of the table itself; the working columns start with '_'."""
    return [c for c in df.columns if not c.startswith("_")]


def with_before(df: DataFrame, columns: list[str]) -> DataFrame:
    """Keeps the present values in one struct, for the counts of the telemetry."""
    kept = F.struct(*columns) if columns else F.struct(F.lit(None).cast("string").alias("_"))
    return df.withColumn(BEFORE, kept)


def apply_cleaners(df: DataFrame, rules: Mapping[str, Cleaner]) -> DataFrame:
    """Runs a cleaner on every column that is present, in one projection."""
    exprs = {}
    for name, rule in rules.items():
        if name not in df.columns:
            continue
        source = F.col(name)
        if rule is codes.codes_in and isinstance(df.schema[name].dataType, T.StringType):
            rule = codes.code_list
        exprs[name] = rule(source)
    return df.withColumns(exprs) if exprs else df


def flag_invalid_ids(df: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """``parts`` are cleaned already, so their digits are joined as they are."""
    flag = F.lit(False)
    if parts and set(parts) <= set(df.columns):
        whole = F.concat(*[F.coalesce(F.col(p), F.lit("")) for p in parts])
        flag = F.coalesce(taxid.invalid_whole_id(whole), F.lit(False))
    return df.withColumn(INVALID_ID, flag)


def repair(
    df: DataFrame, spec: TableSpec, level: str = "basic", extra: tuple[str, ...] = ()
) -> DataFrame:
    """Hook of the table, then its cleaners, then the id flag.

    Adds ``_invalid_id`` and ``_before``: the values after the hook of the columns that have
    a cleaner, and of ``extra`` columns that a later step may fill.
    """
    hooked = spec.hook(df) if spec.hook else df
    rules = profile(spec.name, level)
    touched = [c for c in (*rules, *extra) if c in hooked.columns]
    cleaned = apply_cleaners(with_before(hooked, touched), rules)
    return flag_invalid_ids(cleaned, () if level == "none" else spec.id_parts)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cast(name: str, kind: str) -> tuple[str, str]:
    """SQL of the column in its target type, and of whether it does not fit."""
    c = quoted(name)
    if kind.startswith(("char", "varchar")):
        size = int(kind[kind.index("(") + 1 : -1])
        value = f"CAST({c} AS STRING)"
        return value, f"length({value}) > {size}"
    value = f"try_cast({c} AS {kind})"
    lost = f"({c} IS NOT NULL AND {value} IS NULL)"
    if kind.startswith("array"):
        lost += f" OR exists({value}, x -> x IS NULL)"
    return value, lost


def conform(df: DataFrame, spec: TableSpec, strict: bool = False) -> DataFrame:
    """Casts to the target types and lists the columns that do not fit in ``_overflow``.

    Over-long text is kept and listed; a value that cannot be cast becomes null and is
    listed. With ``strict`` any listed column raises.
    """
    values, misfits = {}, []
    for name, kind in spec.columns:
        if name in df.columns:
            value, bad = _cast(name, kind)
            values[name] = F.expr(value)
            misfits.append(f"CASE WHEN {bad} THEN '{name}' END")
    listed = F.expr(f"array_compact(array({', '.join(misfits)}))")
    out = df.withColumn(OVERFLOW, listed).withColumns(values)
    if strict:
        bad_row = out.where(F.size(OVERFLOW) > 0).select(OVERFLOW).head()
        if bad_row:
            raise ValueError(f"{spec.table}: values do not fit columns {bad_row[0]}")
    return out

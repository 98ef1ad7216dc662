"""Text tables with known faults, derived from all rows of the given tables.

The expressions are valid in Spark and in DuckDB, so both sides start from the same rows.
"""

from __future__ import annotations

import re

from registrum.functions.taxid import COMPANY_WEIGHTS, PERSON_WEIGHTS
from registrum.functions.text import STATES


def text(x: str) -> str:
    return f"CAST({x} AS VARCHAR(20))"


def lp(x: str, n: int) -> str:
    return f"lpad({text(x)}, {n}, '0')"


def digit_sum(x: str, weights: tuple[int, ...]) -> str:
    return " + ".join(
        f"CAST(substr({x}, {i}, 1) AS INT) * {w}" for i, w in enumerate(weights, start=1)
    )


def made_digit(x: str, weights: tuple[int, ...]) -> str:
    return f"((11 - ({digit_sum(x, weights)}) % 11) % 11 % 10)"


def check_digit(x: str, weights: tuple[int, ...]) -> str:
    total = digit_sum(x, weights)
    return f"(CASE WHEN ({total}) % 11 < 2 THEN 0 ELSE 11 - ({total}) % 11 END)"


DAY = "replace(CAST(CAST({} AS DATE) AS VARCHAR(10)), '-', '')"
STATE_LIST = "".join(STATES) + "EX" + "  "

ESTAB_STAGES = [
    {"k": "o_orderkey", "c": "o_custkey", "d": DAY.format("o_orderdate")},
    {
        # A part of the establishments belongs to companies that do not exist.
        "b12": f"concat(CASE WHEN k % 59 = 0 THEN '9' ELSE substr({lp('c', 8)}, 1, 1) END, "
        f"substr({lp('c', 8)}, 2, 7), {lp('k % 10000', 4)})",
        "st": f"trim(substr('{STATE_LIST}', CAST(1 + 2 * (c % 29) AS INT), 2))",
        "ph": f"{lp('900000000 + k % 99999999', 9)}",
        "zip": f"{lp('c * 7919 % 100000000', 8)}",
    },
    {"b13": f"concat(b12, {text(made_digit('b12', COMPANY_WEIGHTS[0]))})"},
    {"b14": f"concat(b13, {text(made_digit('b13', COMPANY_WEIGHTS[1]))})"},
    {
        "k": "k",
        "cnpj_basico": "CASE WHEN k % 41 = 0 THEN substr(b12, 1, 5) "
        "WHEN k % 37 = 0 THEN concat(' ', substr(b12, 1, 2), '.', substr(b12, 3, 3), '.', "
        "substr(b12, 6, 3)) ELSE substr(b12, 1, 8) END",
        "cnpj_ordem": "substr(b12, 9, 4)",
        "cnpj_dv": "CASE WHEN k % 11 = 0 THEN '00' ELSE substr(b14, 13, 2) END",
        "identificador_matriz_filial": "CASE WHEN k % 3 = 1 THEN '1' ELSE '2' END",
        "nome_fantasia": "CASE WHEN k % 19 = 0 THEN '   ' "
        f"ELSE concat(' Loja ', {text('c')}, ' ') END",
        "situacao_cadastral": "CASE k % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' "
        "WHEN 3 THEN '4' ELSE '08' END",
        "pais_codigo": f"{lp('k % 30', 3)}",
        "data_inicio_atividade": "CASE WHEN k % 29 = 0 THEN '20241301' "
        "WHEN k % 47 = 0 THEN '00000000' ELSE d END",
        "cnae_fiscal_principal_codigo": "CASE WHEN k % 49 = 0 THEN "
        f"{lp('9000000 + c % 50', 7)} WHEN k % 67 = 0 THEN '12' ELSE {lp('c % 200', 7)} END",
        "cnae_fiscal_secundaria": "CASE WHEN k % 23 = 0 THEN '' "
        f"WHEN k % 7 = 0 THEN concat({text('1000000 + k % 97')}, ' ; ', "
        f"{text('2000000 + k % 89')}, ',abc') "
        f"WHEN k % 9 = 0 THEN concat({text('2000000 + k % 89')}, ',', "
        f"{text('1000000 + k % 97')}, ',', {text('2000000 + k % 89')}) "
        f"ELSE concat({text('1000000 + k % 97')}, ',', {text('2000000 + k % 89')}) END",
        "numero": "CASE k % 8 WHEN 0 THEN 'S/N' WHEN 1 THEN '12A' "
        f"ELSE {text('k % 1000')} END",
        "cep": "CASE WHEN k % 43 = 0 THEN NULL WHEN k % 4 = 0 THEN "
        "concat(substr(zip, 1, 5), '-', substr(zip, 6, 3)) ELSE zip END",
        "uf": "CASE WHEN k % 5 = 0 THEN concat(' ', lower(st)) ELSE st END",
        "municipio_codigo": "CASE WHEN k % 31 = 0 THEN NULL "
        f"WHEN k % 71 = 0 THEN {text('900 + c % 10')} ELSE {text('c % 100')} END",
        "ddd_1": f"CASE WHEN k % 6 = 0 THEN concat('(0', {text('11 + c % 80')}, ')') "
        f"ELSE {text('11 + c % 80')} END",
        "telefone_1": "CASE WHEN k % 53 = 0 THEN '123' WHEN k % 3 = 0 THEN "
        "concat(substr(ph, 1, 5), '-', substr(ph, 6, 4)) ELSE ph END",
        # All addresses of the first thousand rows are bad: their chunk must be gated.
        "correio_eletronico": "CASE WHEN k < 1000 THEN 'sem email' WHEN k % 13 = 0 THEN 'bad@@mail' "
        "WHEN k % 17 = 0 THEN '' WHEN k % 19 = 0 THEN 'a..b@x.com' "
        f"WHEN k % 10 = 0 THEN concat('User', {text('c')}, '@Mail', {text('k % 9')}, "
        f"'.Example.com') ELSE concat('user', {text('c')}, '@mail', {text('k % 9')}, "
        "'.example.com') END",
        "municipio_nome": f"CASE k % 4 WHEN 0 THEN concat('Município ', {text('c % 100')}) "
        f"WHEN 1 THEN concat(' MUNICÍPIO ', {text('c % 100')}, ' ') "
        f"WHEN 2 THEN concat('municipio ', {text('c % 100')}) "
        f"ELSE concat('Municipio ', {text('c % 100')}) END",
        "uf_source": "CAST(NULL AS VARCHAR(20))",
        "municipio_source": "CAST(NULL AS VARCHAR(20))",
        "_chunk": "CAST(floor(k / 1000) AS BIGINT) + 1",
    },
]

EMPRESAS_STAGES = [
    {"cents": "CAST(round(abs(c_acctbal) * 100) AS BIGINT)"},
    {"units": "CAST(floor(cents / 100) AS BIGINT)"},
    {
        "k": "c_custkey",
        "cnpj_basico": lp("c_custkey", 8),
        "razao_social": "CASE WHEN c_custkey % 59 = 0 THEN '  ' "
        "WHEN c_custkey % 61 = 0 THEN 'NULL' WHEN c_custkey % 5 = 0 THEN concat(' ', c_name) "
        "ELSE c_name END",
        "natureza_juridica_codigo": text("c_nationkey % 7"),
        "qualificacao_responsavel": text("c_nationkey % 5"),
        "capital_social": "CASE WHEN c_custkey % 31 = 0 THEN 'abc' WHEN units >= 1000 THEN "
        f"concat({text('CAST(floor(units / 1000) AS BIGINT)')}, '.', {lp('units % 1000', 3)}, "
        f"',', {lp('cents % 100', 2)}) ELSE concat({text('units')}, ',', "
        f"{lp('cents % 100', 2)}) END",
        "porte_empresa": "CASE c_custkey % 4 WHEN 0 THEN '01' WHEN 1 THEN '02' "
        "WHEN 2 THEN '03' ELSE '05' END",
        "ente_federativo_responsavel": "CASE WHEN c_custkey % 7 = 0 THEN 'UNIÃO' "
        "WHEN c_custkey % 11 = 0 THEN ' ' ELSE NULL END",
        "_chunk": "CAST(floor(c_custkey / 1000) AS BIGINT) + 1",
    },
]

SOCIOS_STAGES = [
    {
        "o": "l_orderkey",
        "n": "l_linenumber",
        "b9": lp("l_orderkey * 6151 % 1000000000", 9),
    },
    {"b10": f"concat(b9, {text(made_digit('b9', PERSON_WEIGHTS[0]))})"},
    {"b11": f"concat(b10, {text(made_digit('b10', PERSON_WEIGHTS[1]))})"},
    {
        "o": "o",
        "n": "n",
        "cnpj_basico": lp("l_partkey", 8),
        "identificador_socio": text("1 + n % 3"),
        "nome_socio_ou_razao_social": f"CASE WHEN o % 23 = 0 THEN ' ' "
        f"ELSE concat('Sócio ', {text('o')}) END",
        "cnpj_cpf_socio": "CASE WHEN o % 17 = 0 THEN concat('***', substr(b11, 4, 6), '**') "
        f"WHEN o % 13 = 0 THEN concat(b10, {text('(CAST(substr(b11, 11, 1) AS INT) + 1) % 10')})"
        " ELSE b11 END",
        "qualificacao_socio_codigo": text("n % 6"),
        "data_entrada_sociedade": f"CASE WHEN o % 19 = 0 THEN '' ELSE "
        f"{DAY.format('l_shipdate')} END",
        "pais_codigo": "CASE WHEN n = 3 THEN " + text("o % 27") + " ELSE '' END",
        "representante_legal_cpf": "CASE WHEN o % 3 = 0 THEN concat(substr(b11, 1, 3), '.', "
        "substr(b11, 4, 3), '.', substr(b11, 7, 3), '-', substr(b11, 10, 2)) "
        "ELSE '000.000.000-00' END",
        "nome_representante_legal": "CASE WHEN o % 3 = 0 THEN 'Rep ' ELSE '' END",
        "qualificacao_representante_legal_codigo": text("n % 5"),
        "faixa_etaria": text("o % 10"),
        "_chunk": "CAST(floor(o / 1000) AS BIGINT) + 1",
    },
]

SIMPLES_STAGES = [
    {
        "k": "c_custkey",
        "cnpj_basico": "CASE WHEN c_custkey % 101 = 0 THEN '12' ELSE "
        + lp("c_custkey", 8)
        + " END",
        "opcao_pelo_simples": "CASE c_custkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'N' ELSE '' END",
        "data_opcao_pelo_simples": "CASE WHEN c_custkey % 7 = 0 THEN '00000000' ELSE concat("
        + text("2000 + c_custkey % 20")
        + ", "
        + lp("1 + c_custkey % 12", 2)
        + ", '15') END",
        "data_exclusao_do_simples": "CASE WHEN c_custkey % 5 = 0 THEN '20240230' ELSE '' END",
        "opcao_pelo_mei": "CASE c_custkey % 4 WHEN 0 THEN 'S' WHEN 1 THEN '' ELSE 'N' END",
        "data_opcao_pelo_mei": "'20200229'",
        "data_exclusao_do_mei": "''",
        "_chunk": "CAST(floor(c_custkey / 1000) AS BIGINT) + 1",
    },
]


def domain(code: str, label: str) -> list[dict[str, str]]:
    return [{"codigo": f"CAST({code} AS INT)", "nome": label}]


DERIVED: dict[str, tuple[str, list[dict[str, str]]]] = {
    "raw_estab": ("orders", ESTAB_STAGES),
    "raw_empresas": ("customer", EMPRESAS_STAGES),
    "raw_socios": ("lineitem", SOCIOS_STAGES),
    "raw_simples": ("customer", SIMPLES_STAGES),
    "paises": ("nation", domain("n_nationkey", "n_name")),
    "municipios": ("supplier", domain("s_suppkey", "s_name")),
    "qualificacoes_socios": ("region", domain("r_regionkey", "r_name")),
    "naturezas_juridicas": ("region", domain("r_regionkey", "r_name")),
    "cnaes": ("part", domain("p_partkey", "p_name")),
}
DOMAINS = ("paises", "municipios", "qualificacoes_socios", "naturezas_juridicas", "cnaes")


def derived_sql(name: str) -> str:
    source, stages = DERIVED[name]
    sql = source
    for i, stage in enumerate(stages[:-1]):
        fields = ", ".join(f"{e} AS {n}" for n, e in stage.items())
        sql = f"(SELECT *, {fields} FROM {sql} AS s{i})"
    fields = ", ".join(f"{e} AS {n}" for n, e in stages[-1].items())
    return f"SELECT {fields} FROM {sql} AS last"


# ---- SQL of the cleaners, written for DuckDB alone ----

BLANKS = (
    "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '"
    "||chr(133)||chr(160)||chr(5760)||chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)"
    "||chr(8197)||chr(8198)||chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)"
    "||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
)


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def blank_to_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '', 'g')"


def of_length(x: str, n: int) -> str:
    return f"CASE WHEN length({digits(x)}) = {n} THEN {digits(x)} END"


def state(x: str) -> str:
    allowed = ", ".join(f"'{s}'" for s in STATES)
    return f"CASE WHEN upper({strip(x)}) IN ({allowed}) THEN upper({strip(x)}) END"


def email(x: str) -> str:
    t = f"lower({strip(x)})"
    return (
        f"CASE WHEN regexp_full_match({t}, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') THEN {t} END"
    )


def email_strict(x: str) -> str:
    t = strip(x)
    local, dom = f"split_part({t}, '@', 1)", f"rtrim(lower({strip(f'split_part({t}, chr(64), 2)')}), '.')"
    labels = f"string_split({dom}, '.')"
    return (
        f"CASE WHEN length({t}) - length(replace({t}, '@', '')) = 1 "
        f"AND regexp_full_match({local}, '[A-Za-z0-9._%+-]+') "
        f"AND {local} NOT LIKE '.%' AND {local} NOT LIKE '%.' AND {local} NOT LIKE '%..%' "
        f"AND len({labels}) >= 2 AND length({labels}[-1]) >= 2 "
        f"AND len(list_filter({labels}, lambda l: NOT regexp_full_match(l, '[a-z0-9-]{{1,63}}') "
        f"OR l LIKE '-%' OR l LIKE '%-')) = 0 "
        f"THEN concat({local}, '@', {dom}) END"
    )


def valid_id(x: str, weights: tuple[tuple[int, ...], ...]) -> str:
    n = len(weights[1]) + 1
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL "
        f"WHEN NOT regexp_full_match({x}, '[0-9]{{{n}}}') THEN false "
        f"WHEN {x} = repeat(substr({x}, 1, 1), {n}) THEN false "
        f"ELSE CAST(substr({x}, {n - 1}, 1) AS INT) = {check_digit(x, weights[0])} "
        f"AND CAST(substr({x}, {n}, 1) AS INT) = {check_digit(x, weights[1])} END)"
    )


def company_valid(x: str) -> str:
    return valid_id(x, COMPANY_WEIGHTS)


def person_valid(x: str) -> str:
    return valid_id(x, PERSON_WEIGHTS)


def day(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '[0-9]{{8}}') "
        f"THEN CAST(try_strptime({x}, '%Y%m%d') AS DATE) END"
    )


def token_list(x: str) -> str:
    """Trimmed parts of a list text, or null."""
    parts = f"list_filter(list_transform(regexp_split_to_array({x}, '[;,]'), lambda t: trim(t)), lambda t: t <> '')"
    return f"CASE WHEN len({parts}) > 0 THEN {parts} END"


def seven_digits(x: str) -> str:
    """Parts with seven digits, or null."""
    codes = f"list_filter(list_transform({x}, lambda t: {digits('t')}), lambda t: length(t) = 7)"
    return f"CASE WHEN len({codes}) > 0 THEN {codes} END"


def code_set(x: str) -> str:
    return f"list_sort(list_distinct(list_transform({x}, lambda t: CAST(t AS INT))))"


def literal(x: str) -> str:
    return f"concat('{{', array_to_string({x}, ','), '}}')"


def literal_or_null(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN {literal(x)} END"


def nullable_text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def code7(x: str) -> str:
    return f"CASE WHEN length({digits(x)}) = 7 THEN CAST({digits(x)} AS INT) END"


def phone_digits(x: str) -> str:
    return f"nullif({digits(x)}, '')"


def repaired_estab(level: str) -> str:
    """The repaired establishments; columns as the Spark plan leaves them, before values
    with a ``b_`` prefix, lists as '{a,b}'."""
    area, phone = phone_digits("ddd_1"), phone_digits("telefone_1")
    mail, codes = email(blank_to_null("correio_eletronico")), seven_digits("toks")
    if level == "aggressive":
        area = f"CASE WHEN length({area}) IN (2, 3) THEN {area} END"
        phone = f"CASE WHEN length({phone}) BETWEEN 8 AND 11 THEN {phone} END"
        mail, codes = email_strict(f"({mail})"), code_set(f"({codes})")
    return f"""
    SELECT k, _chunk,
      {of_length('cnpj_basico', 8)} AS cnpj_basico,
      {of_length('cnpj_ordem', 4)} AS cnpj_ordem,
      {of_length('cnpj_dv', 2)} AS cnpj_dv,
      identificador_matriz_filial,
      {blank_to_null('nome_fantasia')} AS nome_fantasia,
      situacao_cadastral, pais_codigo,
      {day('data_inicio_atividade')} AS data_inicio_atividade,
      {code7('cnae_fiscal_principal_codigo')} AS cnae_fiscal_principal_codigo,
      {literal_or_null(f'({codes})')} AS cnae_fiscal_secundaria,
      {phone_digits('numero')} AS numero,
      {of_length('cep', 8)} AS cep,
      {state('uf')} AS uf,
      municipio_codigo,
      {area} AS ddd_1, {phone} AS telefone_1,
      {mail} AS correio_eletronico,
      {blank_to_null('municipio_nome')} AS municipio_nome,
      cnpj_basico AS b_cnpj_basico, cnpj_ordem AS b_cnpj_ordem, cnpj_dv AS b_cnpj_dv,
      nome_fantasia AS b_nome_fantasia,
      cnae_fiscal_principal_codigo AS b_cnae_fiscal_principal_codigo,
      {literal_or_null('toks')} AS b_cnae_fiscal_secundaria,
      numero AS b_numero, cep AS b_cep, uf AS b_uf, ddd_1 AS b_ddd_1,
      telefone_1 AS b_telefone_1, correio_eletronico AS b_correio_eletronico,
      municipio_nome AS b_municipio_nome
    FROM (SELECT *, {token_list('cnae_fiscal_secundaria')} AS toks FROM raw_estab)
    """


def flagged(level: str) -> str:
    whole = "concat(coalesce(cnpj_basico, ''), coalesce(cnpj_ordem, ''), coalesce(cnpj_dv, ''))"
    return f"""
    SELECT *, length(whole) = 14 AND NOT {company_valid('whole')} AS invalid
    FROM (SELECT *, {whole} AS whole FROM ({repaired_estab(level)}))
    """


NAMED = {
    **{name: derived_sql(name) for name in DERIVED},
    "rep_basic": flagged("basic"),
    "rep_aggressive": flagged("aggressive"),
}
NEEDS = {"rep_basic": ("raw_estab",), "rep_aggressive": ("raw_estab",)}


def with_inputs(sql: str) -> str:
    """Puts the derived tables that the text names in front of it."""
    used = [n for n in NAMED if re.search(rf"\b{n}\b", sql)]
    wanted = [n for n in NAMED if n in used or any(n in NEEDS.get(u, ()) for u in used)]
    if not wanted:
        return sql
    ctes = ", ".join(f"{n} AS ({NAMED[n]})" for n in wanted)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"

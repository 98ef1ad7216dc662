"""Column functions and repair profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import inputs as sql
from checks.registry import Tables, check
from registrum.functions import codes, contact, labels, taxid, text
from registrum.functions.codes import array_literal
from registrum.operators.membership import without_violations
from registrum.operators.repair import OVERFLOW, conform, repair
from registrum.specs import COMPANIES, ESTABLISHMENTS, PARTNERS, REGIMES, parse_dates


def s(c) -> F.Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


@check(
    "digits_only",
    "C1 C14",
    f"""SELECT c_custkey, {sql.digits('c_name')} AS digits,
        {sql.phone_digits('c_mktsegment')} AS no_digits FROM customer""",
)
def digits_only(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        text.digits(F.col("c_name")).alias("digits"),
        text.digits_or_null(F.col("c_mktsegment")).alias("no_digits"),
    )


@check(
    "blank_to_null",
    "C2",
    f"""SELECT 'documents' AS source, doc_id AS id, md5({sql.blank_to_null('text')}) AS digest,
        length({sql.blank_to_null('text')}) AS n FROM documents
        UNION ALL SELECT 'conversations', conv_id * 1000 + turn,
        md5({sql.blank_to_null('text')}), length({sql.blank_to_null('text')}) FROM conversations
        UNION ALL SELECT 'estab', k, md5({sql.blank_to_null('nome_fantasia')}),
        length({sql.blank_to_null('nome_fantasia')}) FROM raw_estab""",
)
def blank_to_null(t: Tables) -> DataFrame:
    parts = [
        t.documents.select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text"),
        t.conversations.select(
            F.lit("conversations").alias("source"),
            (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
            "text",
        ),
        t.raw_estab.select(
            F.lit("estab").alias("source"),
            F.col("k").alias("id"),
            F.col("nome_fantasia").alias("text"),
        ),
    ]
    clean = text.blank_to_null(F.col("text"))
    return (
        parts[0].union(parts[1]).union(parts[2])
        .select("source", "id", F.md5(clean).alias("digest"), F.length(clean).alias("n"))
    )


@check(
    "digits_of_length",
    "C3",
    f"""SELECT k, {sql.of_length('cep', 8)} AS cep, {sql.of_length('cnpj_basico', 8)} AS base,
        {sql.of_length('municipio_nome', 2)} AS two FROM raw_estab""",
)
def digits_of_length(t: Tables) -> DataFrame:
    return t.raw_estab.select(
        "k",
        text.digits_of_length(F.col("cep"), 8).alias("cep"),
        text.digits_of_length(F.col("cnpj_basico"), 8).alias("base"),
        text.digits_of_length(F.col("municipio_nome"), 2).alias("two"),
    )


@check("state_code", "C4", f"SELECT k, {sql.state('uf')} AS uf FROM raw_estab")
def state_code(t: Tables) -> DataFrame:
    return t.raw_estab.select("k", text.state(F.col("uf")).alias("uf"))


TOKENS = """SELECT doc_id, token, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\n\\r]+')) AS token FROM documents)
    WHERE contains(token, '@') GROUP BY doc_id, token"""


@check(
    "emails_in_text",
    "C5 C6",
    f"""SELECT doc_id, token, n, {sql.email('token')} AS basic,
        {sql.email_strict('token')} AS strict FROM ({TOKENS})""",
)
def emails_in_text(t: Tables) -> DataFrame:
    tokens = (
        t.documents.select("doc_id", F.explode(F.split("text", "[ \\t\\n\\r]+")).alias("token"))
        .where(F.contains("token", F.lit("@")))
        .groupBy("doc_id", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return tokens.withColumns(
        {"basic": text.email(F.col("token")), "strict": text.email_strict(F.col("token"))}
    )


@check(
    "email_levels",
    "C5 C6",
    f"""SELECT k, {sql.email('correio_eletronico')} AS basic,
        {sql.email_strict('correio_eletronico')} AS strict FROM raw_estab""",
)
def email_levels(t: Tables) -> DataFrame:
    mail = F.col("correio_eletronico")
    return t.raw_estab.select(
        "k", text.email(mail).alias("basic"), text.email_strict(mail).alias("strict")
    )


SECONDARY = "cnae_fiscal_secundaria"


@check(
    "code_lists",
    "C7 C8 C9 C10 C11",
    f"""SELECT k, {sql.nullable_text(f"({sql.code7('cnae_fiscal_principal_codigo')})")} AS code,
        {sql.literal_or_null('toks')} AS parts,
        {sql.literal_or_null(f"({sql.seven_digits('toks')})")} AS codes,
        {sql.literal_or_null(f"({sql.code_set(f'({sql.seven_digits("toks")})')})")} AS distinct_codes
        FROM (SELECT *, {sql.token_list(SECONDARY)} AS toks FROM raw_estab)""",
)
def code_lists(t: Tables) -> DataFrame:
    listed = F.col(SECONDARY)
    found = codes.code_list(listed)
    return t.raw_estab.select(
        "k",
        s(codes.activity_code(F.col("cnae_fiscal_principal_codigo"))).alias("code"),
        array_literal(codes.split_list(listed)).alias("parts"),
        array_literal(found).alias("codes"),
        array_literal(codes.code_set(found)).alias("distinct_codes"),
    )


@check(
    "array_literals",
    "C9 C11",
    f"""WITH lists AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CASE WHEN l_linenumber = 7 THEN 'none'
            WHEN l_linenumber = 6 THEN concat('{{', l_partkey, ',x}}')
            ELSE concat('{{', {sql.lp('l_partkey', 7)}, ',', {sql.lp('l_suppkey', 7)}, ',',
              {sql.lp('l_partkey', 7)}, '}}') END AS listed FROM lineitem)
        SELECT l_orderkey, l_linenumber, listed,
          CASE WHEN l_linenumber < 6 THEN CASE WHEN l_partkey = l_suppkey
            THEN concat('{{', l_partkey, '}}')
            ELSE concat('{{', least(l_partkey, l_suppkey), ',', greatest(l_partkey, l_suppkey), '}}')
          END END AS codes,
          l_linenumber <> 7 AS well_formed, count(*) AS n FROM lists GROUP BY ALL""",
)
def array_literals(t: Tables) -> DataFrame:
    part, supp = F.lpad(s("l_partkey"), 7, "0"), F.lpad(s("l_suppkey"), 7, "0")
    listed = (
        F.when(F.col("l_linenumber") == 7, F.lit("none"))
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("{"), s("l_partkey"), F.lit(",x}")))
        .otherwise(
            F.concat(F.lit("{"), part, F.lit(","), supp, F.lit(","), part, F.lit("}"))
        )
    )
    out = t.lineitem.select("l_orderkey", "l_linenumber", listed.alias("listed")).select(
        "l_orderkey",
        "l_linenumber",
        "listed",
        array_literal(codes.code_set_of_literal(F.col("listed"))).alias("codes"),
        codes.is_array_literal(F.col("listed")).alias("well_formed"),
    )
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


@check(
    "compact_dates",
    "C12",
    f"""SELECT k, CAST({sql.day('data_inicio_atividade')} AS VARCHAR) AS started FROM raw_estab""",
)
def compact_dates(t: Tables) -> DataFrame:
    dated = parse_dates(t.raw_estab, ("data_inicio_atividade", "no_such_column"))
    return dated.select("k", s("data_inicio_atividade").alias("started"))


@check(
    "decimal_comma",
    "C13",
    """SELECT k, CAST(TRY_CAST(replace(replace(trim(capital_social), '.', ''), ',', '.')
        AS DECIMAL(18,2)) AS DOUBLE) AS capital FROM raw_empresas""",
)
def decimal_comma(t: Tables) -> DataFrame:
    return t.raw_empresas.select(
        "k", text.decimal_comma(F.col("capital_social")).cast("double").alias("capital")
    )


PHONES = f"""SELECT k, {sql.phone_digits('ddd_1')} AS a, {sql.phone_digits('telefone_1')} AS p
    FROM raw_estab"""


@check(
    "phone_numbers",
    "C14 C15 C16 C17",
    f"""SELECT k, CASE WHEN length(a) IN (2, 3) THEN a END AS area,
        CASE WHEN length(p) BETWEEN 8 AND 11 THEN p END AS phone,
        CASE WHEN length(a) IN (2, 3) AND length(p) BETWEEN 8 AND 11
          THEN concat('+55', a, p) END AS e164 FROM ({PHONES})""",
)
def phone_numbers(t: Tables) -> DataFrame:
    area = text.digits_or_null(F.col("ddd_1"))
    number = text.digits_or_null(F.col("telefone_1"))
    return t.raw_estab.select(
        "k",
        contact.area_code(area).alias("area"),
        contact.phone(number).alias("phone"),
        contact.e164(area, number).alias("e164"),
    )


@check(
    "person_ids",
    "C18 C22 C23 D3",
    f"""SELECT o, n, d, v AS valid, CASE WHEN length(d) = 11 AND v THEN d END AS any_id,
        CASE WHEN length(r) = 11 AND rv THEN r END AS person_id,
        CASE WHEN length(d) = 11 THEN concat('***', substr(d, 4, 6), '**') END AS masked,
        count(*) AS rows
        FROM (SELECT *, {sql.person_valid('d')} AS v, {sql.person_valid('r')} AS rv FROM
          (SELECT o, n, {sql.digits('cnpj_cpf_socio')} AS d,
            {sql.digits('representante_legal_cpf')} AS r FROM raw_socios)) GROUP BY ALL""",
)
def person_ids(t: Tables) -> DataFrame:
    out = t.raw_socios.select(
        "o",
        "n",
        text.digits(F.col("cnpj_cpf_socio")).alias("d"),
        taxid.any_tax_id(F.col("cnpj_cpf_socio")).alias("any_id"),
        taxid.person_id(F.col("representante_legal_cpf")).alias("person_id"),
        taxid.mask_person_id(F.col("cnpj_cpf_socio")).alias("masked"),
    ).withColumn("valid", taxid.person_id_valid(F.col("d")))
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("rows"))


@check(
    "company_ids",
    "C19 C20 C21",
    f"""SELECT k, whole, {sql.company_valid('whole')} AS valid,
        length(whole) = 14 AND NOT {sql.company_valid('whole')} AS invalid
        FROM (SELECT k, concat({sql.digits('cnpj_basico')}, {sql.digits('cnpj_ordem')},
          {sql.digits('cnpj_dv')}) AS whole FROM raw_estab)""",
)
def company_ids(t: Tables) -> DataFrame:
    parts = [F.col(c) for c in ESTABLISHMENTS.id_parts]
    return (
        t.raw_estab.withColumn("whole", taxid.full_id(*parts))
        .select(
            "k",
            "whole",
            taxid.company_id_valid(F.col("whole")).alias("valid"),
            taxid.invalid_company_id(*parts).alias("invalid"),
        )
    )


@check(
    "name_keys",
    "C24",
    f"""SELECT 'documents' AS source, doc_id AS id,
        md5(strip_accents(lower({sql.strip('text')}))) AS name_key FROM documents
        UNION ALL SELECT 'cities', k, strip_accents(lower({sql.strip('municipio_nome')}))
        FROM raw_estab""",
)
def name_keys(t: Tables) -> DataFrame:
    documents = t.documents.select(
        F.lit("documents").alias("source"),
        F.col("doc_id").alias("id"),
        F.md5(text.name_key(F.col("text"))).alias("name_key"),
    )
    cities = t.raw_estab.select(
        F.lit("cities").alias("source"),
        F.col("k").alias("id"),
        text.name_key(F.col("municipio_nome")).alias("name_key"),
    )
    return documents.union(cities)


ESTAB_OUT = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "pais_codigo", "data_inicio_atividade",
    "cnae_fiscal_principal_codigo", "cnae_fiscal_secundaria", "numero", "cep", "uf",
    "municipio_codigo", "ddd_1", "telefone_1", "correio_eletronico", "municipio_nome",
)


def estab_text(df: DataFrame, *first: str) -> DataFrame:
    return df.select(
        *first,
        *[array_literal(F.col(c)).alias(c) if c == SECONDARY else s(c).alias(c) for c in ESTAB_OUT],
    )


def estab_text_sql(source: str, *first: str) -> str:
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ESTAB_OUT)
    return f"SELECT {', '.join(first)}, {cols} FROM {source}"


@check(
    "repair_establishments_basic", "C25 C27", estab_text_sql("rep_basic", "k", "invalid")
)
def repair_establishments_basic(t: Tables) -> DataFrame:
    df = repair(t.raw_estab, ESTABLISHMENTS, "basic")
    return estab_text(df.withColumnRenamed("_invalid_id", "invalid"), "k", "invalid")


@check(
    "repair_establishments_aggressive",
    "C25 C27",
    estab_text_sql("rep_aggressive", "k", "invalid"),
)
def repair_establishments_aggressive(t: Tables) -> DataFrame:
    df = repair(t.raw_estab, ESTABLISHMENTS, "aggressive")
    return estab_text(df.withColumnRenamed("_invalid_id", "invalid"), "k", "invalid")


@check(
    "repair_companies",
    "C25",
    f"""SELECT k, {sql.of_length('cnpj_basico', 8)} AS cnpj_basico,
        {sql.blank_to_null('razao_social')} AS razao_social,
        CAST(TRY_CAST(replace(replace(capital_social, '.', ''), ',', '.') AS DECIMAL(18,2))
          AS DOUBLE) AS capital_social,
        {sql.blank_to_null('ente_federativo_responsavel')} AS ente_federativo_responsavel
        FROM raw_empresas""",
)
def repair_companies(t: Tables) -> DataFrame:
    return repair(t.raw_empresas, COMPANIES).select(
        "k",
        "cnpj_basico",
        "razao_social",
        F.col("capital_social").cast("double"),
        "ente_federativo_responsavel",
    )


@check(
    "repair_partners",
    "C25",
    f"""SELECT o, n, {sql.of_length('cnpj_basico', 8)} AS cnpj_basico,
        CASE WHEN length(d) = 11 AND {sql.person_valid('d')} THEN d END AS cnpj_cpf_socio,
        CASE WHEN length(r) = 11 AND {sql.person_valid('r')} THEN r END AS representante_legal_cpf,
        {sql.blank_to_null('nome_socio_ou_razao_social')} AS nome_socio_ou_razao_social,
        {sql.blank_to_null('nome_representante_legal')} AS nome_representante_legal,
        CAST({sql.day('data_entrada_sociedade')} AS VARCHAR) AS data_entrada_sociedade,
        count(*) AS rows
        FROM (SELECT *, {sql.digits('cnpj_cpf_socio')} AS d,
          {sql.digits('representante_legal_cpf')} AS r FROM raw_socios) GROUP BY ALL""",
)
def repair_partners(t: Tables) -> DataFrame:
    out = repair(t.raw_socios, PARTNERS).select(
        "o", "n", "cnpj_basico", "cnpj_cpf_socio", "representante_legal_cpf",
        "nome_socio_ou_razao_social", "nome_representante_legal",
        s("data_entrada_sociedade").alias("data_entrada_sociedade"),
    )
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("rows"))


@check(
    "repair_regimes",
    "C25",
    f"""SELECT k, {sql.of_length('cnpj_basico', 8)} AS cnpj_basico, opcao_pelo_simples,
        CAST({sql.day('data_opcao_pelo_simples')} AS VARCHAR) AS joined,
        CAST({sql.day('data_exclusao_do_simples')} AS VARCHAR) AS left_on FROM raw_simples""",
)
def repair_regimes(t: Tables) -> DataFrame:
    return repair(t.raw_simples, REGIMES).select(
        "k",
        "cnpj_basico",
        "opcao_pelo_simples",
        s("data_opcao_pelo_simples").alias("joined"),
        s("data_exclusao_do_simples").alias("left_on"),
    )


@check(
    "conform_types",
    "C26",
    """SELECT k, CAST(TRY_CAST(municipio_codigo AS SMALLINT) AS VARCHAR) AS municipio_codigo,
        CAST(TRY_CAST(situacao_cadastral AS SMALLINT) AS VARCHAR) AS situacao_cadastral,
        cnae_fiscal_secundaria,
        array_to_string(list_filter([
          CASE WHEN length(cep) > 8 THEN 'cep' END,
          CASE WHEN length(ddd_1) > 4 THEN 'ddd_1' END,
          CASE WHEN length(telefone_1) > 9 THEN 'telefone_1' END],
          lambda x: x IS NOT NULL), ',') AS misfits
        FROM (SELECT * REPLACE (concat('x', ddd_1, 'x') AS ddd_1, concat(telefone_1, cnpj_dv)
          AS telefone_1) FROM rep_basic)""",
)
def conform_types(t: Tables) -> DataFrame:
    widened = repair(t.raw_estab, ESTABLISHMENTS).withColumns(
        {
            "ddd_1": F.concat(F.lit("x"), F.coalesce("ddd_1", F.lit("")), F.lit("x")),
            "telefone_1": F.concat(
                F.coalesce("telefone_1", F.lit("")), F.coalesce("cnpj_dv", F.lit(""))
            ),
        }
    )
    typed = conform(without_violations(widened), ESTABLISHMENTS)
    padded = F.transform(SECONDARY, lambda x: F.lpad(x.cast("string"), 7, "0"))
    return typed.select(
        "k",
        s("municipio_codigo").alias("municipio_codigo"),
        s("situacao_cadastral").alias("situacao_cadastral"),
        array_literal(padded).alias(SECONDARY),
        F.array_join(OVERFLOW, ",").alias("misfits"),
    )


@check(
    "code_labels",
    "D1",
    """SELECT k, CASE CAST(situacao_cadastral AS INT) WHEN 1 THEN 'NULA' WHEN 2 THEN 'ATIVA'
          WHEN 3 THEN 'SUSPENSA' WHEN 4 THEN 'INAPTA' WHEN 8 THEN 'BAIXADA' END AS status,
        CASE identificador_matriz_filial WHEN '1' THEN 'MATRIZ' ELSE 'FILIAL' END AS office,
        CAST(NULL AS VARCHAR) AS unknown FROM raw_estab""",
)
def code_labels(t: Tables) -> DataFrame:
    return t.raw_estab.select(
        "k",
        labels.label(F.col("situacao_cadastral").cast("int"), labels.STATUS).alias("status"),
        labels.label(
            F.col("identificador_matriz_filial").cast("int"), labels.OFFICE_KIND
        ).alias("office"),
        labels.label(F.lit(99), labels.COMPANY_SIZE).alias("unknown"),
    )


@check(
    "regime_labels",
    "D1",
    """SELECT k, CASE opcao_pelo_simples WHEN 'S' THEN 'SIM' WHEN 'N' THEN 'NÃO'
        ELSE 'OUTROS' END AS regime FROM raw_simples""",
)
def regime_labels(t: Tables) -> DataFrame:
    flag = labels.regime_label(F.col("opcao_pelo_simples"))
    return t.raw_simples.select("k", flag.alias("regime"))


@check(
    "age_bands",
    "D2",
    """SELECT c_custkey, CASE WHEN age < 0 THEN 0 WHEN age <= 12 THEN 1 WHEN age <= 20 THEN 2
        WHEN age > 80 THEN 9 ELSE CAST(floor((age - 1) / 10) AS INT) + 1 END AS band
        FROM (SELECT c_custkey, CAST(c_custkey % 111 - 1 AS INT) AS age FROM customer)""",
)
def age_bands(t: Tables) -> DataFrame:
    age = (F.col("c_custkey") % 111 - 1).cast("int")
    return t.customer.select("c_custkey", labels.age_band(age).alias("band"))

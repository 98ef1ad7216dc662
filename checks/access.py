"""Lookups, filters, search and the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import inputs as sql
from checks.cleaning import s
from checks.registry import Tables, check
from registrum.operators import search
from registrum.operators.joins import balanced_join
from registrum.operators.repair import repair
from registrum.sinks.tables import clustered
from registrum.specs import COMPANIES, ESTABLISHMENTS, PARTNERS


def companies(t: Tables) -> DataFrame:
    return t.raw_empresas.select("cnpj_basico", F.trim("razao_social").alias("razao_social"))


@check(
    "establishments_by_state_and_validity",
    "J6 C1 C3 C4 C12 C18 C19 C20 C21",
    """SELECT coalesce(uf, '-') AS uf, invalid, count(*) AS rows,
         count(DISTINCT e.cnpj_basico) AS companies,
         count(*) FILTER (data_inicio_atividade IS NULL) AS undated
       FROM rep_basic r JOIN raw_empresas e ON e.cnpj_basico = r.cnpj_basico
       GROUP BY 1, 2""",
)
def establishments_by_state_and_validity(t: Tables) -> DataFrame:
    joined = search.with_company(repair(t.raw_estab, ESTABLISHMENTS), companies(t))
    return joined.groupBy(
        F.coalesce("uf", F.lit("-")).alias("uf"), F.col("_invalid_id").alias("invalid")
    ).agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("cnpj_basico").alias("companies"),
        F.count_if(F.col("data_inicio_atividade").isNull()).alias("undated"),
    )


@check(
    "star_join",
    "J6",
    """SELECT r.k, trim(e.razao_social) AS razao_social, n.n_name AS country, p.p_name AS activity
       FROM rep_basic r JOIN raw_empresas e ON e.cnpj_basico = r.cnpj_basico
       LEFT JOIN nation n ON n.n_nationkey = TRY_CAST(r.pais_codigo AS INT)
       LEFT JOIN part p ON p.p_partkey = r.cnae_fiscal_principal_codigo""",
)
def star_join(t: Tables) -> DataFrame:
    estab = repair(t.raw_estab, ESTABLISHMENTS).withColumn(
        "pais_codigo", F.col("pais_codigo").try_cast("int")
    )
    joined = search.with_company(estab, companies(t))
    labelled = search.with_labels(
        joined,
        {
            "pais_codigo": t.domains["paises"],
            "cnae_fiscal_principal_codigo": t.domains["cnaes"],
        },
    )
    return labelled.select(
        "k",
        "razao_social",
        F.col("pais_codigo_nome").alias("country"),
        F.col("cnae_fiscal_principal_codigo_nome").alias("activity"),
    )


@check(
    "balanced_star_join",
    "J6",
    """SELECT c_mktsegment, count(*) AS rows, CAST(sum(o_totalprice * 100) AS BIGINT) AS cents
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def balanced_star_join(t: Tables) -> DataFrame:
    # A low share makes most customers "hot", so that the pieces are really used.
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    joined = balanced_join(
        orders, t.customer.select("c_custkey", "c_mktsegment"), ["c_custkey"], "inner", 0.0005
    )
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.sum(F.round(F.col("o_totalprice") * 100).cast("long"))).alias("cents"),
    )


@check(
    "lookup_by_id",
    "Q1",
    """SELECT 'full' AS kind, k, cnpj_basico, cnpj_ordem, cnpj_dv FROM rep_basic
         WHERE cnpj_basico = '00000007' AND cnpj_ordem = '0012' AND cnpj_dv IS NOT NULL
       UNION ALL SELECT 'base', k, cnpj_basico, cnpj_ordem, cnpj_dv FROM rep_basic
         WHERE cnpj_basico = '00000007'""",
)
def lookup_by_id(t: Tables) -> DataFrame:
    estab = repair(t.raw_estab, ESTABLISHMENTS)
    keys = ["k", "cnpj_basico", "cnpj_ordem", "cnpj_dv"]
    full = search.where_equal(estab, cnpj_basico="00000007", cnpj_ordem="0012").dropna(
        subset=["cnpj_dv"]
    )
    base = search.where_equal(estab, cnpj_basico="00000007")
    return full.select(F.lit("full").alias("kind"), *keys).union(
        base.select(F.lit("base").alias("kind"), *keys)
    )


@check(
    "partners_of_company",
    "Q1",
    """SELECT o, n, nome_socio_ou_razao_social AS name, count(*) AS rows FROM raw_socios
       WHERE cnpj_basico = '00000011' AND trim(nome_socio_ou_razao_social) <> ''
       GROUP BY ALL""",
)
def partners_of_company(t: Tables) -> DataFrame:
    found = search.where_equal(repair(t.raw_socios, PARTNERS), cnpj_basico="00000011")
    out = found.select("o", "n", F.col("nome_socio_ou_razao_social").alias("name")).dropna()
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("rows"))


@check(
    "equality_filters",
    "Q2",
    """SELECT 'state' AS kind, count(*) AS rows FROM rep_basic WHERE uf = 'SP'
       UNION ALL SELECT 'city', count(*) FROM rep_basic WHERE municipio_codigo = '9'
       UNION ALL SELECT 'activity', count(*) FROM rep_basic
         WHERE cnae_fiscal_principal_codigo = 17
       UNION ALL SELECT 'nature', count(*) FROM raw_empresas WHERE natureza_juridica_codigo = '3'
       UNION ALL SELECT 'qualification', count(*) FROM raw_empresas
         WHERE qualificacao_responsavel = '2'
       UNION ALL SELECT 'partner', count(*) FROM raw_socios WHERE qualificacao_socio_codigo = '1'""",
)
def equality_filters(t: Tables) -> DataFrame:
    estab = t.loaded["estabelecimentos"]
    firms = t.loaded["empresas"]
    socios = t.loaded["socios"]
    frames = {
        "state": search.where_equal(estab, uf="SP"),
        "city": search.where_equal(estab, municipio_codigo=9),
        "activity": search.where_equal(estab, cnae_fiscal_principal_codigo=17),
        "nature": search.where_equal(firms, natureza_juridica_codigo=3),
        "qualification": search.where_equal(firms, qualificacao_responsavel=2),
        "partner": search.where_equal(socios, qualificacao_socio_codigo=1),
    }
    out = None
    for kind, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(kind).alias("kind"), "rows")
        out = one if out is None else out.union(one)
    return out


@check(
    "name_contains",
    "Q3",
    """SELECT 'part' AS source, p_partkey AS id FROM part WHERE p_name ILIKE '%RED%'
       UNION ALL SELECT 'customer', c_custkey FROM customer WHERE c_name ILIKE '%r#0000001%'
       UNION ALL SELECT 'percent', p_partkey FROM part WHERE p_name ILIKE '%100\\%%' ESCAPE '\\'""",
)
def name_contains(t: Tables) -> DataFrame:
    part = search.name_contains(t.part, "p_name", "RED")
    customer = search.name_contains(t.customer, "c_name", "r#0000001")
    percent = search.name_contains(t.part, "p_name", "100%")
    return (
        part.select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"))
        .union(customer.select(F.lit("customer"), "c_custkey"))
        .union(percent.select(F.lit("percent"), "p_partkey"))
    )


TERMS = ("red widget", "smal ring", "Customer#000000012")


def _trigrams_sql(x: str) -> str:
    words = f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"
    grams = (
        f"flatten(list_transform({words}, lambda w: list_transform(range(1, length(w) + 2), "
        "lambda i: substr(concat('  ', w, ' '), i, 3))))"
    )
    return f"list_distinct({grams})"


@check(
    "similar_names",
    "Q3",
    f"""SELECT source, id, term, round(shared / (a + b - shared), 9) AS similarity FROM (
        SELECT source, id, term, len(list_intersect(ta, tb)) AS shared, len(ta) AS a,
          len(tb) AS b FROM (
          SELECT source, id, {_trigrams_sql('name')} AS ta FROM (
            SELECT 'part' AS source, p_partkey AS id, p_name AS name FROM part
            UNION ALL SELECT 'customer', c_custkey, c_name FROM customer)),
          (SELECT term, {_trigrams_sql('term')} AS tb FROM (SELECT unnest(
            {list(TERMS)}) AS term)))
        WHERE shared / (a + b - shared) >= 0.3""",
)
def similar_names(t: Tables) -> DataFrame:
    names = t.part.select(
        F.lit("part").alias("source"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")
    ).union(t.customer.select(F.lit("customer"), "c_custkey", "c_name"))
    found = search.similar_names(names, "name", TERMS)
    return found.select("source", "id", "term", F.round("similarity", 9).alias("similarity"))


@check(
    "code_containment",
    "Q4",
    f"""WITH c AS (SELECT k, toks FROM (SELECT k, {sql.token_list('cnae_fiscal_secundaria')} AS toks
          FROM raw_estab))
        SELECT 'all' AS kind, k FROM c
          WHERE list_contains(toks, '1000005') AND list_contains(toks, '2000010')
        UNION ALL SELECT 'any', k FROM c
          WHERE list_contains(toks, '1000005') OR list_contains(toks, '2000010')""",
)
def code_containment(t: Tables) -> DataFrame:
    estab = repair(t.raw_estab, ESTABLISHMENTS, "aggressive")
    wanted = [1000005, 2000010]
    every = search.has_all_codes(estab, "cnae_fiscal_secundaria", wanted)
    some = search.has_any_code(estab, "cnae_fiscal_secundaria", wanted)
    return every.select(F.lit("all").alias("kind"), "k").union(
        some.select(F.lit("any").alias("kind"), "k")
    )


@check(
    "filtered_subsets",
    "Q5",
    """SELECT 'active' AS kind, cnpj_basico AS id, count(*) AS rows FROM rep_basic
         WHERE situacao_cadastral = '2' AND cnpj_basico IS NOT NULL GROUP BY cnpj_basico
       UNION ALL SELECT 'mei', cnpj_basico, count(*) FROM raw_simples
         WHERE opcao_pelo_mei = 'S' AND length(cnpj_basico) = 8 GROUP BY cnpj_basico""",
)
def filtered_subsets(t: Tables) -> DataFrame:
    active = search.active_establishments(t.loaded["estabelecimentos"])
    mei = search.micro_entrepreneurs(t.loaded["simples"])
    both = active.select(F.lit("active").alias("kind"), "cnpj_basico").union(
        mei.select(F.lit("mei"), "cnpj_basico")
    )
    return (
        both.dropna()
        .groupBy("kind", F.col("cnpj_basico").alias("id"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@check(
    "newest_months",
    "W2",
    """SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders
       ORDER BY month DESC LIMIT 3""",
)
def newest_months(t: Tables) -> DataFrame:
    months = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    return search.newest(months, "month", 3)


@check(
    "clustered_by_state",
    "W3",
    "SELECT k, uf FROM rep_basic",
)
def clustered_by_state(t: Tables) -> DataFrame:
    estab = repair(t.raw_estab, ESTABLISHMENTS).select("k", "uf")
    return clustered(estab, ["uf"], ["k"])


@check(
    "company_sizes",
    "J6 D1",
    """SELECT porte_empresa AS size, count(*) AS rows,
         CAST(sum(TRY_CAST(replace(replace(capital_social, '.', ''), ',', '.')
           AS DECIMAL(18,2))) AS DOUBLE) AS capital
       FROM raw_empresas GROUP BY porte_empresa""",
)
def company_sizes(t: Tables) -> DataFrame:
    firms = repair(t.raw_empresas, COMPANIES)
    return firms.groupBy(s("porte_empresa").alias("size")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("capital_social").cast("double").alias("capital")
    )

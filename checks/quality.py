"""Telemetry, gates, quarantine, membership, enrichment, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import inputs as sql
from checks.cleaning import s
from checks.registry import Tables, check
from registrum.operators.chunks import CHUNK, chunk_by_position, chunk_of_key
from registrum.operators.enrich import (
    enrich_by_city_name, enrich_by_postal_code, enrichment_counts, enrichment_examples,
)
from registrum.operators.membership import (
    Rule, codes_in_use, domain_keys, foreign_codes, members, relax_members, require_loaded, rules_for,
    without_violations,
)
from registrum.operators.profile import (
    column_stats, e164_examples, invalid_id_examples, row_counts, sample_diffs, selectivity,
    totals,
)
from registrum.operators.quality import (
    accepted_rows, gate_records, row_records, skip_invalid_ids, telemetry, with_gate,
)
from registrum.operators.repair import repair
from registrum.options import Options
from registrum.session import write_and_reread
from registrum.specs import ESTABLISHMENTS

AGGRESSIVE = Options(level="aggressive", strict_membership=False)
TRACKED = ESTABLISHMENTS.tracked
CLEANED = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome_fantasia", "cnae_fiscal_principal_codigo",
    "cnae_fiscal_secundaria", "numero", "cep", "uf", "ddd_1", "telefone_1",
    "correio_eletronico", "municipio_nome",
)


def repaired(t: Tables, level: str = "aggressive") -> DataFrame:
    return repair(t.raw_estab.withColumnRenamed("k", "_k"), ESTABLISHMENTS, level)


def records(t: Tables, opts: Options = AGGRESSIVE) -> DataFrame:
    """Written telemetry, as the table build uses it."""
    counted = telemetry(repaired(t, opts.level), ESTABLISHMENTS, opts.level)
    return write_and_reread(with_gate(counted, opts), "checks-telemetry")


def changed_sql(c: str) -> str:
    before = f"b_{c}"
    if c == "cnae_fiscal_principal_codigo":
        before = f"coalesce(CAST(TRY_CAST({before} AS INT) AS VARCHAR), {before})"
    return f"({before} IS DISTINCT FROM CAST({c} AS VARCHAR))"


NULL_ROWS = " UNION ALL ".join(
    f"SELECT _chunk AS chunk, '{c}' AS col, count(*) FILTER ({c} IS NULL) AS nulls, "
    f"count(*) FILTER ({c} IS NULL) - count(*) FILTER (b_{c} IS NULL) AS delta "
    "FROM rep_aggressive GROUP BY _chunk"
    for c in CLEANED
)
CHANGED_ROWS = " UNION ALL ".join(
    f"SELECT _chunk AS chunk, '{c}' AS col, count(*) FILTER ({changed_sql(c)}) AS changed "
    "FROM rep_aggressive GROUP BY _chunk"
    for c in TRACKED
)
ROWS = "SELECT _chunk AS chunk, count(*) AS rows FROM rep_aggressive GROUP BY _chunk"
GATED = f"""SELECT DISTINCT chunk FROM (
    SELECT n.chunk FROM ({NULL_ROWS}) n JOIN ({ROWS}) r USING (chunk)
    WHERE rows >= 20 AND abs(delta) / rows > 0.3
    UNION ALL SELECT c.chunk FROM ({CHANGED_ROWS}) c JOIN ({ROWS}) r USING (chunk)
    WHERE rows >= 20 AND changed / rows > 0.3)"""


def long_map(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.select("chunk", F.explode(column).alias("col", value))


@check("null_deltas", "A1", NULL_ROWS)
def null_deltas(t: Tables) -> DataFrame:
    entries = F.map_entries("after_nulls")
    after = telemetry(repaired(t), ESTABLISHMENTS, "aggressive").select(
        "chunk", F.explode(entries).alias("e"), "null_deltas"
    )
    return after.where(F.col("e.key").isin(*CLEANED)).select(
        "chunk",
        F.col("e.key").alias("col"),
        F.col("e.value").alias("nulls"),
        F.col("null_deltas")[F.col("e.key")].alias("delta"),
    )


@check("changed_values", "A2", f"SELECT * FROM ({CHANGED_ROWS}) WHERE changed > 0")
def changed_values(t: Tables) -> DataFrame:
    tel = telemetry(repaired(t), ESTABLISHMENTS, "aggressive")
    return long_map(tel, "changed_counts", "changed")


DIFFS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, k, b_{c} AS before, CAST({c} AS VARCHAR) AS after "
    f"FROM rep_aggressive WHERE {changed_sql(c)}"
    for c in TRACKED
)


@check(
    "sample_diffs",
    "A3",
    f"""SELECT col, k, before, after FROM (SELECT *, row_number() OVER (PARTITION BY col
        ORDER BY k) AS r FROM ({DIFFS})) WHERE r <= 10""",
)
def sampled_diffs(t: Tables) -> DataFrame:
    found = sample_diffs(repaired(t), TRACKED, ["_k"])
    return found.select(F.col("column").alias("col"), F.col("_k").alias("k"), "before", "after")


STATS = {
    "cnpj_basico": "cnpj_basico",
    "data_inicio_atividade": "data_inicio_atividade",
    "cnae_fiscal_principal_codigo": "cnae_fiscal_principal_codigo",
    "uf": "uf",
    "correio_eletronico": "correio_eletronico",
}


@check(
    "column_stats",
    "A4",
    " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(*) FILTER ({c} IS NULL) AS nulls, "
        f"CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM rep_basic"
        for c in STATS
    ),
)
def stats_of_columns(t: Tables) -> DataFrame:
    return column_stats(repaired(t, "basic"), list(STATS)).select(
        F.col("column").alias("col"),
        "nulls",
        F.col("min").alias("least"),
        F.col("max").alias("greatest"),
    )


@check(
    "chunk_telemetry",
    "A5 F6",
    f"""SELECT chunk, rows, invalid_ids, chunk IN ({GATED}) AS gated FROM (
        SELECT _chunk AS chunk, count(*) AS rows, count(*) FILTER (invalid) AS invalid_ids
        FROM rep_aggressive GROUP BY _chunk)""",
)
def chunk_telemetry(t: Tables) -> DataFrame:
    return records(t).select("chunk", "rows", "invalid_ids", "gated")


@check(
    "gate_triggers",
    "F6",
    f"""SELECT chunk, col, max(changed) AS changed, max(delta) AS delta FROM (
        SELECT n.chunk, col, CAST(NULL AS BIGINT) AS changed, delta
        FROM ({NULL_ROWS}) n JOIN ({ROWS}) r USING (chunk)
        WHERE rows >= 20 AND abs(delta) / rows > 0.3
        UNION ALL SELECT c.chunk, col, changed, NULL
        FROM ({CHANGED_ROWS}) c JOIN ({ROWS}) r USING (chunk)
        WHERE rows >= 20 AND changed / rows > 0.3) GROUP BY chunk, col""",
)
def gate_triggers(t: Tables) -> DataFrame:
    found = records(t).where("gated").select("chunk", F.explode("trigger_columns").alias("col", "t"))
    return found.select(
        "chunk", "col", F.col("t.count").alias("changed"),
        F.coalesce("t.delta", "t.null_delta").alias("delta"),
    )


@check(
    "gated_rows_dropped",
    "F6 U1",
    f"""SELECT _chunk AS chunk, count(*) AS rows, count(correio_eletronico) AS mails
        FROM rep_aggressive WHERE _chunk NOT IN ({GATED}) GROUP BY _chunk""",
)
def gated_rows_dropped(t: Tables) -> DataFrame:
    rows = accepted_rows(repaired(t), records(t))
    return rows.groupBy(F.col(CHUNK).alias("chunk")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("correio_eletronico").alias("mails")
    )


ACCEPTED = f"(SELECT * FROM rep_aggressive WHERE _chunk NOT IN ({GATED}))"


@check(
    "totals_of_accepted",
    "A6",
    f"""SELECT 'rows' AS kind, '' AS col, CAST(count(*) AS BIGINT) AS n FROM {ACCEPTED}
        UNION ALL SELECT 'chunks', '', count(DISTINCT _chunk) FROM {ACCEPTED}
        UNION ALL SELECT 'gated', '', count(*) FROM ({GATED})
        UNION ALL SELECT 'changed', col, CAST(sum(changed) AS BIGINT) FROM ({CHANGED_ROWS})
          WHERE chunk NOT IN ({GATED}) GROUP BY col HAVING sum(changed) > 0
        UNION ALL SELECT 'null_delta', col, CAST(sum(delta) AS BIGINT) FROM ({NULL_ROWS})
          WHERE chunk NOT IN ({GATED}) GROUP BY col""",
)
def totals_of_accepted(t: Tables) -> DataFrame:
    row = totals(records(t), AGGRESSIVE)

    def one(kind: str, column: str):
        return F.array(
            F.struct(F.lit(kind).alias("kind"), F.lit("").alias("col"), F.col(column).alias("n"))
        )

    def many(kind: str, column: str):
        kept = F.filter(
            F.map_entries(column), lambda e: F.lit(kind == "changed") | e["key"].isin(*CLEANED)
        )
        return F.transform(
            kept,
            lambda e: F.struct(
                F.lit(kind).alias("kind"), e["key"].alias("col"), e["value"].alias("n")
            ),
        )

    return row.select(
        F.inline(
            F.concat(
                one("rows", "rows_total"),
                one("chunks", "chunks_processed"),
                one("gated", "quality_gate_chunks"),
                many("changed", "changed_totals"),
                many("null_delta", "null_delta_totals"),
            )
        )
    )


PAIS_BAD = "(TRY_CAST(pais_codigo AS INT) NOT IN (SELECT n_nationkey FROM nation))"
MUN_BAD = (
    "(municipio_codigo IS NOT NULL AND TRY_CAST(municipio_codigo AS BIGINT) NOT IN "
    "(SELECT s_suppkey FROM supplier))"
)
CNAE_BAD = (
    "(cnae_fiscal_principal_codigo IS NOT NULL AND cnae_fiscal_principal_codigo NOT IN "
    "(SELECT p_partkey FROM part))"
)


@check(
    "critical_fields",
    "F1",
    """SELECT _chunk AS chunk, k, cnpj_ordem, cnpj_dv FROM rep_basic
       WHERE cnpj_basico IS NULL OR cnpj_ordem IS NULL OR cnpj_dv IS NULL""",
)
def critical_fields(t: Tables) -> DataFrame:
    df = repair(t.raw_estab, ESTABLISHMENTS)
    found = row_records(without_violations(df), ESTABLISHMENTS)
    return found.where(F.col("reason") == "critical_fields_null").select(
        "chunk",
        F.get_json_object("row", "$.k").cast("long").alias("k"),
        F.get_json_object("row", "$.cnpj_ordem").alias("cnpj_ordem"),
        F.get_json_object("row", "$.cnpj_dv").alias("cnpj_dv"),
    )


@check(
    "invalid_ids_quarantined",
    "F2 C21",
    "SELECT _chunk AS chunk, k, whole FROM rep_basic WHERE invalid",
)
def invalid_ids_quarantined(t: Tables) -> DataFrame:
    df = repair(t.raw_estab, ESTABLISHMENTS)
    found = row_records(without_violations(df), ESTABLISHMENTS)
    part = [F.get_json_object("row", f"$.{c}") for c in ESTABLISHMENTS.id_parts]
    return found.where(F.col("reason") == "invalid_cnpj").select(
        "chunk",
        F.get_json_object("row", "$.k").cast("long").alias("k"),
        F.concat(*part).alias("whole"),
    )


@check(
    "invalid_ids_skipped",
    "F3",
    """SELECT count(*) FILTER (NOT invalid) AS kept, count(*) FILTER (invalid) AS skipped
       FROM rep_basic""",
)
def invalid_ids_skipped(t: Tables) -> DataFrame:
    df = repaired(t, "basic")
    kept = skip_invalid_ids(df).select(F.count(F.lit(1))).scalar()
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        kept.alias("kept"), (F.col("n") - kept).alias("skipped")
    )


@check(
    "membership_relaxed",
    "F4 F7",
    f"""SELECT k, CASE WHEN NOT {PAIS_BAD} THEN pais_codigo END AS pais_codigo,
        CASE WHEN NOT {MUN_BAD} THEN municipio_codigo END AS municipio_codigo,
        CAST(CASE WHEN NOT {CNAE_BAD} THEN cnae_fiscal_principal_codigo END AS VARCHAR) AS cnae,
        array_to_string(list_filter([CASE WHEN {PAIS_BAD} THEN 'pais_codigo' END,
          CASE WHEN {MUN_BAD} THEN 'municipio_codigo' END,
          CASE WHEN {CNAE_BAD} THEN 'cnae_fiscal_principal_codigo' END],
          lambda x: x IS NOT NULL), ',') AS violated FROM rep_basic""",
)
def membership_relaxed(t: Tables) -> DataFrame:
    df = repair(t.raw_estab, ESTABLISHMENTS)
    checked = relax_members(df, rules_for(ESTABLISHMENTS, t.domains))
    return checked.select(
        "k",
        "pais_codigo",
        "municipio_codigo",
        s("cnae_fiscal_principal_codigo").alias("cnae"),
        F.array_join("_violated", ",").alias("violated"),
    )


@check(
    "membership_counts",
    "F4",
    f"""SELECT 'pais_codigo' AS col, pais_codigo AS code, count(*) AS rows FROM rep_basic
          WHERE {PAIS_BAD} GROUP BY pais_codigo
        UNION ALL SELECT 'municipio_codigo', municipio_codigo, count(*) FROM rep_basic
          WHERE {MUN_BAD} GROUP BY municipio_codigo
        UNION ALL SELECT 'situacao_cadastral', CAST(situacao_cadastral AS VARCHAR), count(*) FROM rep_basic
          WHERE situacao_cadastral NOT IN ('1', '2', '3', '4') GROUP BY situacao_cadastral""",
)
def membership_counts(t: Tables) -> DataFrame:
    df = repair(t.raw_estab, ESTABLISHMENTS)
    rules = [
        Rule("pais_codigo", t.domains["paises"]),
        Rule("municipio_codigo", t.domains["municipios"]),
        Rule("situacao_cadastral", allowed=("1", "2", "3", "4")),
    ]
    used = codes_in_use(df, [rule.column for rule in rules])
    return foreign_codes(used, rules).withColumnRenamed("column", "col")


@check(
    "member_rows",
    "J7",
    """SELECT l_suppkey, count(*) AS rows FROM lineitem
       WHERE l_suppkey IN (SELECT o_custkey FROM orders) GROUP BY l_suppkey""",
)
def member_rows(t: Tables) -> DataFrame:
    rows = members(t.lineitem.select("l_suppkey"), "l_suppkey", t.orders, "o_custkey")
    return rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("rows"))


@check(
    "domains_loaded",
    "F5 A13",
    """SELECT 'paises' AS tbl, count(*) AS rows, true AS loaded FROM nation
       UNION ALL SELECT 'municipios', count(*), true FROM supplier
       UNION ALL SELECT 'cnaes', count(*), true FROM part""",
)
def domains_loaded(t: Tables) -> DataFrame:
    wanted = {name: t.domains[name] for name in ESTABLISHMENTS.parents()}
    empty = require_loaded(wanted)
    counted = row_counts(wanted)
    return counted.select(
        F.col("table").alias("tbl"), "rows", (~F.col("table").isin(*empty, "")).alias("loaded")
    )


@check(
    "quarantine_records",
    "F7 F8",
    f"""SELECT tbl, config, chunk, reason, fields, count(*) AS n FROM (
        SELECT 'estabelecimentos' AS tbl, 'estabelecimentos' AS config, _chunk AS chunk,
          unnest([
            CASE WHEN cnpj_basico IS NULL OR cnpj_ordem IS NULL OR cnpj_dv IS NULL
              THEN {{'reason': 'critical_fields_null',
                'fields': 'cnpj_basico,cnpj_ordem,cnpj_dv'}} END,
            CASE WHEN invalid THEN {{'reason': 'invalid_cnpj',
                'fields': 'cnpj_basico,cnpj_ordem,cnpj_dv'}} END,
            CASE WHEN {PAIS_BAD} THEN {{'reason': 'fk_violation', 'fields': 'pais_codigo'}} END,
            CASE WHEN {MUN_BAD} THEN {{'reason': 'fk_violation',
                'fields': 'municipio_codigo'}} END,
            CASE WHEN {CNAE_BAD} THEN {{'reason': 'fk_violation',
                'fields': 'cnae_fiscal_principal_codigo'}} END], recursive := true)
        FROM {ACCEPTED}) WHERE reason IS NOT NULL GROUP BY ALL
        UNION ALL SELECT 'estabelecimentos', 'estabelecimentos', chunk, 'quality_gate',
          string_agg(DISTINCT col, ',' ORDER BY col), 1 FROM (
            SELECT n.chunk, col FROM ({NULL_ROWS}) n JOIN ({ROWS}) r USING (chunk)
            WHERE rows >= 20 AND abs(delta) / rows > 0.3
            UNION ALL SELECT c.chunk, col FROM ({CHANGED_ROWS}) c JOIN ({ROWS}) r USING (chunk)
            WHERE rows >= 20 AND changed / rows > 0.3) GROUP BY chunk""",
)
def quarantine_records(t: Tables) -> DataFrame:
    gated = records(t)
    checked = relax_members(
        accepted_rows(repaired(t), gated), rules_for(ESTABLISHMENTS, t.domains)
    )
    found = row_records(checked, ESTABLISHMENTS).unionByName(gate_records(gated))
    return (
        found.groupBy(
            F.col("table").alias("tbl"), "config", "chunk", "reason",
            F.array_join(
                F.when(F.col("reason") == "quality_gate", F.sort_array("fields")).otherwise(
                    F.col("fields")
                ),
                ",",
            ).alias("fields"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


@check(
    "domain_keys",
    "A8",
    "SELECT DISTINCT CAST(o_custkey AS BIGINT) AS codigo FROM orders",
)
def distinct_keys(t: Tables) -> DataFrame:
    return domain_keys(t.orders.select(F.col("o_custkey").alias("codigo")), "codigo")


@check(
    "invalid_id_examples",
    "A9 W2",
    """SELECT k, whole AS example, (SELECT count(*) FROM rep_basic WHERE invalid) AS total
       FROM rep_basic WHERE invalid ORDER BY k LIMIT 10""",
)
def first_invalid_ids(t: Tables) -> DataFrame:
    df = repaired(t, "basic")
    total = df.select(F.count_if("_invalid_id")).scalar()
    return invalid_id_examples(df, ESTABLISHMENTS.id_parts, ["_k"]).select(
        F.col("_k").alias("k"), "example", total.alias("total")
    )


@check(
    "e164_examples",
    "A15",
    f"""SELECT k, 'telefone_1' AS col, concat('+55', ddd_1, telefone_1) AS e164
        FROM rep_aggressive WHERE length(ddd_1) IN (2, 3) AND length(telefone_1) BETWEEN 8 AND 11
        ORDER BY k LIMIT 10""",
)
def first_e164(t: Tables) -> DataFrame:
    found = e164_examples(repaired(t), "ddd_1", "telefone_1", ["_k"])
    return found.select(F.col("_k").alias("k"), F.col("column").alias("col"), "e164")


# Maps derived from suppliers, with repeated keys on purpose.
EXACT_MAP = f"""SELECT {sql.lp('s_suppkey * 7919 % 100000000', 8)} AS cep,
    CASE WHEN s_nationkey % 2 = 0 THEN 'SP' ELSE 'RJ' END AS uf,
    {sql.text('s_suppkey')} AS municipio_codigo FROM supplier
    UNION ALL SELECT {sql.lp('s_suppkey * 7919 % 100000000', 8)}, 'MG',
    {sql.text('s_suppkey + 1000')} FROM supplier"""
PREFIX_MAP = f"""SELECT substr({sql.lp('s_suppkey * 7919 % 100000000', 8)}, 1, 5) AS cep_prefix,
    CASE WHEN s_nationkey % 2 = 0 THEN 'SP' ELSE 'RJ' END AS uf,
    {sql.text('s_suppkey')} AS municipio_codigo FROM supplier"""
NAME_MAP = f"""SELECT concat('MUNICÍPIO ', {sql.text('s_suppkey')}) AS municipio_nome,
    {sql.text('s_suppkey')} AS municipio_codigo FROM supplier"""
STATE_NAME_MAP = f"""SELECT concat('MUNICÍPIO ', {sql.text('s_suppkey')}) AS municipio_nome,
    CASE WHEN s_nationkey % 2 = 0 THEN 'sp' ELSE 'RJ' END AS uf,
    {sql.text('s_suppkey')} AS municipio_codigo FROM supplier
    UNION ALL SELECT concat('municipio ', {sql.text('s_suppkey')}), 'RJ',
    {sql.text('s_suppkey + 500')} FROM supplier"""


def mapped(t: Tables, query: str) -> DataFrame:
    """A map from its SQL, which both engines read."""
    return t.spark.sql(query.replace("FROM supplier", "FROM {supplier}"), supplier=t.supplier)


def postal_sql(map_sql: str, key: str, tag: str, width: int, only_if_null: bool) -> str:
    correct = "uf IS NULL" if only_if_null else "(uf IS NULL OR uf <> m_uf)"
    return f"""WITH m AS (SELECT {key} AS key, min(CAST(municipio_codigo AS INT)) AS m_city,
          arg_min(uf, CAST(municipio_codigo AS INT)) AS m_uf FROM ({map_sql}) GROUP BY {key})
        SELECT k, CASE WHEN municipio_codigo IS NULL THEN CAST(m_city AS VARCHAR)
            ELSE municipio_codigo END AS city,
          CASE WHEN municipio_codigo IS NULL AND m_city IS NOT NULL THEN '{tag}' END AS city_source,
          CASE WHEN m_uf IS NOT NULL AND {correct} THEN m_uf ELSE uf END AS state,
          CASE WHEN m_uf IS NOT NULL AND {correct} THEN '{tag}' END AS state_source
        FROM rep_aggressive LEFT JOIN m ON substr(cep, 1, {width}) = m.key"""


def enriched(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("_k").alias("k"),
        s("municipio_codigo").alias("city"),
        F.col("municipio_source").alias("city_source"),
        F.col("uf").alias("state"),
        F.col("uf_source").alias("state_source"),
    )


@check("enrich_exact_postal", "J1 J3", postal_sql(EXACT_MAP, "cep", "cep_map_exact", 8, True))
def enrich_exact_postal(t: Tables) -> DataFrame:
    return enriched(enrich_by_postal_code(repaired(t), mapped(t, EXACT_MAP)))


@check(
    "enrich_postal_prefix",
    "J2 J3",
    postal_sql(PREFIX_MAP, "cep_prefix", "cep_map_prefix", 5, False),
)
def enrich_postal_prefix(t: Tables) -> DataFrame:
    return enriched(
        enrich_by_postal_code(repaired(t), mapped(t, PREFIX_MAP), only_if_null=False)
    )


def by_name_sql(map_sql: str, with_state: bool) -> str:
    def key(x: str) -> str:
        return f"strip_accents(lower({sql.strip(x)}))"

    state_key = f", upper({sql.strip('uf')}) AS s" if with_state else ""
    match = f"{key('municipio_nome')} = m.key" + (" AND rep_basic.uf = m.s" if with_state else "")
    return f"""WITH m AS (SELECT key{', s' if with_state else ''}, min(code) AS m_city FROM (
          SELECT {key('municipio_nome')} AS key{state_key}, CAST(municipio_codigo AS INT) AS code
          FROM ({map_sql})) GROUP BY ALL)
        SELECT k, CASE WHEN municipio_codigo IS NULL THEN CAST(m_city AS VARCHAR)
            ELSE municipio_codigo END AS city,
          CASE WHEN municipio_codigo IS NULL AND m_city IS NOT NULL THEN 'mun_name_map' END
            AS city_source
        FROM rep_basic LEFT JOIN m ON {match}"""


@check("enrich_city_name", "J4 C24", by_name_sql(NAME_MAP, False))
def enrich_city_name(t: Tables) -> DataFrame:
    df = enrich_by_city_name(repaired(t, "basic"), mapped(t, NAME_MAP))
    return enriched(df).select("k", "city", "city_source")


@check("enrich_city_and_state", "J4", by_name_sql(STATE_NAME_MAP, True))
def enrich_city_and_state(t: Tables) -> DataFrame:
    df = enrich_by_city_name(repaired(t, "basic"), mapped(t, STATE_NAME_MAP))
    return enriched(df).select("k", "city", "city_source")


@check(
    "enrichment_counts",
    "A10",
    f"""SELECT _chunk AS chunk,
          count(*) FILTER (city_source IS NOT NULL) AS municipio_inferred_count,
          CAST(0 AS BIGINT) AS municipio_inferred_by_name_count,
          count(*) FILTER (state_source IS NOT NULL) AS uf_corrected_count
        FROM ({postal_sql(EXACT_MAP, 'cep', 'cep_map_exact', 8, True)}) e
        JOIN (SELECT k AS kk, _chunk FROM raw_estab) r ON e.k = r.kk GROUP BY _chunk""",
)
def counted_enrichment(t: Tables) -> DataFrame:
    df = enrich_by_postal_code(repaired(t), mapped(t, EXACT_MAP))
    return enrichment_counts(df, [CHUNK]).withColumnRenamed(CHUNK, "chunk")


@check(
    "enrichment_examples",
    "A10",
    f"""SELECT k, city FROM ({postal_sql(EXACT_MAP, 'cep', 'cep_map_exact', 8, True)})
        WHERE city_source IS NOT NULL ORDER BY k LIMIT 10""",
)
def first_enriched(t: Tables) -> DataFrame:
    df = enrich_by_postal_code(repaired(t), mapped(t, EXACT_MAP))
    found = enrichment_examples(
        df, "municipio_codigo", "municipio_source", "cep", "cep_map_exact", ["_k"]
    )
    return found.select(F.col("_k").alias("k"), F.col("municipio_codigo").alias("city"))


@check(
    "distinct_shares",
    "A14",
    None,
)
def distinct_shares(t: Tables) -> DataFrame:
    return selectivity(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"])


@check(
    "chunk_of_key",
    "W1",
    """SELECT CAST(floor(o_orderkey / 700) AS BIGINT) + 1 AS chunk, count(*) AS rows,
       min(o_orderkey) AS first_key FROM orders GROUP BY 1""",
)
def key_chunks(t: Tables) -> DataFrame:
    return _chunk_sizes(chunk_of_key(t.orders.select("o_orderkey"), "o_orderkey", 700))


@check(
    "chunk_by_position",
    "W1",
    """SELECT CAST(floor(o_orderkey / 900) AS BIGINT) + 1 AS chunk, count(*) AS rows,
       min(o_orderkey) AS first_key FROM orders GROUP BY 1""",
)
def position_chunks(t: Tables) -> DataFrame:
    # Orders are stored in key order, so position and key agree.
    return _chunk_sizes(chunk_by_position(t.orders.select("o_orderkey"), 900))


def _chunk_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col(CHUNK).alias("chunk")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("first_key")
    )

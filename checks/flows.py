"""Whole-table builds, batch and streaming."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.cleaning import s
from checks.quality import ACCEPTED, AGGRESSIVE, CNAE_BAD, MUN_BAD, PAIS_BAD
from checks.readers import UTF8, folder
from checks.registry import WRITTEN, Tables, check
from registrum.options import Options
from registrum.plans.tables import all_quarantine, build_all, build_table
from registrum.sinks.tables import write_exchange
from registrum.sources.archives import list_files
from registrum.sources.delimited import FILE
from registrum.specs import ESTABLISHMENTS, TABLES
from registrum.streaming.ingest import ingest, ingested, running_totals, stream_table

RELAXED = Options(strict_membership=False)
UNGATED = Options(level="aggressive", strict_membership=False, gates=False)
LOADED = ("cnpj_basico", "cnpj_ordem", "cnpj_dv", "uf", "pais_codigo", "municipio_codigo",
          "cnae_fiscal_principal_codigo", "correio_eletronico")


def loaded_sql(source: str) -> str:
    return f"""SELECT cnpj_basico, cnpj_ordem, cnpj_dv, uf,
        CAST(CASE WHEN NOT {PAIS_BAD} THEN CAST(pais_codigo AS INT) END AS VARCHAR) AS pais_codigo,
        CASE WHEN NOT {MUN_BAD} THEN municipio_codigo END AS municipio_codigo,
        CAST(CASE WHEN NOT {CNAE_BAD} THEN cnae_fiscal_principal_codigo END AS VARCHAR)
          AS cnae_fiscal_principal_codigo,
        correio_eletronico, count(*) AS n FROM {source} GROUP BY ALL"""


def loaded(df: DataFrame) -> DataFrame:
    out = df.select(*[s(c).alias(c) for c in LOADED])
    return out.groupBy(*LOADED).agg(F.count(F.lit(1)).alias("n"))


@check("build_establishments", "P1 C25 C26 F4 F6", loaded_sql(ACCEPTED))
def build_establishments(t: Tables) -> DataFrame:
    raw = t.raw_estab.drop("k")
    result = build_table(raw, ESTABLISHMENTS, t.domains, AGGRESSIVE)
    return loaded(result.clean)


@check(
    "build_all_tables",
    "P2 F8 A13",
    f"""SELECT 'paises' AS tbl, count(*) AS rows FROM nation
        UNION ALL SELECT 'municipios', count(*) FROM supplier
        UNION ALL SELECT 'qualificacoes_socios', count(*) FROM region
        UNION ALL SELECT 'cnaes', count(*) FROM part
        UNION ALL SELECT 'naturezas_juridicas', count(*) FROM region
        UNION ALL SELECT 'empresas', count(*) FROM raw_empresas
        UNION ALL SELECT 'estabelecimentos', count(*) FROM {ACCEPTED}
        UNION ALL SELECT 'quarantine of empresas', count(*) FROM raw_empresas
          WHERE CAST(natureza_juridica_codigo AS INT) NOT IN (SELECT r_regionkey FROM region)""",
)
def build_all_tables(t: Tables) -> DataFrame:
    raw = {
        "paises": t.domains["paises"],
        "municipios": t.domains["municipios"],
        "qualificacoes": t.domains["qualificacoes_socios"],
        "naturezas": t.domains["naturezas_juridicas"],
        "cnaes": t.domains["cnaes"],
    }
    one_chunk = {n: df.withColumn("_chunk", F.lit(1).cast("long")) for n, df in raw.items()}
    one_chunk["empresas"] = t.raw_empresas.drop("k")
    one_chunk["estabelecimentos"] = t.raw_estab.drop("k")
    results = build_all(one_chunk, AGGRESSIVE, exclude={"socios", "simples"})
    out = None
    for name, result in results.items():
        one = result.clean.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(TABLES[name].table).alias("tbl"), "rows"
        )
        out = one if out is None else out.union(one)
    firms = all_quarantine({"empresas": results["empresas"]})
    return out.union(
        firms.where(F.col("reason") == "fk_violation")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit("quarantine of empresas"), "rows")
    )


@check(
    "build_every_table",
    "P2 A13",
    """SELECT 'paises' AS tbl, count(*) AS rows FROM nation
        UNION ALL SELECT 'municipios', count(*) FROM supplier
        UNION ALL SELECT 'qualificacoes_socios', count(*) FROM region
        UNION ALL SELECT 'cnaes', count(*) FROM part
        UNION ALL SELECT 'naturezas_juridicas', count(*) FROM region
        UNION ALL SELECT 'empresas', count(*) FROM raw_empresas
        UNION ALL SELECT 'estabelecimentos', count(*) FROM raw_estab
        UNION ALL SELECT 'simples', count(*) FROM raw_simples
        UNION ALL SELECT 'socios', count(*) FROM raw_socios""",
)
def build_every_table(t: Tables) -> DataFrame:
    """All nine tables, with the two whose foreign keys are hot. The gates are off: every chunk of
    the partners would be gated, since the repair changes every id of a representative."""
    raw = {
        "paises": t.domains["paises"],
        "municipios": t.domains["municipios"],
        "qualificacoes": t.domains["qualificacoes_socios"],
        "naturezas": t.domains["naturezas_juridicas"],
        "cnaes": t.domains["cnaes"],
    }
    chunked = {n: df.withColumn("_chunk", F.lit(1).cast("long")) for n, df in raw.items()}
    chunked["empresas"] = t.raw_empresas.drop("k")
    chunked["estabelecimentos"] = t.raw_estab.drop("k")
    chunked["simples"] = t.raw_simples.drop("k")
    chunked["socios"] = t.raw_socios.drop("o", "n")
    results = build_all(chunked, UNGATED)
    counts = [
        r.clean.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(r.spec.table).alias("tbl"), "rows")
        for r in results.values()
    ]
    return reduce(DataFrame.union, counts)


# Files of 4000 rows; each is one chunk. The first holds the bad addresses. Every run has about
# as many micro-batches, so a batch takes more files where there are more.
BATCHES = 8
BLOCK = "CAST(floor(k / 4000) AS BIGINT)"
KEPT_BLOCKS = f"""(SELECT * FROM rep_basic WHERE {BLOCK} NOT IN (SELECT blk FROM (
    SELECT {BLOCK} AS blk, count(*) AS n, count(*) FILTER (correio_eletronico IS NULL)
      - count(*) FILTER (nullif(b_correio_eletronico, '') IS NULL) AS delta
    FROM rep_basic GROUP BY 1) WHERE n >= 20 AND delta / n > 0.3))"""


def streamed(t: Tables) -> str:
    """Writes the establishments as text files and ingests them in batches of files, once per
    session. The gate judges file by file."""
    key = (t.spark.sparkContext.applicationId, t.folder, "stream")
    if key in WRITTEN:
        return WRITTEN[key]
    base = folder(t, "stream")
    rows = t.raw_estab.withColumn("block", F.floor(F.col("k") / 4000))
    for c in ESTABLISHMENTS.source_columns:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    blocks = rows.select("block", *ESTABLISHMENTS.source_columns)
    (
        blocks.repartition("block")
        .write.partitionBy("block")
        .options(sep=";", quote='"', escape='"', ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False, nullValue="", emptyValue="")
        .csv(f"{base}/in")
    )
    files = list_files(t.spark, f"{base}/in", "*.csv").count()
    stream = stream_table(
        t.spark, ESTABLISHMENTS, f"{base}/in", UTF8, files_per_batch=max(1, -(-files // BATCHES))
    )
    query = ingest(
        stream, ESTABLISHMENTS, f"{base}/out", f"{base}/checkpoint", t.domains, RELAXED, chunk=F.col(FILE)
    )
    query.awaitTermination()
    WRITTEN[key] = f"{base}/out"
    return WRITTEN[key]


@check("streamed_ingest", "T1 T2", loaded_sql(KEPT_BLOCKS))
def streamed_ingest(t: Tables) -> DataFrame:
    return loaded(ingested(t.spark, streamed(t)))


@check(
    "streamed_totals",
    "T2 T3 A6",
    f"""SELECT count(*) AS rows_total, count(DISTINCT {BLOCK}) AS chunks_processed,
        (SELECT count(DISTINCT {BLOCK}) FROM rep_basic) - count(DISTINCT {BLOCK})
          AS quality_gate_chunks FROM {KEPT_BLOCKS}""",
)
def streamed_totals(t: Tables) -> DataFrame:
    row = running_totals(t.spark, streamed(t), RELAXED)
    return row.select("rows_total", "chunks_processed", "quality_gate_chunks")

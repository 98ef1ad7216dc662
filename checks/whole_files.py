"""Files read in many splits: quoted line breaks, chunks by place, rejects."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.inputs import blank_to_null, of_length
from checks.readers import UTF8, folder, na_sql, write_archives
from checks.registry import Tables, check
from registrum.options import Options
from registrum.plans.tables import build_all, build_table, read_archived
from registrum.session import write_and_reread
from registrum.sinks.tables import write_exchange
from registrum.sources.archives import list_files
from registrum.sources.whole_records import read_rows
from registrum.specs import COMPANIES, ESTABLISHMENTS, REGIMES, TABLES

SPLIT_BYTES = 64 << 10
BLOCK = 4000


SPLITS = 256
DEALT_BYTES = 64 << 20


@contextmanager
def small_splits(spark: SparkSession, size: int = SPLIT_BYTES) -> Iterator[None]:
    """Cuts files into more splits than a production run would; a split of small files holds several."""
    wanted = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": min(size, 4096)}
    given = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in given.items():
            spark.conf.set(key, value)


def split_size(total: int) -> int:
    """Splits grow with the files, so that their number does not."""
    return max(SPLIT_BYTES, -(-total // SPLITS))


BROKEN = "concat('Linha \"um\";', chr(10), razao_social, chr(10), '\"', chr(10), 'fim')"


@check(
    "quoted_line_breaks",
    "S1 S3",
    f"""SELECT {', '.join(na_sql(c) for c in COMPANIES.column_names if c != 'razao_social')},
        CASE WHEN k % 3 = 0 THEN {BROKEN} WHEN razao_social IN ('', ' ', 'NULL') THEN NULL
          ELSE razao_social END AS razao_social FROM raw_empresas""",
)
def quoted_line_breaks(t: Tables) -> DataFrame:
    """Every third name spans four lines; the files are cut at any byte."""
    path = folder(t, "breaks")
    rows = t.raw_empresas.withColumn("razao_social", F.expr(f"CASE WHEN k % 3 = 0 THEN {BROKEN} ELSE razao_social END"))
    write_exchange(rows.select(*COMPANIES.column_names).repartition(3), path)
    with small_splits(t.spark):
        read = read_rows(t.spark, COMPANIES, path, UTF8).select(*COMPANIES.column_names)
        return write_and_reread(read, "whole-records")


@check(
    "chunks_by_place",
    "W1 F6 P1",
    f"""SELECT blk AS block, part, count(*) AS rows, count(*) >= 20 AND
          abs(count(*) FILTER (correio_eletronico IS NULL)
            - count(*) FILTER (nullif(b_correio_eletronico, '') IS NULL)) / count(*) > 0.3 AS gated
        FROM (SELECT *, CAST(floor(k / {BLOCK}) AS BIGINT) AS blk,
          CAST(floor((row_number() OVER (PARTITION BY floor(k / {BLOCK}) ORDER BY k) - 1) / 300) AS BIGINT) AS part
          FROM rep_basic) GROUP BY 1, 2""",
)
def chunks_by_place(t: Tables) -> DataFrame:
    """Telemetry of chunks of 300 rows; the rows were dealt out to 40 partitions or more after reading."""
    path = folder(t, "placed")
    rows = t.raw_estab.withColumn("block", F.floor(F.col("k") / BLOCK))
    for c in ESTABLISHMENTS.source_columns:
        if c not in rows.columns:
            rows = rows.withColumn(c, F.lit(None).cast("string"))
    ordered = rows.repartition("block").sortWithinPartitions("block", "k")
    options = dict(sep=";", quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                   nullValue="", emptyValue="")
    ordered.select("block", *ESTABLISHMENTS.source_columns).write.partitionBy("block").options(**options).csv(path)
    opts = Options(strict_membership=False, encoding="UTF-8", chunk_size=300)
    total = list_files(t.spark, path, "*.csv").agg(F.coalesce(F.sum("length"), F.lit(0))).head()[0]
    with small_splits(t.spark, split_size(total)):
        raw = read_rows(t.spark, ESTABLISHMENTS, path, opts).repartition(max(40, total // DEALT_BYTES))
        records = build_table(raw, ESTABLISHMENTS, t.domains, opts).telemetry
    return records.select(
        F.regexp_extract("chunk", r"block=(\d+)", 1).cast("long").alias("block"),
        F.substring_index("chunk", "#", -1).cast("long").alias("part"),
        "rows",
        "gated",
    )


LAST = "row_number() OVER (PARTITION BY k % 7 ORDER BY k DESC) = 1"


@check(
    "rejects_accounted",
    "S1 F8",
    f"""SELECT kind, count(*) AS rows FROM (SELECT CASE WHEN {LAST} THEN 'open_quote'
          WHEN opcao_pelo_simples = 'S' THEN 'malformed_line' ELSE 'clean' END AS kind FROM raw_simples)
        GROUP BY 1 UNION ALL SELECT 'lines', count(*) FROM raw_simples""",
)
def rejects_accounted(t: Tables) -> DataFrame:
    """What is loaded and what is recorded add up to the lines of the files, without being asked
    for: the last line of each file leaves a quote open, others have too many fields."""
    path = folder(t, "rejects")
    rows = t.raw_simples.withColumn("file", F.col("k") % 7)
    last = F.row_number().over(Window.partitionBy("file").orderBy(F.desc("k"))) == 1
    line = F.concat_ws(";", *[F.coalesce(c, F.lit("")) for c in REGIMES.column_names])
    line = F.when(last, F.concat(line, F.lit(';"open'))).when(
        F.col("opcao_pelo_simples") == "S", F.concat(line, F.lit(";too;many"))
    ).otherwise(line)
    lines = rows.select("file", "k", line.alias("value")).repartition("file")
    lines.sortWithinPartitions("file", "k").select("file", "value").write.partitionBy("file").text(path)
    opts = Options(strict_membership=False, encoding="UTF-8", gates=False)
    with small_splits(t.spark):
        result = build_table(read_rows(t.spark, REGIMES, path, opts), REGIMES, {}, opts)
        recorded = result.quarantine.where("reason in ('open_quote', 'malformed_line')")
        kinds = recorded.select(F.col("reason").alias("kind")).unionByName(result.clean.select(F.lit("clean").alias("kind")))
        counted = write_and_reread(kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("rows")), "accounted")
    return counted.unionByName(t.spark.read.text(path).select(F.lit("lines").alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("rows")))


def digest_sql(*columns: str) -> str:
    """Rows and a sum over the digests of their cells."""
    row = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"
    return f"count(*) AS rows, CAST(sum(CAST('0x' || substr(md5({row}), 1, 8) AS BIGINT)) AS BIGINT) AS digest"


SHOWN = {
    "empresas": ("cnpj_basico", "razao_social", "ente_federativo_responsavel"),
    "estabelecimentos": ("cnpj_basico", "cnpj_ordem", "cnpj_dv", "nome_fantasia", "cep"),
    "simples": ("cnpj_basico", "opcao_pelo_simples", "opcao_pelo_mei"),
    "socios": ("cnpj_basico", "nome_socio_ou_razao_social"),
}
DOMAIN_SOURCES = {
    "paises": ("nation", "n_nationkey", "n_name"),
    "municipios": ("supplier", "s_suppkey", "s_name"),
    "qualificacoes_socios": ("region", "r_regionkey", "r_name"),
    "naturezas_juridicas": ("region", "r_regionkey", "r_name"),
    "cnaes": ("part", "p_partkey", "p_name"),
}
RAW = {"empresas": "raw_empresas", "estabelecimentos": "raw_estab", "simples": "raw_simples", "socios": "raw_socios"}


def cleaned_sql(column: str) -> str:
    """Null tokens, then the cleaner of the column at level basic."""
    given = f"(CASE WHEN {column} IN ('', ' ', 'NULL', 'NA', 'nan', 'None') THEN NULL ELSE {column} END)"
    if column in ("razao_social", "nome_fantasia", "nome_socio_ou_razao_social"):
        return blank_to_null(given)
    widths = {"cnpj_basico": 8, "cnpj_ordem": 4, "cnpj_dv": 2, "cep": 8}
    return of_length(given, widths[column]) if column in widths else given


@check(
    "build_from_archives",
    "S4 S5 P2 A13",
    " UNION ALL ".join(
        [f"SELECT '{name}' AS tbl, {digest_sql(key, label)} FROM {source}"
         for name, (source, key, label) in DOMAIN_SOURCES.items()]
        + [f"SELECT '{name}', {digest_sql(*map(cleaned_sql, SHOWN[name]))} FROM {source}" for name, source in RAW.items()]
    ),
)
def build_from_archives(t: Tables) -> DataFrame:
    """All nine tables from zip archives, one or more per table and partition. The gates are off: the
    repair changes every id of a representative, so all chunks of the partners would be withheld."""
    path = folder(t, "zips")
    for name, spec in TABLES.items():
        rows = t.domains[spec.table] if spec.table in t.domains else getattr(t, RAW[name])
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("") for c in spec.source_columns]
        quoted = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in cells]
        lines = rows.select(F.lit(name).alias("category"), F.concat_ws(";", *quoted).alias("line"))
        write_archives(lines, "category", "line", path)
    opts = Options(strict_membership=False, gates=False)
    raw, rejects = read_archived(t.spark, path, opts)
    results = build_all(raw, opts)
    out = None
    for result in results.values():
        table = result.spec.table
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in SHOWN.get(table, ("codigo", "nome"))]
        part = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("long")
        one = result.clean.agg(F.count(F.lit(1)).alias("rows"), F.sum(part).alias("digest"))
        one = one.select(F.lit(table).alias("tbl"), "rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out

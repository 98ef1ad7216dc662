"""Sources and sinks, as round trips through the shared folder."""

from __future__ import annotations

import io
import posixpath
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.cleaning import s
from checks.quality import AGGRESSIVE, GATED, ROWS, records
from checks.registry import Tables, check
from registrum.operators.profile import column_stats, summary, totals
from registrum.operators.repair import repair
from registrum.options import Options
from registrum.session import fresh_path, short_methods
from registrum.sinks.records import metric_lines, write_json_lines, write_summary
from registrum.sinks.sql_folder import run_sql_folder
from registrum.sinks.tables import PART, write_by_state, write_exchange
from registrum.sources import archives
from registrum.sources.delimited import (
    FILE, decode_lines, drop_bad_lines, parse_lines, read_lines, read_table, tokens_to_null,
)
from registrum.sources.listing import latest_snapshot, links, new_snapshot, rows_of_latest
from registrum.sources.lookups import CITY_COLUMNS, POSTAL_COLUMNS, read_lookup
from registrum.specs import COMPANIES, ESTABLISHMENTS, REGIMES

UTF8 = Options(encoding="UTF-8")


def folder(t: Tables, label: str) -> str:
    return fresh_path(t.spark, f"checks/{label}")


NA = "('', ' ', 'NULL', 'NA', 'nan', 'None')"


def na_sql(c: str) -> str:
    return f"CASE WHEN {c} IN {NA} THEN NULL ELSE {c} END AS {c}"


@check(
    "delimited_round_trip",
    "S1 S2 K1",
    f"""SELECT {', '.join(na_sql(c) for c in COMPANIES.column_names)} FROM raw_empresas""",
)
def delimited_round_trip(t: Tables) -> DataFrame:
    path = folder(t, "companies")
    write_exchange(t.raw_empresas.select(*COMPANIES.column_names), path, encoding="ISO-8859-1")
    return read_table(t.spark, COMPANIES, path).select(*COMPANIES.column_names)


@check(
    "union_of_files",
    "S3 U1",
    f"""SELECT {', '.join(na_sql(c) for c in REGIMES.column_names)}, true AS from_file
        FROM raw_simples""",
)
def union_of_files(t: Tables) -> DataFrame:
    path = folder(t, "regimes")
    write_exchange(t.raw_simples.select(*REGIMES.column_names).repartition(5), path)
    df = read_table(t.spark, REGIMES, path, UTF8)
    from_file = F.col(FILE).endswith(".csv")
    return df.select(*REGIMES.column_names, from_file.alias("from_file"))


@check(
    "mixed_encodings",
    "S7 S3",
    "SELECT k, municipio_nome FROM raw_estab UNION ALL SELECT k + 1000000000, municipio_nome "
    "FROM raw_estab",
)
def mixed_encodings(t: Tables) -> DataFrame:
    path = folder(t, "encodings")
    rows = t.raw_estab.select("k", "municipio_nome")
    write_exchange(rows, f"{path}/a", encoding="ISO-8859-1")
    write_exchange(rows.withColumn("k", F.col("k") + 1000000000), f"{path}/b", encoding="UTF-8")
    lines = decode_lines(read_lines(t.spark, [f"{path}/a", f"{path}/b"]))
    parsed = parse_lines(lines, rows.schema, UTF8)
    return parsed.select(F.col("k").cast("long").alias("k"), "municipio_nome")


@check(
    "bad_lines_dropped",
    "D4 S1",
    f"""SELECT {', '.join(na_sql(c) for c in REGIMES.column_names)} FROM raw_simples
        WHERE opcao_pelo_mei <> '' AND opcao_pelo_simples <> 'S'""",
)
def bad_lines_dropped(t: Tables) -> DataFrame:
    path = folder(t, "broken")
    whole = F.concat_ws(";", *REGIMES.column_names)
    broken = (
        F.when(F.col("opcao_pelo_mei") == "", F.lit("   "))
        .when(F.col("opcao_pelo_simples") == "S", F.concat(whole, F.lit(";too;many")))
        .otherwise(whole)
    )
    t.raw_simples.select(broken).write.text(path)
    lines = drop_bad_lines(read_lines(t.spark, path), len(REGIMES.column_names))
    return parse_lines(lines, REGIMES.read_schema(), UTF8).select(*REGIMES.column_names)


def write_archives(df: DataFrame, category: str, line: str, path: str) -> None:
    """One zip per category and batch of rows."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        fs, root = archives.filesystem(path)
        fs.create_dir(root, recursive=True)
        for number, batch in enumerate(batches):
            for name in batch.column(0).drop_null().unique().to_pylist():
                rows = batch.column(1).filter(pc.equal(batch.column(0), name))
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
                    text = "\r\n".join(rows.to_pylist()) + "\r\n"
                    archive.writestr("data/K3241.CSV", text.encode("latin-1"))
                    archive.writestr("../outside.csv", b"never read")
                with fs.open_output_stream(f"{root}/{name}{part}_{number}.zip") as out:
                    out.write(buffer.getvalue())
                yield pa.RecordBatch.from_pydict({"name": [name]})

    with short_methods(df.sparkSession):
        df.select(category, line).mapInArrow(pack, "name string").count()


def archived_customers(t: Tables) -> str:
    path = folder(t, "archives")
    line = F.concat_ws(";", "c_custkey", "c_name", s("c_nationkey"), F.lit("São Paulo"))
    write_archives(t.customer.select("c_mktsegment", line.alias("line")), "c_mktsegment", "line", path)
    return path


@check(
    "archive_lines",
    "S4 S5",
    """SELECT lower(c_mktsegment) AS category, CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       CAST(c_nationkey AS VARCHAR) AS nation, 'São Paulo' AS city FROM customer""",
)
def archive_lines(t: Tables) -> DataFrame:
    lines, _ = archives.read_archives(t.spark, archived_customers(t))
    schema = t.spark.createDataFrame([], "id string, name string, nation string, city string").schema
    parsed = parse_lines(lines, schema, UTF8)
    return parsed.select("category", *schema.names)


def damaged(t: Tables) -> str:
    """A folder of archives per market segment; one segment's are cut short, in another's a member
    has a wrong checksum."""
    source, path = archived_customers(t), folder(t, "damaged-archives")

    def spoil(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["path"]:
                with archives.open_shared(name) as given:
                    data = bytearray(given.read())
                base = posixpath.basename(name)
                if base.startswith("AUTO"):
                    data = data[: len(data) // 2]
                elif base.startswith("BUILD"):
                    # The checksum of the first member, in its own and in the central header.
                    data[14] ^= 0xFF
                    data[data.index(b"PK\x01\x02") + 16] ^= 0xFF
                fs, root = archives.filesystem(path)
                fs.create_dir(root, recursive=True)
                with fs.open_output_stream(f"{root}/{base}") as out:
                    out.write(bytes(data))
                yield pd.DataFrame({"name": [base]})

    archives.list_files(t.spark, source).select("path").mapInPandas(spoil, "name string").count()
    return path


@check(
    "damaged_archives",
    "S4 S6",
    """SELECT lower(c_mktsegment) AS category, CASE WHEN c_mktsegment LIKE 'AUTO%' THEN 'not a zip'
         WHEN c_mktsegment LIKE 'BUILD%' THEN 'damaged member: BadZipFile' ELSE 'read' END AS outcome,
       CASE WHEN c_mktsegment LIKE 'AUTO%' OR c_mktsegment LIKE 'BUILD%' THEN 0 ELSE count(*) END
         AS lines FROM customer GROUP BY c_mktsegment
       UNION ALL SELECT DISTINCT lower(c_mktsegment), 'unsafe member', 0 FROM customer
       WHERE c_mktsegment NOT LIKE 'AUTO%'""",
)
def damaged_archives(t: Tables) -> DataFrame:
    lines, rejects = archives.read_archives(t.spark, damaged(t))
    read = lines.groupBy("category").agg(F.count(F.lit(1)).alias("lines"))
    left = rejects.select(archives.category(F.col("path")).alias("category"), F.col("reason").alias("outcome"))
    return read.select("category", F.lit("read").alias("outcome"), "lines").unionByName(
        left.distinct().withColumn("lines", F.lit(0).cast("long"))
    )


@check(
    "archive_integrity",
    "S6 S5",
    """SELECT DISTINCT lower(c_mktsegment) AS category, 'ok' AS status, true AS ok FROM customer""",
)
def archive_integrity(t: Tables) -> DataFrame:
    files = archives.list_files(t.spark, archived_customers(t))
    report = archives.archive_report(files)
    return report.select(
        archives.category(F.col("path")).alias("category"), "status", "ok"
    ).distinct()


@check(
    "file_categories",
    "S5",
    """SELECT coalesce(nullif(lower(regexp_extract(path, '/([\\p{L}]*)[^/]*$', 1)), ''),
         'desconhecido') AS category, count(*) AS files
       FROM (SELECT concat('/in/', c_mktsegment, c_custkey, '.zip') AS path FROM customer
         UNION ALL SELECT concat('/in/', c_custkey, '.zip') FROM customer) GROUP BY 1""",
)
def file_categories(t: Tables) -> DataFrame:
    key = s("c_custkey")
    named = t.customer.select(
        F.concat(F.lit("/in/"), "c_mktsegment", key, F.lit(".zip")).alias("path")
    )
    bare = t.customer.select(F.concat(F.lit("/in/"), key, F.lit(".zip")).alias("path"))
    return archives.category_counts(named.union(bare))


@check(
    "lookup_files",
    "S8",
    """SELECT 'city' AS kind, s_name AS municipio_nome, CAST(s_suppkey AS VARCHAR) AS code
       FROM supplier""",
)
def lookup_files(t: Tables) -> DataFrame:
    path = folder(t, "lookup")
    rows = t.supplier.select(
        F.col("s_name").alias("municipio_nome"), F.col("s_suppkey").alias("municipio_codigo")
    )
    rows.write.option("header", "true").csv(path)
    assert read_lookup(t.spark, path, POSTAL_COLUMNS) is None
    assert read_lookup(t.spark, f"{path}-missing", CITY_COLUMNS) is None
    city = read_lookup(t.spark, path, CITY_COLUMNS)
    return city.select(
        F.lit("city").alias("kind"), "municipio_nome", F.col("municipio_codigo").alias("code")
    )


@check(
    "latest_snapshot",
    "S9 W2",
    """SELECT max(strftime(o_orderdate, '%Y-%m')) AS snapshot,
         count(*) FILTER (strftime(o_orderdate, '%Y-%m') =
           (SELECT max(strftime(o_orderdate, '%Y-%m')) FROM orders)) AS rows, 0 AS news
       FROM orders""",
)
def snapshot_of_orders(t: Tables) -> DataFrame:
    months = t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    entries = months.select(F.concat("month", F.lit("/")).alias("entry"))
    latest = latest_snapshot(entries, "entry")
    rows = rows_of_latest(months, "month").select(F.count(F.lit(1))).scalar()
    news = new_snapshot(entries, "entry", latest.head()[0]).select(F.count(F.lit(1))).scalar()
    return latest.select("snapshot", rows.alias("rows"), news.cast("int").alias("news"))


@check(
    "page_links",
    "S10",
    """SELECT page_id, href, concat(rtrim(url, '/'), '/', href) AS link, count(*) AS n
       FROM (SELECT page_id, url, unnest(regexp_extract_all(html,
         '<a href="([^" ]*)', 1)) AS href FROM pages)
       WHERE href <> '' AND NOT starts_with(href, 'http') AND lower(href) LIKE '%.'
       GROUP BY ALL""",
)
def page_links(t: Tables) -> DataFrame:
    found = links(t.pages, "html", F.col("url"), suffix=".")
    return found.groupBy("page_id", "href", "link").agg(F.count(F.lit(1)).alias("n"))


@check(
    "state_partitions",
    "K7 W3",
    """SELECT coalesce(uf, 'default') AS part, count(*) AS rows, count(DISTINCT k) AS ids
       FROM rep_basic GROUP BY 1""",
)
def state_partitions(t: Tables) -> DataFrame:
    path = folder(t, "by-state")
    write_by_state(repair(t.raw_estab, ESTABLISHMENTS).select("k", "uf"), path)
    return (
        t.spark.read.parquet(path)
        .groupBy(F.col(PART).alias("part"))
        .agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("k").alias("ids"))
    )


@check(
    "telemetry_json",
    "K3 K4 A5",
    f"""SELECT chunk, rows, chunk IN ({GATED}) AS gated, 'estabelecimentos' AS config
        FROM ({ROWS})""",
)
def telemetry_json(t: Tables) -> DataFrame:
    path = folder(t, "telemetry")
    write_json_lines(records(t), path, max_bytes=10_000, run_date="20240101")
    schema = "chunk long, rows long, gated boolean, config string, run_date string"
    return t.spark.read.schema(schema).json(path).drop("run_date")


@check(
    "summary_json",
    "A7 K5",
    f"""SELECT 'estabelecimentos' AS config, count(*) AS rows_total,
        count(DISTINCT _chunk) AS chunks_processed,
        CAST((SELECT count(*) FROM ({GATED})) AS BIGINT) AS quality_gate_chunks,
        min(uf) AS least_uf, count(*) FILTER (uf IS NULL) AS null_uf
        FROM rep_aggressive WHERE _chunk NOT IN ({GATED})""",
)
def summary_json(t: Tables) -> DataFrame:
    from registrum.operators.quality import accepted_rows

    path = folder(t, "summary")
    gated = records(t)
    rows = accepted_rows(repair(t.raw_estab, ESTABLISHMENTS, "aggressive"), gated)
    stats = column_stats(rows, ["uf", "cep"])
    write_summary(summary(ESTABLISHMENTS, gated, stats, AGGRESSIVE), path)
    schema = (
        "config string, rows_total long, chunks_processed long, quality_gate_chunks long, "
        "column_stats struct<uf:struct<nulls:long,min:string,max:string>>"
    )
    return t.spark.read.schema(schema).json(path).select(
        "config", "rows_total", "chunks_processed", "quality_gate_chunks",
        F.col("column_stats.uf.min").alias("least_uf"),
        F.col("column_stats.uf.nulls").alias("null_uf"),
    )


@check(
    "metric_lines",
    "K6",
    f"""SELECT concat('cnpj_auto_repair_rows_total{{table="estabelecimentos"}} ', count(*)) AS line
          FROM rep_aggressive WHERE _chunk NOT IN ({GATED})
        UNION ALL SELECT concat(
          'cnpj_auto_repair_quality_gate_chunks_total{{table="estabelecimentos"}} ', count(*))
          FROM ({GATED})""",
)
def totals_as_metrics(t: Tables) -> DataFrame:
    lines = metric_lines(totals(records(t), AGGRESSIVE), ESTABLISHMENTS.table)
    return lines.where(~F.col("value").contains("column=")).withColumnRenamed("value", "line")


@check(
    "sql_folder",
    "K8",
    """SELECT 'a.sql' AS name, count(*) AS rows FROM customer
       UNION ALL SELECT 'b.sql', count(*) FROM orders WHERE o_orderstatus = 'F'""",
)
def sql_folder(t: Tables) -> DataFrame:
    path = folder(t, "sql")
    texts = {
        "b.sql": "SELECT count(*) AS rows FROM orders WHERE o_orderstatus = 'F'",
        "a.sql": "SELECT count(*) AS rows FROM customer;",
    }
    fs, root = archives.filesystem(path)
    fs.create_dir(root, recursive=True)
    for name, text in texts.items():
        with fs.open_output_stream(f"{root}/{name}") as out:
            out.write(text.encode())
    results = run_sql_folder(t.spark, path, {"customer": t.customer, "orders": t.orders})
    out = None
    for name, df in results.items():
        one = df.select(F.lit(name).alias("name"), "rows")
        out = one if out is None else out.union(one)
    return out


@check(
    "null_tokens",
    "S1",
    f"""SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE role END AS role,
        md5(CASE WHEN text IN {NA} THEN NULL ELSE text END) AS digest FROM conversations""",
)
def null_tokens(t: Tables) -> DataFrame:
    rows = tokens_to_null(t.conversations, ["role"], ("system",))
    rows = tokens_to_null(rows, ["text"])
    return rows.select("conv_id", "turn", "role", F.md5("text").alias("digest"))



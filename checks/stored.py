"""Stored states and access paths: capped files, sketches, the index of codes, the manifest of
loaded files, save modes."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import inputs as sql
from checks.readers import folder
from checks.registry import Tables, check
from registrum.operators import code_index
from registrum.operators.repair import repair
from registrum.operators.sketches import column_sketches, error, estimates, merged
from registrum.session import write_and_reread
from registrum.sinks.records import write_json_lines
from registrum.sinks.tables import write_table
from registrum.sources.manifest import load_new
from registrum.specs import ESTABLISHMENTS

CAP = 1_000_000


@check(
    "json_file_sizes",
    "K4 K3",
    f"""SELECT count(*) AS records, CAST(sum(bytes) AS BIGINT) AS bytes,
          count(*) FILTER (bytes > {CAP}) AS files_over_cap, count(*) FILTER (bytes > {CAP}) AS records_over_cap
        FROM (SELECT strlen(to_json({{'doc_id': doc_id, 'text': text}})) + 1 AS bytes FROM documents)""",
)
def json_file_sizes(t: Tables) -> DataFrame:
    """Sizes of files of documents, as the file system tells them."""
    path = folder(t, "capped")
    write_json_lines(t.documents.select("doc_id", "text"), path, max_bytes=CAP, daily=False)
    files = t.spark.read.format("binaryFile").load(f"{path}/*.json").select("length")
    lines = t.spark.read.text(path)
    counted = lines.select(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.octet_length("value") + 1 > CAP).alias("records_over_cap"),
    )
    sizes = files.agg(F.sum("length").alias("bytes"), F.count_if(F.col("length") > CAP).alias("files_over_cap"))
    return counted.crossJoin(sizes).select("records", "bytes", "files_over_cap", "records_over_cap")


SKETCHED = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice"]


@check(
    "sketched_shares",
    "A14",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS col, count({c}) AS n, count(DISTINCT {c}) AS exact, true AS near,
          {'CAST(NULL AS BOOLEAN)' if c == 'l_returnflag' else 'true'} AS median_near FROM lineitem"""
        for c in SKETCHED
    ),
)
def sketched_shares(t: Tables) -> DataFrame:
    """States per chunk of orders, stored and merged: within three standard errors of the exact
    count; the median within 5 % of the rows."""
    chunked = t.lineitem.withColumn("chunk", F.floor(F.col("l_orderkey") / 1000))
    states = write_and_reread(column_sketches(chunked, SKETCHED, ["chunk"]), "sketches")
    found = write_and_reread(estimates(merged(states), [0.5]), "estimates")
    exact = t.lineitem.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in SKETCHED])))
    medians = {r["column"]: r.quantiles[0] for r in found.collect()}  # one row per column
    numbers = [c for c in SKETCHED if medians[c] is not None]
    ranks = t.lineitem.agg(
        *[F.count_if(F.col(c) < medians[c]).alias(f"{c}_below") for c in numbers],
        *[F.count_if(F.col(c) <= medians[c]).alias(f"{c}_upto") for c in numbers],
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"{c}_below").alias("below"), F.col(f"{c}_upto").alias("upto"))
                    for c in numbers
                ]
            )
        )
    )
    joined = found.join(exact, "column").join(ranks, "column", "left")
    n, off = F.col("values"), F.abs(F.col("distinct") - F.col("exact"))
    return joined.select(
        F.col("column").alias("col"),
        n.alias("n"),
        "exact",
        (off <= F.ceil(3 * error() * F.col("exact"))).alias("near"),
        ((F.col("below") <= 0.55 * n) & (F.col("upto") >= 0.45 * n)).alias("median_near"),
    )


CODES = ("1000005", "2000010")
TOKENS = f"(SELECT k, {sql.token_list('cnae_fiscal_secundaria')} AS toks FROM raw_estab)"


@check(
    "codes_by_bitmap",
    "Q4",
    f"""SELECT 'all' AS kind, k FROM {TOKENS}
          WHERE list_contains(toks, '{CODES[0]}') AND list_contains(toks, '{CODES[1]}')
        UNION ALL SELECT 'any', k FROM {TOKENS}
          WHERE list_contains(toks, '{CODES[0]}') OR list_contains(toks, '{CODES[1]}')""",
)
def codes_by_bitmap(t: Tables) -> DataFrame:
    estab = repair(t.raw_estab, ESTABLISHMENTS, "aggressive").select("k", "cnae_fiscal_secundaria")
    rows = write_and_reread(code_index.dense_rows(estab), "rows")
    index = code_index.write_code_index(rows, "row", "cnae_fiscal_secundaria", folder(t, "codes"))
    wanted = [int(c) for c in CODES]
    every = code_index.rows_with_all(index, wanted).select(F.lit("all").alias("kind"), "row")
    some = code_index.rows_with_any(index, wanted).select(F.lit("any").alias("kind"), "row")
    return every.union(some).join(rows.select("k", "row"), "row").select("kind", "k")


@check(
    "incremental_files",
    "S9 S3",
    """WITH o AS (SELECT o_orderkey, substr(o_orderpriority, 1, 1) AS p FROM orders)
       SELECT 1 AS run, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM o WHERE p <= '3'
       UNION ALL SELECT 2, count(*), CAST(sum(o_orderkey) AS BIGINT) FROM o WHERE p > '3'
       UNION ALL SELECT 4, 2 * count(*), CAST(2 * sum(o_orderkey) AS BIGINT) FROM o WHERE p = '1'""",
)
def incremental_files(t: Tables) -> DataFrame:
    """Four loads of a folder that grows: the first files, files that came since, nothing new, and
    files that were written anew with twice the rows."""
    source, manifest, target = (folder(t, n) for n in ("drops", "manifest", "loaded"))
    orders = t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("p"))

    def drop(rows: DataFrame, name: str) -> None:
        rows.write.mode("overwrite").csv(f"{source}/{name}")

    def load(run: int) -> None:
        def append(paths: list[str]) -> None:
            found = t.spark.read.schema("o_orderkey long, p string").csv(paths)
            found.write.parquet(f"{target}/run={run}")

        load_new(t.spark, source, manifest, str(run), append, "*.csv")

    drop(orders.where("p = '1'"), "first")
    drop(orders.where("p in ('2', '3')"), "second")
    load(1)
    drop(orders.where("p > '3'"), "third")
    load(2)
    load(3)
    first = orders.where("p = '1'")
    drop(first.union(first), "first")
    load(4)
    loaded = t.spark.read.schema("o_orderkey long, p string, run int").parquet(target)
    return loaded.groupBy("run").agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))


@check(
    "save_modes",
    "K2",
    """SELECT 'first' AS step, false AS refused, count(*) AS rows FROM nation
       UNION ALL SELECT 'again', true, count(*) FROM nation
       UNION ALL SELECT 'allowed', false, count(*) FROM supplier""",
)
def save_modes(t: Tables) -> DataFrame:
    path = folder(t, "save-modes")
    steps = [
        ("first", t.nation.selectExpr("n_nationkey AS key"), False),
        ("again", t.supplier.selectExpr("s_suppkey AS key"), False),
        ("allowed", t.supplier.selectExpr("s_suppkey AS key"), True),
    ]
    found = []
    for step, df, allowed in steps:
        refused = False
        try:
            write_table(df, path, allowed)
        except AnalysisException as e:
            if e.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            refused = True
        rows = write_and_reread(t.spark.read.parquet(path), "saved").agg(F.count(F.lit(1)).alias("rows"))
        found.append(rows.select(F.lit(step).alias("step"), F.lit(refused).alias("refused"), "rows"))
    return reduce(DataFrame.union, found)

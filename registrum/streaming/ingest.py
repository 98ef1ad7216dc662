"""New files as micro-batches through the table build.

``foreachBatch`` may run a batch again after a failure. Every output goes to a folder named
after the batch and is overwritten as a whole, so a replay changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from registrum.operators.chunks import CHUNK
from registrum.operators.profile import column_stats, totals
from registrum.options import Options
from registrum.plans.tables import Maps, build_table
from registrum.sources.delimited import CORRUPT, FILE, LINE, overlong, parse_lines
from registrum.sources.whole_records import OPEN_QUOTE, OVERLONG, REASON, REJECTED, open_at_end
from registrum.specs import TableSpec

BATCH = "batch_id"


def stream_table(
    spark: SparkSession,
    spec: TableSpec,
    folder: str,
    opts: Options = Options(),
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the text rows of a folder; files that arrive later join it. A line is a record
    here; one that leaves a quote open or has more fields than columns comes along in
    ``_rejected``, and ``ingest`` puts it into quarantine."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    given = reader.text(folder).select(F.col("_metadata.file_path").alias(FILE), F.col("value").alias(LINE))
    text = F.col(LINE) if opts.encoding.upper() == "UTF-8" else F.decode(F.col(LINE).cast("binary"), opts.encoding)
    given = given.withColumn(LINE, F.regexp_replace(text, "^(?:\ufeff|ï»¿)", "")).where(F.trim(LINE) != "")
    given = given.withColumn("_open", F.when(open_at_end(F.col(LINE)), F.col(LINE)))
    given = given.withColumn(LINE, F.when(F.col("_open").isNull(), F.col(LINE)))
    parsed = parse_lines(given, spec.read_schema(), opts)
    wide = overlong(len(spec.source_columns))
    return parsed.select(
        FILE,
        *[F.when(F.col("_open").isNull() & ~wide, F.col(c)).alias(c) for c in spec.source_columns],
        *[F.lit(None).cast("string").alias(c) for c in spec.derived],
        F.when(wide, F.col(CORRUPT)).otherwise(F.col("_open")).alias(REJECTED),
        F.when(wide, F.lit(OVERLONG)).when(F.col("_open").isNotNull(), F.lit(OPEN_QUOTE)).alias(REASON),
    )


def ingest(
    stream: DataFrame,
    spec: TableSpec,
    out: str,
    checkpoint: str,
    domains: Mapping[str, DataFrame] | None = None,
    opts: Options = Options(),
    maps: Maps = Maps(),
    chunk: Column | None = None,
) -> StreamingQuery:
    """Runs all available batches; a gated chunk is recorded and withheld, and the stream
    goes on. A batch is one chunk, unless ``chunk`` tells its chunks apart: with the file as the
    chunk, what is withheld does not depend on how many files a batch takes. ``domains`` are static
    tables."""
    opts = replace(opts, strict_membership=False)

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn(CHUNK, F.lit(batch_id).cast("long") if chunk is None else chunk)
        result = build_table(rows, spec, domains, opts, maps)
        for name, df in (
            ("clean", result.clean),
            ("quarantine", result.quarantine),
            ("telemetry", result.telemetry),
        ):
            df.write.mode("overwrite").parquet(f"{out}/{name}/{BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested(spark: SparkSession, out: str, kind: str = "clean") -> DataFrame:
    """Everything loaded so far; ``batch_id`` is a partition column."""
    return spark.read.parquet(f"{out}/{kind}")


def running_totals(spark: SparkSession, out: str, opts: Options = Options()) -> DataFrame:
    """Totals over the batches so far, from one telemetry row per chunk."""
    return totals(ingested(spark, out, "telemetry"), opts)


def running_stats(spark: SparkSession, out: str) -> DataFrame:
    loaded = ingested(spark, out)
    return column_stats(loaded, [c for c in loaded.columns if c != BATCH])

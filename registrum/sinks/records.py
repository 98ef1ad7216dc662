"""JSON lines, summaries and metrics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.session import write_and_reread

RUN_DATE = "run_date"

# Metric families of the text exposition.
ROWS_METRIC = "cnpj_auto_repair_rows_total"
GATED_METRIC = "cnpj_auto_repair_quality_gate_chunks_total"
CHANGED_METRIC = "cnpj_auto_repair_changed_total"
NULL_DELTA_METRIC = "cnpj_auto_repair_null_delta_total"


def records_per_file(df: DataFrame, max_bytes: int) -> int:
    """Rows that fit a byte cap, from the mean size of a row as JSON."""
    mean = df.agg(F.avg(F.octet_length(F.to_json(F.struct("*"))) + 1)).head()[0]
    return max(1, int(max_bytes / mean)) if mean else 1


def numbered_files(df: DataFrame, max_bytes: int) -> DataFrame:
    """Each row as ``row`` and the number of the JSON file it goes to (``file``, from 0, no gaps).

    Each task of the first pass fills one file after the other by running byte sums, line ends
    included. A record larger than the cap has a file of its own. The files of a task follow those
    of the tasks before it: prefix sums over one row per task."""
    whole = F.struct("*")
    size = F.octet_length(F.to_json(whole, {"ignoreNullFields": "false"})) + 1
    sized = df.select(whole.alias("row"), size.alias("size"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, used = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(1).to_pylist()
            numbers = np.empty(len(sizes), np.int64)
            for i, size in enumerate(sizes):
                if used and used + size > max_bytes:
                    number, used = number + 1, 0
                used += size
                numbers[i] = number
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(sizes), part, np.int32)), pa.array(numbers)],
                ["row", "part", "number"],
            )

    schema = T.StructType([
        T.StructField("row", df.schema), T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType())
    ])
    staged = write_and_reread(sized.mapInArrow(run, schema), "json-rows")
    files = staged.groupBy("part").agg((F.max("number") + 1).alias("files"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = files.select("part", F.coalesce(F.sum("files").over(before), F.lit(0)).alias("shift"))
    joined = staged.join(F.broadcast(shifts), "part")
    return joined.select("row", (F.col("shift") + F.col("number")).cast("int").alias("file"))


def write_json_lines(
    df: DataFrame,
    path: str,
    *,
    max_bytes: int | None = None,
    daily: bool = True,
    run_date: str | None = None,
) -> None:
    """Appends JSON lines, by default to a folder per day. With a cap no file is larger than
    ``max_bytes``, but for a record that alone is; each file is written by a task of its own."""
    if daily:
        day = run_date or datetime.now(timezone.utc).strftime("%Y%m%d")
        path = f"{path}/{RUN_DATE}={day}"
    if max_bytes:
        rows = numbered_files(df, max_bytes)
        count = (rows.agg(F.max("file")).head()[0] or 0) + 1
        df = rows.repartitionById(count, "file").select("row.*")
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """The one summary row as one JSON file."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def metric_lines(totals: DataFrame, table: str) -> DataFrame:
    """Text exposition lines of one totals row."""

    def line(name: str, value: Column, column: Column | None = None) -> Column:
        labels = [F.lit(f'{name}{{table="{table}"')]
        if column is not None:
            labels += [F.lit(',column="'), column, F.lit('"')]
        return F.concat(*labels, F.lit("} "), value.cast("string"))

    def per_column(name: str, counts: str) -> Column:
        entries = F.map_entries(F.coalesce(counts, F.create_map().cast("map<string,bigint>")))
        return F.transform(entries, lambda e: line(name, e["value"], e["key"]))

    return totals.select(
        F.explode(
            F.concat(
                F.array(
                    line(ROWS_METRIC, F.col("rows_total")),
                    line(GATED_METRIC, F.col("quality_gate_chunks")),
                ),
                per_column(CHANGED_METRIC, "changed_totals"),
                per_column(NULL_DELTA_METRIC, "null_delta_totals"),
            )
        ).alias("value")
    )


def write_metrics(lines: DataFrame, path: str) -> None:
    lines.coalesce(1).write.mode("append").text(path)

"""Running a folder of SQL files over the loaded tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_sql_files(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """Name and text of the ``.sql`` files, by name. A folder of queries is small."""
    files = (
        spark.read.option("wholetext", "true")
        .option("pathGlobFilter", "*.sql")
        .text(folder)
        .select(F.regexp_extract("_metadata.file_path", "([^/]+)$", 1).alias("name"), "value")
    )
    return [(r.name, r.value) for r in files.orderBy("name").collect()]


def run_sql_folder(
    spark: SparkSession, folder: str, tables: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Runs each file in name order against the tables; the first error stops the run."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return {
        name: spark.sql(text.strip().rstrip(";")) for name, text in read_sql_files(spark, folder)
    }

"""Loads that read only new or changed files.

The manifest is a table of the files of earlier loads: path, length, time, checksum and the run
that loaded them. A load compares the folder with it, reads the files that are not listed as they
are now, and publishes their rows at its end; a load that fails publishes nothing, so the next one
reads the same files again.

Files are compared by path, length and time, and with ``checksum`` also by their content, which
then is read to be hashed (a file of over 2 GB can't be). A changed file is read whole again. A
file that changes after it was listed is listed with its old time, so the next run reads it again.
Files that are gone stay in the manifest. Files of no bytes have no rows and are not listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, length long, modified timestamp, checksum string, run string"
KEYS = ("path", "length", "modified", "checksum")


def listed(spark: SparkSession, folder: str, pattern: str = "*", checksum: bool = False) -> DataFrame:
    """One row per file below ``folder`` whose name fits ``pattern``. Contents are read for
    checksums only."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    digest = F.sha2("content", 256) if checksum else F.lit(None).cast("string")
    return files.select("path", "length", F.col("modificationTime").alias("modified"), digest.alias("checksum"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The rows published so far; none before the first load."""
    try:
        return spark.read.schema(SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def pending(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that no load has read as they are now."""
    f, m = files.alias("f"), manifest.alias("m")
    same = F.lit(True)
    for key in KEYS:
        same &= F.col(f"f.{key}").eqNullSafe(F.col(f"m.{key}"))
    return f.join(m, same, "left_anti")


def load_new(
    spark: SparkSession,
    folder: str,
    manifest: str,
    run: str,
    load: Callable[[list[str]], None],
    pattern: str = "*",
    checksum: bool = False,
) -> int:
    """Calls ``load`` with the paths of new and changed files, then publishes them under the name
    ``run``; returns their number. Paths go through the driver, which lists them for the scan too."""
    files = listed(spark, folder, pattern, checksum)
    rows = pending(files, read_manifest(spark, manifest)).collect()
    if not rows:
        return 0
    load(sorted(r.path for r in rows))
    published = spark.createDataFrame([(*r, run) for r in rows], SCHEMA)
    published.coalesce(1).write.mode("append").parquet(manifest)
    return len(rows)

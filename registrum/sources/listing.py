"""Snapshots and links of page listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SNAPSHOT = r"^(\d{4}-\d{2})/$"
LINK = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["']?([^"'\s>]*)"""


def snapshots(df: DataFrame, entry: str) -> DataFrame:
    """Distinct snapshot names among the entries, e.g. '2025-11/' -> '2025-11'."""
    name = F.regexp_extract(entry, SNAPSHOT, 1)
    return df.select(F.nullif(name, F.lit("")).alias("snapshot")).dropna().distinct()


def latest_snapshot(df: DataFrame, entry: str) -> DataFrame:
    """One row: the greatest snapshot, null when there is none."""
    return snapshots(df, entry).agg(F.max("snapshot").alias("snapshot"))


def new_snapshot(df: DataFrame, entry: str, processed: str | None) -> DataFrame:
    """The greatest snapshot unless it is the one already processed."""
    latest = latest_snapshot(df, entry).dropna()
    return latest.where(~F.col("snapshot").eqNullSafe(F.lit(processed)))


def rows_of_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows of the greatest value; on a partition column only its files are read."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def links(
    pages: DataFrame, html: str, base: Column, suffix: str = ".zip"
) -> DataFrame:
    """Links that end with ``suffix``, resolved against the base address of the page."""
    found = pages.withColumn(
        "href", F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
    ).withColumn("href", F.replace(F.col("href"), F.lit("&amp;"), F.lit("&")))
    wanted = (F.col("href") != "") & F.lower("href").endswith(suffix.lower())
    joined = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"), F.col("href"))
    url = F.when(F.col("href").startswith("http"), F.col("href")).otherwise(joined)
    return found.where(wanted).withColumn("link", url)

"""Lookup files with a header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Column sets that make a lookup usable.
POSTAL_COLUMNS = (
    ("cep", "uf", "municipio_codigo"),
    ("cep_prefix", "uf", "municipio_codigo"),
)
CITY_COLUMNS = (("municipio_nome", "municipio_codigo"),)


def accept(df: DataFrame, required: Sequence[Sequence[str]]) -> DataFrame | None:
    """The frame when it has all columns of one of the sets, else None."""
    present = set(df.columns)
    return df if any(set(columns) <= present for columns in required) else None


def read_lookup(
    spark: SparkSession, path: str | None, required: Sequence[Sequence[str]]
) -> DataFrame | None:
    """A CSV lookup as text columns; None when there is no usable file."""
    if not path:
        return None
    try:
        df = spark.read.option("header", "true").csv(path)
    except AnalysisException:
        return None
    return accept(df, required)

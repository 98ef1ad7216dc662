"""Registry data quality on Spark: DataFrame in, DataFrame out."""

from registrum.options import Options
from registrum.specs import TABLES, TableSpec

__all__ = ["Options", "TABLES", "TableSpec"]

"""Header-less delimited text, by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.options import NA_TOKENS, Options
from registrum.specs import TableSpec

FILE = "_file"
CORRUPT = "_corrupt"
LINE = "line"


def csv_options(opts: Options, sep: str = ";") -> dict[str, str]:
    return {
        "sep": sep,
        "header": "false",
        "quote": '"',
        "escape": '"',
        "encoding": opts.encoding,
        "multiLine": str(opts.multi_line).lower(),
        "mode": "PERMISSIVE",
        # Fields of a line are counted against all columns, also when few are selected.
        "columnPruning": "false",
        "columnNameOfCorruptRecord": CORRUPT,
    }


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def corrupt_text(schema: T.StructType) -> Column:
    """The corrupt-record column, tied to a data column: Spark refuses a query that reads
    nothing else of a file, such as a count of the well-formed lines."""
    tie = F.length(F.concat_ws("", F.col(schema.names[0]))) >= 0
    return F.when(tie, F.col(CORRUPT)).alias(CORRUPT)


def tokens_to_null(
    df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = NA_TOKENS
) -> DataFrame:
    """Null tokens become null in one projection; no tokens, no change."""
    if not tokens:
        return df
    return df.withColumns(
        {c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c in columns if c in df.columns}
    )


def field_count(line: Column, sep: str = ";", quote: str = '"') -> Column:
    """Fields of a line: separators outside quotes, plus one."""
    bare = F.regexp_replace(line, f"{quote}[^{quote}]*{quote}", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    opts: Options = Options(),
    sep: str = ";",
    glob: str | None = None,
) -> DataFrame:
    """All files as one table of text columns, with ``_file`` and ``_corrupt``.

    The reader drops a byte-order mark and takes both line ends. Short lines are padded
    with nulls; ``_corrupt`` holds the text of lines that are short or long.
    """
    reader = spark.read.schema(with_corrupt(schema)).options(**csv_options(opts, sep))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    named = df.select(
        *schema.names, corrupt_text(schema), F.col("_metadata.file_path").alias(FILE)
    )
    return tokens_to_null(named, schema.names, opts.na_tokens)


def overlong(width: int, sep: str = ";") -> Column:
    """Whether a line had more fields than columns; short lines are legal."""
    return F.col(CORRUPT).isNotNull() & (field_count(F.col(CORRUPT), sep) > width)


def well_formed(df: DataFrame, width: int, sep: str = ";") -> DataFrame:
    return df.where(~overlong(width, sep)).drop(CORRUPT)


def malformed(df: DataFrame, width: int, sep: str = ";") -> DataFrame:
    """Text of the overlong lines, for quarantine."""
    return df.where(overlong(width, sep)).select(FILE, F.col(CORRUPT).alias(LINE))


def read_table(
    spark: SparkSession, spec: TableSpec, paths: str | Sequence[str], opts: Options = Options()
) -> DataFrame:
    """A registry table as text, derived columns added as null, overlong lines left out."""
    df = well_formed(
        read_delimited(spark, paths, spec.read_schema(), opts), len(spec.source_columns)
    )
    return df.withColumns({c: F.lit(None).cast("string") for c in spec.derived})


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Undecoded lines and their file."""
    df = spark.read.text(list(paths) if not isinstance(paths, str) else paths)
    return df.select(F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE))


def decode_lines(lines: DataFrame, default: str = "ISO-8859-1") -> DataFrame:
    """Decodes each file as UTF-8 when all its lines are valid, else as ``default``.

    The verdicts are one row per file; rows are counted per file before the shuffle.
    """
    verdict = lines.groupBy(FILE).agg(F.bool_and(F.is_valid_utf8(LINE)).alias("_utf8"))
    plain = F.regexp_replace(F.col(LINE), "^\ufeff", "")
    other = F.decode(F.col(LINE).cast("binary"), default)
    text = F.when(F.col("_utf8"), plain).otherwise(other)
    return lines.join(verdict, FILE).withColumn(LINE, text).drop("_utf8")


def parse_lines(
    lines: DataFrame, schema: T.StructType, opts: Options = Options(), sep: str = ";"
) -> DataFrame:
    """Fields of decoded lines; the other columns are kept."""
    csv = {k: v for k, v in csv_options(opts, sep).items() if k != "encoding"}
    ddl = ", ".join(f"`{f.name}` string" for f in with_corrupt(schema).fields)
    rest = [c for c in lines.columns if c != LINE]
    parsed = lines.select(*rest, F.from_csv(LINE, ddl, csv).alias("_row")).select(
        *rest, "_row.*"
    )
    return tokens_to_null(parsed, schema.names, opts.na_tokens)


def drop_bad_lines(lines: DataFrame, width: int, sep: str = ";") -> DataFrame:
    """Leaves out blank lines and lines without exactly ``width`` fields."""
    return lines.where(
        (F.trim(LINE) != "") & (field_count(F.col(LINE), sep) == width)
    )

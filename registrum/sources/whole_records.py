"""Records of delimited files whose quoted fields may hold line breaks, read in splits.

Whether a line begins inside a quoted field depends on everything before it in its file. A line
is therefore a function: the state it ends in, for either state it may begin in. Each task
composes the functions of the lines of its splits for both states; the functions of the splits,
one row each, are composed per file; a join then tells every line which of its two readings
holds. Lines of one record that spans several are gathered by record, all others stay where they are.

Besides its text a record gets its place in the file, counted over records from 0. It does not
depend on how the file was split.

A quote that is open at the end of a file never closes: its line is rejected and the lines after
it are records of their own (they hold no quote that could close it, so each is whole). A record of
more than ``max_lines`` lines is rejected too, line by line. Nothing is dropped but blank lines outside
quotes, which the CSV reader drops as well.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registrum.options import Options
from registrum.sources.delimited import FILE, LINE, overlong, parse_lines
from registrum.specs import TableSpec

POSITION = "_position"
REJECTED = "_rejected"
REASON = "_reject_reason"
OPEN_QUOTE, LONG_RECORD, OVERLONG = "open_quote", "long_record", "malformed_line"
MAX_LINES = 10_000


def _ends_open(bare: Column, sep: str) -> Column:
    """Whether a line that begins outside quotes ends inside. A quote opens at the start of a
    field only; what follows a closing quote belongs to the field. ``bare`` is without doubled
    quotes: a run of quotes counts by its parity alone, inside a field and at its start."""
    field = f'(?:"[^"]*+"[^{sep}]*+|[^"{sep}][^{sep}]*+|)'
    return bare.rlike(f'^(?:{field}{sep})*+"[^"]*+$')


def _line_function(line: Column, sep: str) -> Column:
    """Two bits: ends inside if begun outside, ends inside if begun inside."""
    bare = F.replace(line, F.lit('""'), F.lit(""))
    rest = F.regexp_replace(bare, f'^[^"]*+"[^{sep}]*+', "")
    after = F.when(~bare.contains('"'), True).otherwise(
        rest.startswith(sep) & _ends_open(F.substring(rest, F.lit(2), F.length(rest)), sep)
    )
    bits = F.when(_ends_open(bare, sep), 1).otherwise(0) + F.when(after, 2).otherwise(0)
    # Most lines have no quote and keep the state.
    return F.when(line.contains('"'), bits).otherwise(2).cast("tinyint")


def open_at_end(line: Column, sep: str = ";") -> Column:
    """Whether a line that begins a record leaves a quote open."""
    return line.contains('"') & _ends_open(F.replace(line, F.lit('""'), F.lit("")), sep)


def _numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds, for either state a split may begin in, whether each line begins a record, the
    records begun up to it, and the state after it; and the number of the line in its split."""
    held: tuple | None = None
    for batch in batches:
        files, blocks = batch.column("file"), batch.column("block").to_numpy()
        codes, blank = batch.column("code").to_numpy(), batch.column("blank").to_numpy(zero_copy_only=False)
        n = batch.num_rows
        if not n:
            continue
        # Splits follow one another; a new one begins where the file or the offset changes.
        named = files.dictionary_encode().indices.to_numpy()
        change = np.flatnonzero((named[1:] != named[:-1]) | (blocks[1:] != blocks[:-1])) + 1
        bounds = [0, *change.tolist(), n]
        out = {name: np.empty(n, np.int64) for name in ("line", "n0", "n1")}
        flags = {name: np.empty(n, bool) for name in ("begins0", "begins1", "open0", "open1")}
        for start, stop in zip(bounds, bounds[1:]):
            key = (files[start].as_py(), int(blocks[start]))
            if held is None or held[0] != key:
                held = (key, 0, [0, 1], [0, 0])
            _, line, state, begun = held
            out["line"][start:stop] = np.arange(line, line + stop - start)
            code, empty = codes[start:stop].astype(np.int64), blank[start:stop]
            state, begun = list(state), list(begun)
            for s in (0, 1):
                after = _composed(code, state[s])
                before = np.concatenate([[state[s]], after[:-1]])
                begins = (before == 0) & ~empty
                flags[f"begins{s}"][start:stop], flags[f"open{s}"][start:stop] = begins, after == 1
                counted = begun[s] + np.cumsum(begins)
                out[f"n{s}"][start:stop] = counted
                state[s], begun[s] = int(after[-1]), int(counted[-1])
            held = (key, line + stop - start, state, begun)
        arrays = [pa.array(v) for v in (*out.values(), *flags.values())]
        yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *out, *flags])


def _composed(code: np.ndarray, state: int) -> np.ndarray:
    """The state after each line. A line sets the state, keeps it or turns it: after the last one
    that sets it, only the number of turns counts."""
    from_outside, from_inside = code & 1, code >> 1
    sets = from_outside == from_inside
    turns = np.cumsum((from_outside == 1) & (from_inside == 0))
    last = np.maximum.accumulate(np.where(sets, np.arange(len(code)), -1))
    value = np.where(last >= 0, from_outside[last], state)
    since = turns - np.where(last >= 0, turns[last], 0)
    return value ^ (since & 1)


def _placed_splits(splits: DataFrame) -> DataFrame:
    """file, block, inside (the state the split begins in), base (records begun before it), base_line, and
    for files that end inside a quote the record and line where it opens. One group per file, one row per split."""

    def place(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["block"])
        state = base = base_line = 0
        opened = -1
        out = []
        for r in rows:
            out.append((r["file"], r["block"], bool(state), base, base_line))
            last = r[f"last{state}"]
            opened = opened if last is None else base_line + last
            base, base_line = base + r[f"n{state}"], base_line + r["lines"]
            state = int(r[f"open{state}"])
        columns = [*zip(*out)]
        record = base - 1 if state else None
        return pa.table(
            {
                "file": pa.array(columns[0]),
                "block": pa.array(columns[1], pa.int64()),
                "inside": pa.array(columns[2]),
                "base": pa.array(columns[3], pa.int64()),
                "base_line": pa.array(columns[4], pa.int64()),
                "open_record": pa.array([record] * len(out), pa.int64()),
                "open_line": pa.array([opened if state else None] * len(out), pa.int64()),
            }
        )

    schema = "file string, block long, inside boolean, base long, base_line long, open_record long, open_line long"
    return splits.groupBy("file").applyInArrow(place, schema)


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    encoding: str = "UTF-8",
    sep: str = ";",
    max_lines: int = MAX_LINES,
    glob: str | None = None,
) -> DataFrame:
    """``_file``, ``_position``, ``line`` (the record's text; null for rejects), ``_rejected`` (the
    text of a reject) and ``_reject_reason``. Lines end with LF or CRLF; a byte-order mark goes."""
    reader = spark.read.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    given = reader.text(list(paths) if not isinstance(paths, str) else paths)
    text = F.col("value")
    if encoding.upper().replace("-", "") not in ("UTF8",):
        text = F.decode(text.cast("binary"), encoding)
    lines = given.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), text.alias("value")
    )
    first = F.regexp_replace("value", "^(?:﻿|ï»¿)", "")
    lines = lines.withColumn("value", F.when(F.col("block") == 0, first).otherwise(F.col("value")))
    return records_of(lines, sep, max_lines)


def records_of(lines: DataFrame, sep: str = ";", max_lines: int = MAX_LINES) -> DataFrame:
    """Records of lines (``file``, ``block``, ``value``) that lie in their partitions split by split and in
    the order of the file; ``block`` orders the splits of a file."""
    coded = lines.withColumns(
        {"code": _line_function(F.col("value"), sep), "blank": F.coalesce(F.trim(F.regexp_replace("value", "\\s", "")) == "", F.lit(True))}
    )
    more = "line long, n0 long, n1 long, begins0 boolean, begins1 boolean, open0 boolean, open1 boolean"
    schema = f"file string, block long, value string, code tinyint, blank boolean, {more}"
    both = coded.mapInArrow(_numbered, schema)
    summary = coded.drop("value").mapInArrow(_numbered, schema.replace("value string, ", ""))
    splits = summary.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("lines"),
        *(F.max(c).alias(c) for c in ("n0", "n1")),
        *(F.max_by(c, "line").alias(c) for c in ("open0", "open1")),
        *(F.max(F.when(F.col(f"begins{s}"), F.col("line"))).alias(f"last{s}") for s in (0, 1)),
    )
    # The splits are few, a row each, as the driver's list of the files has them. The lines never go
    # there: of lines that come out of Python Spark knows no size, and it may take them for few.
    joined = both.join(F.broadcast(_placed_splits(splits)), ["file", "block"])

    def held(name: str) -> Column:
        return F.when(F.col("inside"), F.col(f"{name}1")).otherwise(F.col(f"{name}0"))

    known = joined.select(
        F.col("file").alias(FILE),
        (F.col("base_line") + F.col("line")).alias("at"),
        (F.col("base") + held("n") - 1).alias("record"),
        held("begins").alias("begins"),
        held("open").alias("open"),
        "blank",
        "value",
        "open_record",
        "open_line",
    )
    tail = F.coalesce(F.col("record") == F.col("open_record"), F.lit(False)) & (F.col("at") >= F.col("open_line"))
    known = known.withColumn("tail", F.coalesce(tail, F.lit(False)))
    opening = F.col("tail") & (F.col("at") == F.col("open_line"))
    record_end = F.regexp_replace("value", "\r$", "")
    none = F.lit(None).cast("string")

    def row(line: Column, rejected: Column, reason: Column, position: Column) -> list[Column]:
        return [F.col(FILE), position.cast("long").alias(POSITION), line.alias(LINE), rejected.alias(REJECTED), reason.alias(REASON)]

    alone = F.when(F.col("tail"), ~F.col("blank")).otherwise(F.col("begins") & ~F.col("open"))
    whole = known.where(alone)
    place = F.when(F.col("tail"), F.col("record") + F.col("at") - F.col("open_line")).otherwise(F.col("record"))
    singles = whole.select(
        *row(F.when(~opening, record_end), F.when(opening, record_end), F.when(opening, F.lit(OPEN_QUOTE)), place)
    )
    # A blank line outside quotes begins nothing and lies in no record; inside, the quote stays open.
    outside = F.col("blank") & ~F.col("open")
    parts = known.where(~F.col("tail") & F.when(F.col("begins"), F.col("open")).otherwise(~outside))
    sizes = parts.groupBy(FILE, "record").agg(F.count(F.lit(1)).alias("lines"))
    long = sizes.where(F.col("lines") > max_lines).select(FILE, "record")
    kept = parts.join(long, [FILE, "record"], "left_anti")
    gathered = kept.groupBy(FILE, "record").agg(
        F.array_sort(F.collect_list(F.struct("at", "value"))).alias("lines")
    )
    text = F.regexp_replace(F.array_join(F.col("lines.value"), "\n"), "\r$", "")
    several = gathered.select(*row(text, none, none, F.col("record")))
    rejects = parts.join(long, [FILE, "record"], "left_semi").select(
        *row(none, record_end, F.lit(LONG_RECORD), F.col("record"))
    )
    return singles.unionByName(several).unionByName(rejects)


def _matches(text: pa.Array, pattern: str) -> np.ndarray:
    return pc.match_substring_regex(text, pattern).to_numpy(zero_copy_only=False)


def _opens(bare: pa.Array, sep: str) -> np.ndarray:
    """``_ends_open`` of many lines. What follows each part of the pattern is told apart by its first
    character, so it needs no possessive groups, which Arrow does not know."""
    sep = re.escape(sep)
    return _matches(bare, f'^(?:(?:"[^"]*"[^{sep}]*|[^"{sep}][^{sep}]*|){sep})*"[^"]*$')


def _codes(bare: pa.Array, opens: np.ndarray, sep: str) -> np.ndarray:
    """``_line_function`` of many lines that are without doubled quotes."""
    rest = pc.replace_substring_regex(bare, f'^[^"]*"[^{re.escape(sep)}]*', "")
    again = pc.starts_with(rest, sep).to_numpy(zero_copy_only=False) & _opens(pc.utf8_slice_codeunits(rest, 1), sep)
    kept = ~pc.match_substring(bare, '"').to_numpy(zero_copy_only=False)
    return np.where(opens, 1, 0) + np.where(kept | again, 2, 0)


class _Held:
    """Lines of a record that has not ended yet. More than ``limit`` lines go to a file, since a quote that
    never closes holds all lines to the end of its file."""

    def __init__(self, limit: int) -> None:
        self.limit, self.count = limit, 0
        self.parts: list[pa.Array] = []
        self.file = self.writer = None

    def add(self, lines: pa.Array) -> None:
        self.count += len(lines)
        self.parts.append(lines)
        if self.count <= self.limit:
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
            self.writer = pa.ipc.new_stream(self.file, pa.schema([("value", pa.string())]))
        for part in self.parts:
            self.writer.write_batch(pa.RecordBatch.from_arrays([part], ["value"]))
        self.parts = []

    def taken(self) -> Iterator[pa.Array]:
        """All lines in their order; then none are held."""
        parts, file = self.parts, self.file
        if file is not None:
            self.writer.close()
        self.__init__(self.limit)
        if file is not None:
            with file:
                file.seek(0)
                for batch in pa.ipc.open_stream(file):
                    yield batch.column(0)
        yield from parts


RECORD = pa.schema([(POSITION, pa.int64()), (LINE, pa.string()), (REJECTED, pa.string()), (REASON, pa.string())])


def records_in_order(
    lines: Iterable[pa.Array], sep: str = ";", max_lines: int = MAX_LINES
) -> Iterator[pa.RecordBatch]:
    """``_position``, ``line``, ``_rejected`` and ``_reject_reason`` of all lines of one file, given in their
    order and without their ends: the records that ``records_of`` makes of a file. One pass; what is held is a batch
    and a record of at most ``max_lines`` lines."""
    inside, begun, held = 0, 0, _Held(max_lines)

    def rows(places: np.ndarray, texts: pa.Array, reason: str | None = None) -> pa.RecordBatch:
        none = pa.nulls(len(texts), pa.string())
        reasons = none if reason is None else pa.repeat(pa.scalar(reason), len(texts))
        columns = [texts, none, none] if reason is None else [none, texts, reasons]
        return pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), *columns], schema=RECORD)

    for value in lines:
        if not len(value):
            continue
        bare = pc.replace_substring(value, '""', "")
        opens = _opens(bare, sep)
        blank = _matches(value, "^[ \\t\\n\\x0b\\f\\r]*$")
        if not inside and not opens.any():  # as most batches are: every line is a record
            kept = value.filter(pa.array(~blank)) if blank.any() else value
            if len(kept):
                yield rows(np.arange(begun, begun + len(kept)), kept)
            begun += len(kept)
            continue
        after = _composed(_codes(bare, opens, sep), inside)
        before = np.concatenate([[inside], after[:-1]])
        begins = (before == 0) & ~blank
        record = begun + np.cumsum(begins) - 1
        alone = begins & (after == 0)
        if alone.any():
            yield rows(record[alone], value.filter(pa.array(alone)))
        # The lines of a record run from one that leaves a quote open to the next that leaves none.
        firsts = np.flatnonzero((before == 0) & (after == 1))
        lasts = np.flatnonzero((before == 1) & (after == 0))
        if inside:
            firsts = np.concatenate([[0], firsts])
        for n, first in enumerate(firsts.tolist()):
            ended = n < len(lasts)
            held.add(value.slice(first, (int(lasts[n]) + 1 if ended else len(value)) - first))
            if not ended:
                break
            place = record[lasts[n]]
            if held.count > max_lines:
                for part in held.taken():
                    yield rows(np.full(len(part), place), part, LONG_RECORD)
            else:
                text = "\n".join(line for part in held.taken() for line in part.to_pylist())
                yield rows(np.array([place]), pa.array([text]))
        inside, begun = int(after[-1]), int(record[-1]) + 1
    if inside:
        at = begun - 1
        for part in held.taken():
            if at == begun - 1:
                yield rows(np.array([at]), part.slice(0, 1), OPEN_QUOTE)
                at, part = at + 1, part.slice(1)
            kept = ~_matches(part, "^[ \\t\\n\\x0b\\f\\r]*$")
            yield rows(np.arange(at, at + len(part))[kept], part.filter(pa.array(kept)))
            at += len(part)


def read_rows(
    spark: SparkSession, spec: TableSpec, paths: str | Sequence[str], opts: Options = Options(), sep: str = ";"
) -> DataFrame:
    """A registry table as text with ``_file`` and ``_position``. Records that cannot be rows (more
    fields than columns, an open quote) are rows without values whose text is in ``_rejected``."""
    return rows_of(read_records(spark, paths, opts.encoding, sep), spec, opts, sep)


def rows_of(records: DataFrame, spec: TableSpec, opts: Options = Options(), sep: str = ";") -> DataFrame:
    """Fields of records, as ``read_rows`` gives them."""
    width = len(spec.source_columns)
    parsed = parse_lines(records, spec.read_schema(), opts, sep)
    wide = overlong(width, sep)
    bad = F.col(REJECTED).isNotNull() | wide
    values = [F.when(~bad, F.col(c)).alias(c) for c in spec.source_columns]
    derived = [F.lit(None).cast("string").alias(c) for c in spec.derived]
    return parsed.select(
        FILE,
        POSITION,
        *values,
        *derived,
        F.when(wide, F.col("_corrupt")).otherwise(F.col(REJECTED)).alias(REJECTED),
        F.when(wide, F.lit(OVERLONG)).otherwise(F.col(REASON)).alias(REASON),
    )

"""Zip archives: categories, integrity report, lines of their members.

A deflated member cannot be split, so one task streams it; archives and their members are
spread over tasks. Give many archives rather than one large one. Every member is judged before
its lines are read: a damaged one gives no line and a row in ``archive_rejects``.
"""

from __future__ import annotations

import codecs
import io
import posixpath
import zipfile
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registrum.session import write_and_reread
from registrum.sources.delimited import FILE, LINE
from registrum.sources.whole_records import POSITION, REASON, RECORD, REJECTED, records_in_order

NUMBER = "number"
UNKNOWN_CATEGORY = "desconhecido"
BATCH_LINES = 10_000
TASK_BYTES = 64 << 20
READ_BYTES = 1 << 20


def category(path: Column) -> Column:
    """Leading letters of the file name, lower case; without letters ``desconhecido``."""
    letters = F.lower(F.regexp_extract(path, r"(?:^|/)(\p{L}*)[^/]*$", 1))
    return F.coalesce(F.nullif(letters, F.lit("")), F.lit(UNKNOWN_CATEGORY))


def category_counts(paths: DataFrame, path: str = "path") -> DataFrame:
    return (
        paths.groupBy(category(F.col(path)).alias("category"))
        .agg(F.count(F.lit(1)).alias("files"))
    )


def list_files(spark: SparkSession, folder: str, glob: str = "*.zip") -> DataFrame:
    """Paths and sizes; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    scheme, sep, rest = path.partition(":")
    if sep and rest.startswith("/") and not rest.startswith("//"):
        path = f"{scheme}://{rest}"
    return pafs.FileSystem.from_uri(path)


def open_shared(path: str) -> io.BufferedIOBase:
    """Opens a file of any filesystem pyarrow knows, for random access."""
    fs, inner = filesystem(path)
    return fs.open_input_file(inner)


def safe_member(name: str) -> bool:
    """Whether a member stays below its target folder."""
    clean = posixpath.normpath(name.replace("\\", "/"))
    return not (clean.startswith(("/", "../")) or clean == ".." or clean[1:2] == ":")


def _checked(path: str) -> tuple[str, str | None]:
    try:
        with open_shared(path) as raw, zipfile.ZipFile(raw) as archive:
            bad = archive.testzip()
    except FileNotFoundError:
        return "missing", None
    except zipfile.BadZipFile:
        return "not a zip", None
    except Exception as error:  # a report row, so that one bad archive fails no job
        return f"unreadable: {type(error).__name__}", None
    return ("ok", None) if bad is None else ("bad member", bad)


def archive_report(paths: DataFrame) -> DataFrame:
    """``path, ok, status, bad_member`` for each path; every member is read and checked."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_checked(p) for p in batch["path"]]
            yield pd.DataFrame(
                {
                    "path": batch["path"],
                    "ok": [status == "ok" for status, _ in found],
                    "status": [status for status, _ in found],
                    "bad_member": [member for _, member in found],
                }
            )

    schema = "path string, ok boolean, status string, bad_member string"
    return paths.select("path").mapInPandas(check, schema)


def _damage(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> str | None:
    """Reads a member to its end, in pieces; what is wrong with it, if anything."""
    try:
        with archive.open(info) as data:
            while data.read(READ_BYTES):
                pass
    except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, OSError) as error:
        return f"damaged member: {type(error).__name__}"
    return None


def archive_entries(paths: DataFrame) -> DataFrame:
    """``path, member, size, reason, entry``: every member, and every archive that cannot be opened
    (with a null member). ``reason`` is null for members that can be read. ``entry`` is the member's
    number in its archive, since an archive may hold several members of one name."""

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                try:
                    with open_shared(path) as raw, zipfile.ZipFile(raw) as archive:
                        for entry, info in enumerate(archive.infolist()):
                            if info.is_dir():
                                continue
                            safe = safe_member(info.filename)
                            reason = _damage(archive, info) if safe else "unsafe member"
                            rows.append((path, info.filename, info.file_size, reason, entry))
                except FileNotFoundError:
                    rows.append((path, None, None, "missing", None))
                except (zipfile.BadZipFile, ValueError):  # too short a file gives a ValueError
                    rows.append((path, None, None, "not a zip", None))
                except OSError as error:  # a reject row, so that one unreadable file ends no job
                    rows.append((path, None, None, f"unreadable: {type(error).__name__}", None))
            frame = pd.DataFrame(rows, columns=["path", "member", "size", "reason", "entry"])
            yield frame.astype({"size": "Int64", "entry": "Int64"})

    schema = "path string, member string, size long, reason string, entry long"
    return paths.select("path").mapInPandas(entries, schema)


def archive_members(paths: DataFrame) -> DataFrame:
    """``path, member, size, entry`` of the members that can be read."""
    return archive_entries(paths).where("reason is null").drop("reason")


def archive_rejects(paths: DataFrame) -> DataFrame:
    """``path, member, reason`` of what ``archive_members`` leaves out."""
    return archive_entries(paths).where("reason is not null").select("path", "member", "reason")


def member_lines(members: DataFrame, encoding: str = "latin-1", tasks: int | None = None) -> DataFrame:
    """``path, member, line_no, line`` of every member, streamed in small batches. A member is read
    by its number where ``entry`` names it; ``_file`` then tells members of one name apart. The list of
    members is small however much they hold, so adaptive execution may read them all in one task;
    ``tasks`` deals them out to that many."""
    if "entry" not in members.columns:
        members = members.withColumn("entry", F.lit(None).cast("long"))

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, member, entry in zip(batch["path"], batch["member"], batch["entry"]):
                yield from _streamed(path, member, None if pd.isna(entry) else int(entry), encoding)

    schema = f"path string, member string, line_no long, {LINE} string, {FILE} string"
    listed = members.select("path", "member", "entry")
    spread = listed.repartition(tasks) if tasks else listed.repartition("path", "member", "entry")
    return spread.mapInPandas(lines, schema)


def reading_tasks(members: int, size: int, cores: int) -> int:
    """Tasks for so many members with so many bytes: one per core or more, none without a member."""
    return max(1, min(members, max(cores, -(-size // TASK_BYTES))))


def _frame(path: str, member: str, label: str, first: int, lines: list[str]) -> pd.DataFrame:
    numbers = range(first, first + len(lines))
    return pd.DataFrame({"path": path, "member": member, "line_no": numbers, LINE: lines, FILE: f"{path}!{label}"})


def _streamed(path: str, member: str, entry: int | None, encoding: str) -> Iterator[pd.DataFrame]:
    with open_shared(path) as raw, zipfile.ZipFile(raw) as archive:
        every = archive.infolist()
        info = archive.getinfo(member) if entry is None else every[entry]
        again = entry is not None and any(e.filename == member for e in every[:entry])
        label = f"{member}#{entry}" if again else member
        with archive.open(info) as data:
            buffer, first = [], 1
            marked = data.peek(3)[:3] == b"\xef\xbb\xbf"
            for line in io.TextIOWrapper(data, "utf-8-sig" if marked else encoding, newline=None):
                buffer.append(line.rstrip("\n"))
                if len(buffer) == BATCH_LINES:
                    yield _frame(path, member, label, first, buffer)
                    first, buffer = first + len(buffer), []
            if buffer:
                yield _frame(path, member, label, first, buffer)


def line_batches(data: io.BufferedIOBase, encoding: str) -> Iterator[pa.Array]:
    """The lines of a stream without their ends, some for each piece of ``READ_BYTES``. They end with LF, CR or CRLF."""
    marked = data.peek(3)[:3] == b"\xef\xbb\xbf"
    decoder = codecs.getincrementaldecoder("utf-8-sig" if marked else encoding)()
    decoder = io.IncrementalNewlineDecoder(decoder, translate=True)
    begun: list[str] = []
    last = False
    while not last:
        piece = data.read(READ_BYTES)
        last = not piece
        text = decoder.decode(piece, final=last)
        end = text.rfind("\n") + 1
        if end:
            body = "".join([*begun, text[:end]]).encode()
            begun = []
            # One buffer of all lines: the ends are taken out, and each line moves up by the ends before it.
            ends = np.flatnonzero(np.frombuffer(body, np.uint8) == 10)
            offsets = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
            yield pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(body.replace(b"\n", b"")))
        begun.append(text[end:])
    rest = "".join(begun)
    if rest:
        yield pa.array([rest])


def numbered_members(entries: DataFrame) -> DataFrame:
    """Adds ``_file``, which tells the members of one name in an archive apart, and a number. Write the result before
    use: the numbers are not the same when they are given again."""
    first = F.min("entry").over(Window.partitionBy("path", "member"))
    again = F.when(F.col("entry") > first, F.concat(F.lit("#"), F.col("entry").cast("string"))).otherwise("")
    named = entries.withColumn(FILE, F.concat("path", F.lit("!"), "member", again))
    return named.withColumn(NUMBER, F.monotonically_increasing_id())


def member_records(members: DataFrame, encoding: str = "latin-1", tasks: int | None = None, sep: str = ";") -> DataFrame:
    """Records of members as ``numbered_members`` gives them, once written; columns as of ``records_of``. A task reads its members
    from their start to their end, so it knows which lines begin inside a quote: one pass. The records carry the number of
    their member only; the members, a row each, are broadcast to name it."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, path, entry in zip(*(batch.column(c).to_pylist() for c in (NUMBER, "path", "entry"))):
                with open_shared(path) as raw, zipfile.ZipFile(raw) as archive:
                    with archive.open(archive.infolist()[entry]) as data:
                        for found in records_in_order(line_batches(data, encoding), sep):
                            numbers = pa.repeat(pa.scalar(number, pa.int64()), len(found))
                            yield pa.RecordBatch.from_arrays([numbers, *found.columns], [NUMBER, *RECORD.names])

    schema = f"{NUMBER} long, {POSITION} long, {LINE} string, {REJECTED} string, {REASON} string"
    listed = members.select(NUMBER, "path", "entry")
    spread = listed.repartition(tasks) if tasks else listed.repartition(NUMBER)
    named = spread.mapInArrow(records, schema).join(F.broadcast(members.select(NUMBER, FILE)), NUMBER)
    return named.select(FILE, POSITION, LINE, REJECTED, REASON)


def read_archives(
    spark: SparkSession, folder: str, encoding: str = "latin-1"
) -> tuple[DataFrame, DataFrame]:
    """Lines of all archives of a folder, with the category of each archive; and what was rejected.

    The members are judged once and written, so both frames rest on the same verdicts.
    """
    entries = write_and_reread(archive_entries(list_files(spark, folder)), "archive-entries")
    lines = member_lines(entries.where("reason is null"), encoding)
    rejects = entries.where("reason is not null").select("path", "member", "reason")
    return lines.withColumn("category", category(F.col("path"))), rejects

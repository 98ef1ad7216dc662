"""Web archives: writing, reading back, and one index of all captures in global order.

Writing: of records with equal payloads of at least ``least`` bytes the one with the smallest
page id is a response, the others revisit it; smaller payloads are always responses. Each task
writes its rows to files of its own, one gzip member per record, and returns their names; a file
of a task that was lost is named by nobody, so readers never see it.

Reading: a task streams its archives record by record and puts out its captures (URL key,
timestamp, place, type, payload digest), sorted by key and time: a sorted run, one file each.

Merging: the key space is cut into slices of about ``SLICE_ROWS`` captures at keys that a range
partitioning finds; the cuts include time and place, so a URL or host with a third of all captures
spans many slices. For a slice, a task opens every run, skips row groups outside the slice and
merges with a loser tree. More than ``FAN_IN`` runs are merged in several passes.

Null html is an empty payload, a null url has an empty URL key, a null page id never becomes the
one that others revisit unless no other has one. Repeated rows are all responses. An empty table
gives an empty index.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrum.llm.loser_tree import merge
from registrum.session import fresh_path, write_and_reread

LEAST = 100
FILE_BYTES = 64 << 20
SLICE_ROWS = 20_000
FAN_IN = 256
PRINTABLE = "".join(map(chr, range(33, 127)))
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
INDEX = (
    "urlkey string, timestamp string, file string, offset long, page_id long, url string, "
    "record_type string, payload_bytes long, payload_digest string, refers_to long"
)
ORDER = ["urlkey", "timestamp", "file", "offset"]


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI; plain paths are local to all (a shared mount)."""
    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


def url_key(url: str) -> str:
    """Host labels in reverse, then path and query in lower case: com,example)/a?b."""
    match = re.match(r"[^:/?#]*://([^/?#]*)([^#]*)", url)
    if not match:
        return url.lower()
    host = match[1].lower().rpartition("@")[2].removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (match[2].lower() or "/")


def with_revisits(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, html, digest and refers_to. Bodies meet only rows of their own page id, so
    a payload that a third of all pages share makes no task large."""
    own = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = own.withColumn("digest", F.sha2("html", 256))
    narrow = own.where(F.octet_length("html") >= least).select("digest", "page_id")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = write_and_reread(first.where("n > 1 and first is not null").select("digest", "first"), "payloads")
    again = narrow.join(first, "digest").where("page_id is null or page_id > first").distinct()
    again = write_and_reread(again.withColumnRenamed("page_id", "page"), "revisits")
    joined = own.join(again.withColumnRenamed("digest", "_d"), F.col("page_id").eqNullSafe(F.col("page")) & (F.col("digest") == F.col("_d")), "left")
    return joined.select("page_id", "url", "html", "digest", F.col("first").alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    date = EPOCH + timedelta(seconds=(page_id or 0) % (1 << 31))
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}>",
        f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        # White space and line breaks would end the header, other characters are not of a URI.
        head.append("WARC-Target-URI: " + urllib.parse.quote(url, safe=PRINTABLE))
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(pages: DataFrame, folder: str | None = None, least: int = LEAST) -> DataFrame:
    """Writes the archives; one row (file, records) per archive, itself written."""
    folder = folder or fresh_path(pages.sparkSession, "archives")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = opened(folder)
        out, name, count = None, "", 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                for row in batch.slice(start, 256).to_pylist():
                    if out is None:
                        fs.create_dir(base, recursive=True)
                        name, count = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    whole = record(row["page_id"], row["url"], row["html"].encode(), row["digest"], row["refers_to"])
                    out.write(gzip.compress(whole, 6, mtime=0))
                    count += 1
                    if out.tell() >= FILE_BYTES:
                        out.close()
                        out = None
                        yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "records": count}])
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": f"{folder}/{name}", "records": count}])

    return write_and_reread(with_revisits(pages, least).mapInArrow(run, "file string, records long"), "archive-list")


def members(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member."""
    inflate, parts, offset, read = zlib.decompressobj(31), [], 0, 0
    data = b""
    while True:
        if not data:
            data = stream.read(1 << 20)
            read += len(data)
        if not data:
            if parts:
                raise ValueError("an archive ends within a record")
            return
        parts.append(inflate.decompress(data))
        data = inflate.unused_data
        if inflate.eof:
            yield offset, b"".join(parts)
            offset = read - len(data)
            inflate, parts = zlib.decompressobj(31), []


def capture(file: str, offset: int, content: bytes) -> dict:
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    page = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
    url = fields.get("WARC-Target-URI")
    out = {
        "urlkey": url_key(url or ""), "timestamp": re.sub(r"\D", "", fields["WARC-Date"]), "file": file,
        "offset": offset, "page_id": None if page == "none" else int(page), "url": url,
        "record_type": fields["WARC-Type"],
    }
    if out["record_type"] == "response":
        digest = hashlib.sha256(payload).hexdigest()
        if "sha256:" + digest != fields["WARC-Payload-Digest"]:
            raise ValueError(f"payload of {page} in {file} is damaged")
        return out | {"payload_bytes": len(payload), "payload_digest": digest, "refers_to": None}
    size = re.search(rb"Content-Length: (\d+)", http)[1]
    refers = fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    return out | {"payload_bytes": int(size), "payload_digest": digest, "refers_to": int(refers)}


def _schema(df: DataFrame) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in df.dtypes])


def read_runs(archives: DataFrame) -> DataFrame:
    """The captures of all archives; each of its files is a sorted run."""
    spark = archives.sparkSession
    schema = _schema(spark.createDataFrame([], INDEX))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                fs, path = opened(file)
                rows = []
                with fs.open_input_stream(path, compression=None) as stream:
                    for offset, content in members(stream):
                        rows.append(capture(file, offset, content))
                        if len(rows) == 2048:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    found = archives.select("file").mapInArrow(run, INDEX).sortWithinPartitions(*ORDER)
    return write_and_reread(found, "runs")


def _between(file: str, low: tuple | None, high: tuple | None) -> Iterator[tuple[tuple, dict]]:
    """Rows of a sorted file with low <= key < high, a row group at a time."""
    fs, path = opened(file)
    with fs.open_input_file(path) as source:
        parquet = pq.ParquetFile(source)
        for group in range(parquet.num_row_groups):
            stats = parquet.metadata.row_group(group).column(0).statistics
            if stats is not None and stats.has_min_max:
                if high is not None and stats.min > high[0]:
                    return
                if low is not None and stats.max < low[0]:
                    continue
            for batch in parquet.iter_batches(1024, row_groups=[group]):
                for row in batch.to_pylist():
                    key = tuple(row[c] for c in ORDER)
                    if high is not None and key >= high:
                        return
                    if low is None or key >= low:
                        yield key, row


def merged(runs: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """All captures in global order: by ``slice``, and by ``place`` within it."""
    spark = runs.sparkSession
    total = runs.count()
    count = max(1, -(-total // slice_rows))
    cuts: list[tuple | None] = [None]
    if count > 1:
        # One row per slice.
        heads = runs.select(F.struct(*ORDER).alias("key")).repartitionByRange(count, "key")
        heads = heads.groupBy(F.spark_partition_id().alias("part")).agg(F.min("key").alias("key"))
        cuts += sorted(tuple(r.key) for r in heads.collect())[1:]
    files = [urllib.parse.unquote(f) for f in runs.inputFiles()]
    scratch = fresh_path(spark, "merged-runs")
    bounds = list(zip(cuts, [*cuts[1:], None]))
    schema = _schema(runs)

    def tasks(work: list[tuple[int, list[str]]]) -> DataFrame:
        rows = [(number, group) for number, group in work]
        return spark.createDataFrame(rows, "slice int, files array<string>").repartition(len(rows))

    def to_file(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                fs, base = opened(scratch)
                fs.create_dir(base, recursive=True)
                name = f"{uuid.uuid4().hex}.parquet"
                found = merge([_between(f, *bounds[row["slice"]]) for f in row["files"]])
                with fs.open_output_stream(f"{base}/{name}") as sink, pq.ParquetWriter(sink, schema) as out:
                    held: list[dict] = []
                    for item in found:
                        held.append(item)
                        if len(held) == 8192:
                            out.write_table(pa.Table.from_pylist(held, schema))
                            held = []
                    out.write_table(pa.Table.from_pylist(held, schema))
                made = {"slice": row["slice"], "file": f"{scratch}/{name}"}
                yield pa.RecordBatch.from_pylist([made], pa.schema([("slice", pa.int32()), ("file", pa.string())]))

    def to_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([pa.field("slice", pa.int32()), pa.field("place", pa.int64()), *schema])
        for batch in batches:
            for row in batch.to_pylist():
                held: list[dict] = []
                found = merge([_between(f, *bounds[row["slice"]]) for f in row["files"]])
                for place, item in enumerate(found):
                    held.append({"slice": row["slice"], "place": place} | item)
                    if len(held) == 2048:
                        yield pa.RecordBatch.from_pylist(held, out)
                        held = []
                yield pa.RecordBatch.from_pylist(held, out)

    work = [(number, files) for number in range(len(bounds))] if files and total else []
    while work and max(len(group) for _, group in work) > FAN_IN:
        parts = [(n, group[i : i + FAN_IN]) for n, group in work for i in range(0, len(group), FAN_IN)]
        made: dict[int, list[str]] = {}
        # A file name per task: as many as there are runs and slices, never captures.
        for r in write_and_reread(tasks(parts).mapInArrow(to_file, "slice int, file string"), "pass").collect():
            made.setdefault(r.slice, []).append(r.file)
        work = sorted(made.items())
    kind = f"slice int, place long, {INDEX}"
    if not work:
        return spark.createDataFrame([], kind)
    return tasks(work).mapInArrow(to_rows, kind)


def capture_index(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) to archives, reads them and merges their index."""
    return merged(read_runs(write_archives(pages, least=least)))

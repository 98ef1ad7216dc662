"""Quoted line breaks over splits, rejects by default, chunks that do not depend on partitions."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from registrum.options import Options
from registrum.plans.tables import build_all, build_table, read_folder
from registrum.sources.whole_records import (
    LONG_RECORD, OPEN_QUOTE, POSITION, REASON, REJECTED, read_records, read_rows,
)
from registrum.specs import ESTABLISHMENTS, REGIMES, TABLES
from registrum.streaming.ingest import ingest, ingested, stream_table

UTF8 = Options(encoding="UTF-8")


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    given = spark.conf.get(key)

    def use(size: int) -> None:
        spark.conf.set(key, size)

    yield use
    spark.conf.set(key, given)


def rows_of(df):
    return sorted((r["_file"].rsplit("/", 1)[1], r[POSITION], r.line, r[REJECTED], r[REASON]) for r in df.collect())


def expected(text: str) -> list[str]:
    """Records by a plain walk over the characters."""
    out, current, state = [], "", "start"
    i = 0
    while i < len(text):
        ch = text[i]
        if state == "inside":
            if ch == '"':
                if text[i + 1 : i + 2] == '"':
                    current += ch
                    i += 1
                else:
                    state = "field"
            current += text[i]
        elif ch == "\n":
            if current.strip():
                out.append(current.removesuffix("\r"))
            current, state = "", "start"
        else:
            if ch == '"' and state == "start":
                state = "inside"
            else:
                state = "start" if ch == ";" else "field"
            current += ch
        i += 1
    assert state != "inside"
    if current.strip():
        out.append(current.removesuffix("\r"))
    return out


@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_random_files_in_any_split(spark, tmp_path, small_splits, size):
    rng = random.Random(4)
    pieces = ['a', 'b"c', '"q"', '"two\nlines"', '"x""y"', '""', '""z', '"\n\n"', '";\n;"', "", "ü", '"a\r\nb"', '"""\n"""', "'"]
    wanted = []
    for n in range(6):
        lines = [";".join(rng.choices(pieces, k=rng.randint(1, 4))) for _ in range(60)]
        text = rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n"])
        (tmp_path / f"f{n}.csv").write_bytes(text.encode())
        wanted += [(f"f{n}.csv", i, r, None, None) for i, r in enumerate(expected(text))]
    small_splits(size)
    found = read_records(spark, str(tmp_path))
    if size < 100:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert rows_of(found) == sorted(wanted)


def test_fields_equal_the_csv_module(spark, tmp_path, small_splits):
    rng = random.Random(9)
    values = ["", "plain", "two\nlines", 'quo"te', "semi;colon", "\n", "ação", " blank "]
    rows = [[str(i), *rng.choices(values, k=6)] for i in range(80)]
    buffer = io.StringIO()
    csv.writer(buffer, delimiter=";", lineterminator="\n", quoting=csv.QUOTE_NONNUMERIC).writerows(rows)
    (tmp_path / "r.csv").write_bytes(buffer.getvalue().encode("latin-1"))
    small_splits(64)
    found = read_rows(spark, REGIMES, str(tmp_path), Options(na_tokens=()))
    got = [[r[c] for c in REGIMES.source_columns] for r in found.orderBy(POSITION).collect()]
    assert [[v or "" for v in r] for r in got] == rows
    assert found.where(F.col(REJECTED).isNotNull()).count() == 0


@pytest.mark.parametrize("size", [20, 1 << 20])
def test_rejects_lose_nothing(spark, tmp_path, small_splits, size):
    (tmp_path / "a.csv").write_text('1;A\n2;"open\n3;""\n\n4;C;""""\n')
    (tmp_path / "b.csv").write_text("1;" + '"' + "x\n" * 9 + '"\n2;B\n')
    (tmp_path / "c.csv").write_text("")
    small_splits(size)
    found = rows_of(read_records(spark, str(tmp_path), max_lines=5))
    assert [r for r in found if r[0] == "a.csv"] == [
        ("a.csv", 0, "1;A", None, None),
        ("a.csv", 1, None, '2;"open', OPEN_QUOTE),
        ("a.csv", 2, '3;""', None, None),
        ("a.csv", 4, '4;C;""""', None, None),
    ]
    long = [r for r in found if r[0] == "b.csv"]
    assert long[-1][1:] == (1, "2;B", None, None) and len(long) == 11
    assert {r[4] for r in long[:-1]} == {LONG_RECORD}


def regimes(n: int) -> list[str]:
    return [f"{i:08d};S;20200101;;N;;" for i in range(n)]


def test_default_quarantine_in_batch_and_stream(spark, tmp_path):
    (tmp_path / "in" / "simples").mkdir(parents=True)
    lines = [*regimes(30), "1;S;;;N;;;extra;more", '00000031;S;20200101;;N;"open;']
    (tmp_path / "in" / "simples" / "x.csv").write_text("\n".join(lines) + "\n")
    opts = Options(encoding="UTF-8", strict_membership=False)
    results = build_all(read_folder(spark, str(tmp_path / "in"), opts), opts)
    bad = results["simples"].quarantine.where("reason in ('malformed_line', 'open_quote')")
    assert sorted(r.reason for r in bad.collect()) == ["malformed_line", "open_quote"]
    assert results["simples"].clean.count() + bad.count() == len(lines)

    stream = stream_table(spark, TABLES["simples"], str(tmp_path / "in" / "simples"), opts)
    ingest(stream, TABLES["simples"], str(tmp_path / "out"), str(tmp_path / "cp"), {}, opts).awaitTermination()
    kept, quarantine = ingested(spark, str(tmp_path / "out")), ingested(spark, str(tmp_path / "out"), "quarantine")
    reasons = [r.reason for r in quarantine.where("reason <> 'critical_fields_null'").collect()]
    assert sorted(reasons) == ["malformed_line", "open_quote"]
    assert kept.count() + len(reasons) == len(lines)


@pytest.mark.parametrize("bad", [400, 40])
def test_gate_does_not_depend_on_partitions(spark, tmp_path, small_splits, bad):
    """Rows with bad addresses: withheld or loaded alike in 1 and in 40 partitions."""
    columns = ESTABLISHMENTS.source_columns
    given = {"cnpj_basico": "{:08d}", "cnpj_ordem": "0001", "cnpj_dv": "{:02d}"}

    def value(column: str, i: int):
        if column == "correio_eletronico":
            return "no address" if i < bad else "a@b.example"
        return given[column].format(i if column == "cnpj_basico" else i % 100) if column in given else None

    rows = [tuple(value(c, i) for c in columns) for i in range(400)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    opts = Options(strict_membership=False, chunk_size=1000)
    counts = {build_table(df.repartition(n), ESTABLISHMENTS, {}, opts).clean.count() for n in (1, 40)}
    assert counts == {0 if bad == 400 else 400}

    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "r.csv").write_text("".join(";".join(v or "" for v in r) + "\n" for r in rows))
    opts = Options(strict_membership=False, chunk_size=100, encoding="UTF-8")
    outcomes = set()
    for size, parts in ((1 << 20, None), (1000, None), (1000, 40)):
        small_splits(size)
        raw = read_rows(spark, ESTABLISHMENTS, str(folder), opts)
        raw = raw.repartition(parts) if parts else raw
        result = build_table(raw, ESTABLISHMENTS, {}, opts)
        records = sorted((r.chunk.rsplit("#", 1)[1], r.rows, r.gated) for r in result.telemetry.collect())
        outcomes.add((tuple(records), result.clean.count(), result.quarantine.count()))
    assert len(outcomes) == 1
    (records, kept, _), = outcomes
    assert [r[1] for r in records] == [100] * 4
    assert kept == (0 if bad == 400 else 300)


def test_members_of_one_name_and_tables_from_archives(spark, tmp_path):
    import warnings
    import zipfile

    from registrum.plans.tables import read_archived

    with warnings.catch_warnings(), zipfile.ZipFile(tmp_path / "Simples1.zip", "w") as archive:
        warnings.simplefilter("ignore")  # one name twice
        archive.writestr("a.csv", "\n".join(regimes(3)))
        archive.writestr("a.csv", '00000007;"S\r\n";;;N;;\n00000008;N;;;N;;\n')
        archive.writestr("../a.csv", "outside")
    (tmp_path / "Simples2.zip").write_bytes(b"no zip")
    opts = Options(strict_membership=False, encoding="latin-1")
    raw, rejects = read_archived(spark, str(tmp_path), opts)
    assert list(raw) == ["simples"]
    clean = build_all(raw, opts)["simples"].clean
    assert sorted(r.cnpj_basico for r in clean.collect()) == [f"{i:08d}" for i in (0, 1, 2, 7, 8)]
    assert sorted((r.member or "", r.reason) for r in rejects.collect()) == [("", "not a zip"), ("../a.csv", "unsafe member")]

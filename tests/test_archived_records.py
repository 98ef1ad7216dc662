"""Records of archive members: one pass over each member, with the records of the passes over splits."""

import io
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks.readers import write_archives
from registrum import session
from registrum.options import Options
from registrum.plans.tables import read_archived
from registrum.sources import archives
from registrum.sources.whole_records import (
    LONG_RECORD, OPEN_QUOTE, POSITION, REASON, REJECTED, records_in_order, records_of,
)

PIECES = ['"', '""', ";", "a", "b c", " ", "\t", "\x0b", "é", "\x85", '";"', ';"x', '"\n', "\n", "\n", "\r\n", "\r", '"\n"', "|"]


def random_text(rng: random.Random) -> str:
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(60)))


def lines_of(text: str) -> list[str]:
    return [line.rstrip("\n") for line in io.TextIOWrapper(io.BytesIO(text.encode()), "utf-8", newline=None)]


def one_pass(lines: list[str], size: int, sep: str = ";", max_lines: int = 10_000) -> list[tuple]:
    batches = (pa.array(lines[i : i + size], pa.string()) for i in range(0, len(lines), size))
    return sorted((r for b in records_in_order(batches, sep, max_lines) for r in zip(*b.to_pydict().values())), key=repr)


@pytest.mark.parametrize("max_lines", [2, 3, 10_000])
def test_one_pass_gives_the_records_of_the_splits(spark, max_lines):
    rng = random.Random(max_lines)
    files = [lines_of(random_text(rng)) for _ in range(400)]
    rows = [(str(n), 0, line) for n, lines in enumerate(files) for line in lines]
    df = spark.createDataFrame(rows, "file string, block long, value string").repartition("file")
    given = df.withColumn("at", F.monotonically_increasing_id()).sortWithinPartitions("file", "at").drop("at")
    ordered: dict[str, list[str]] = {}
    for r in given.collect():
        ordered.setdefault(r.file, []).append(r.value)
    expected: dict[str, list[tuple]] = {}
    for r in records_of(given, max_lines=max_lines).collect():
        expected.setdefault(r["_file"], []).append((r[POSITION], r.line, r[REJECTED], r[REASON]))
    reasons = {x[3] for found in expected.values() for x in found}
    assert OPEN_QUOTE in reasons and (LONG_RECORD in reasons) == (max_lines < 10_000)
    for file, lines in ordered.items():
        for size in (1, 2, 1000):
            assert one_pass(lines, size, max_lines=max_lines) == sorted(expected.get(file, []), key=repr), lines


def test_an_open_record_is_not_held_in_memory_whole():
    lines = ["a;b", 'c;"open', *(f"line {i}" for i in range(1000)), "", "last"]
    found = one_pass(lines, 7, max_lines=50)
    assert len(found) == 1003
    assert (1, None, 'c;"open', OPEN_QUOTE) in found and (1003, "last", None, None) in found
    closed = one_pass([*lines, 'end";x', "d;e"], 7, max_lines=50)
    assert [r for r in closed if r[3] is None] == [(0, "a;b", None, None), (2, "d;e", None, None)]
    assert sum(r[3] == LONG_RECORD and r[0] == 1 for r in closed) == 1004


def test_lines_do_not_depend_on_the_pieces_read(monkeypatch):
    rng = random.Random(5)
    for n in range(300):
        text = ("﻿" if n % 5 == 0 else "") + random_text(rng)
        for encoding in ("utf-8", "latin-1"):
            data = text.encode(encoding, "replace")
            marked = data[:3] == b"\xef\xbb\xbf"
            wrapped = io.TextIOWrapper(io.BytesIO(data), "utf-8-sig" if marked else encoding, newline=None)
            expected = [line.rstrip("\n") for line in wrapped]
            for size in (1, 3, 1000):
                monkeypatch.setattr(archives, "READ_BYTES", size)
                stream = io.BufferedReader(io.BytesIO(data))
                assert [x for b in archives.line_batches(stream, encoding) for x in b.to_pylist()] == expected


def test_members_are_read_once(spark, tmp_path, capsys):
    text = '00000001;S;;;N;;\r\n00000002;"N\r\n";;;S;;\r\n\r\n00000003;S;too;many;;;;;\r\n00000004;"open;;;;;\r\n00000005;S;;;N;;\r\n'
    for n in range(3):
        with zipfile.ZipFile(tmp_path / f"simples{n}.zip", "w") as archive:
            archive.writestr("d/x.csv", text)
    raw, _ = read_archived(spark, str(tmp_path), Options(strict_membership=False))
    capsys.readouterr()
    raw["simples"].explain()
    shown = capsys.readouterr().out
    assert shown.count("MapInArrow") + shown.count("MapInPandas") == 1
    rows = sorted((r["_file"][-16:], r[POSITION], r.cnpj_basico, r.opcao_pelo_simples, r[REJECTED], r[REASON])
                  for r in raw["simples"].collect())
    assert rows == [row for n in range(3) for row in [
        (f"les{n}.zip!d/x.csv", 0, "00000001", "S", None, None),
        (f"les{n}.zip!d/x.csv", 1, "00000002", "N\n", None, None),
        (f"les{n}.zip!d/x.csv", 2, None, None, "00000003;S;too;many;;;;;", "malformed_line"),
        (f"les{n}.zip!d/x.csv", 3, None, None, '00000004;"open;;;;;', OPEN_QUOTE),
        (f"les{n}.zip!d/x.csv", 4, "00000005", "S", None, None),
    ]]


def test_methods_are_short_while_tables_are_written(spark, request):
    key = session.METHOD_KEY
    request.addfinalizer(lambda given=spark.conf.get(key): spark.conf.set(key, given))
    for given, meanwhile in (("65535", "8000"), ("500", "500")):
        spark.conf.set(key, given)
        with pytest.raises(ValueError), session.short_methods(spark):
            assert spark.conf.get(key) == meanwhile
            raise ValueError
        assert spark.conf.get(key) == given


def test_archives_of_categories(spark, tmp_path):
    rows = [("A", "1;é"), ("B", '2;"x"'), (None, "3"), ("A", "4;")]
    path = f"{tmp_path}/zips"
    write_archives(spark.createDataFrame(rows, "c string, l string").coalesce(1), "c", "l", path)
    lines, rejects = archives.read_archives(spark, path)
    assert sorted((r.category, r.line_no, r.line) for r in lines.collect()) == [
        ("a", 1, "1;é"), ("a", 2, "4;"), ("b", 1, '2;"x"'),
    ]
    assert {r.reason for r in rejects.collect()} == {"unsafe member"}

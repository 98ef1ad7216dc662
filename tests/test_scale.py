"""Steps whose cost must not grow faster than their input."""

import zipfile

import pytest
from pyspark.sql import functions as F

from checks import registry, whole_files
from registrum.operators.membership import Rule, relax_members
from registrum.operators.quality import accepted_rows
from registrum.options import Options
from registrum.plans.tables import build_table, read_archived
from registrum.session import write_and_reread
from registrum.sources import archives
from registrum.sources.delimited import FILE
from registrum.specs import REGIMES
from registrum.streaming.ingest import ingest, ingested, running_totals, stream_table

UTF8 = Options(strict_membership=False, encoding="UTF-8")


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def set_conf(spark, request, key: str, value) -> None:
    request.addfinalizer(lambda given=spark.conf.get(key): spark.conf.set(key, given))
    spark.conf.set(key, value)


def partitions(df) -> int:
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def lines(first: int, bad: bool = False) -> str:
    return "\n".join(f"{'x' if bad else f'{i:08d}'};S;20240101;;N;;" for i in range(first, first + 30)) + "\n"


def zips(folder, count: int) -> str:
    for n in range(count):
        with zipfile.ZipFile(folder / f"simples{n}.zip", "w") as archive:
            archive.writestr("x.csv", lines(30 * n))
    return str(folder)


def test_lines_of_archives_are_not_broadcast(spark, tmp_path, capsys):
    raw, _ = read_archived(spark, zips(tmp_path, 3), UTF8)
    shown = plan(raw["simples"], capsys)
    assert "BuildRight" in shown and "BuildLeft" not in shown and "SortMergeJoin" not in shown
    assert raw["simples"].select("cnpj_basico").distinct().count() == 90


def test_members_are_dealt_out_to_tasks(spark, tmp_path):
    members = write_and_reread(archives.archive_members(archives.list_files(spark, zips(tmp_path, 6))))
    assert partitions(archives.member_lines(members, tasks=3)) == 3
    assert archives.reading_tasks(5, 100, 12) == 5
    assert archives.reading_tasks(5000, 100, 12) == 12
    assert archives.reading_tasks(5000, 100 * archives.TASK_BYTES, 12) == 100


def test_gate_judges_files_of_a_batch_one_by_one(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for n in range(4):
        (tmp_path / "in" / f"{n}.csv").write_text(lines(30 * n, bad=n == 1))
    stream = stream_table(spark, REGIMES, str(tmp_path / "in"), UTF8, files_per_batch=2)
    out = str(tmp_path / "out")
    ingest(stream, REGIMES, out, str(tmp_path / "cp"), opts=UTF8, chunk=F.col(FILE)).awaitTermination()
    loaded = ingested(spark, out)
    assert loaded.count() == 90 and loaded.select("batch_id").distinct().count() == 2
    totals = running_totals(spark, out).head()
    assert (totals.rows_total, totals.chunks_processed, totals.quality_gate_chunks) == (90, 3, 1)


def test_splits_do_not_grow_in_number(spark, tmp_path):
    for n in range(40):
        (tmp_path / f"{n}.txt").write_text("line\n" * 2000)
    assert whole_files.split_size(0) == whole_files.SPLIT_BYTES
    assert 10**12 / whole_files.split_size(10**12) <= whole_files.SPLITS
    with whole_files.small_splits(spark, 100_000):
        assert partitions(spark.read.text(str(tmp_path))) <= 10
    with whole_files.small_splits(spark, 4000):
        assert partitions(spark.read.text(str(tmp_path))) > 40


def test_files_grow_with_the_rows(spark):
    assert partitions(registry.spread(spark.range(1000), 50)) == 20
    assert partitions(registry.spread(spark.range(1000), 500)) == spark.sparkContext.defaultParallelism


def test_only_the_tables_asked_for_are_made(spark):
    made = []
    tables = registry.Loaded({n: lambda n=n: made.append(n) or spark.range(1) for n in ("a", "b")})
    assert "b" in tables and list(tables) == ["a", "b"]
    assert tables["a"] is tables["a"] and made == ["a"]
    assert set(dict(tables)) == {"a", "b"} and made == ["a", "b"]


def test_wide_rows_are_written_where_they_are_made(spark, capsys):
    t = registry.Tables(spark, "/root/testdata/sf0.001")
    before = set(registry.WRITTEN)
    assert t.loaded["simples"].count() == t.raw_simples.count()
    assert "loaded_socios" not in {name for _, _, name in set(registry.WRITTEN) - before}


@pytest.mark.parametrize("limit", [0, 2, 100])
def test_large_domains_leave_the_table_in_its_place(spark, capsys, request, limit):
    codes = [(1, "1"), (2, "013"), (3, "99"), (4, "x"), (5, None), (6, "13"), (7, "99"), (8, "1")]
    df = write_and_reread(spark.createDataFrame(codes, "k long, code string"))
    domain = write_and_reread(spark.range(20).select(F.col("id").cast("int").alias("codigo")))
    set_conf(spark, request, "spark.sql.autoBroadcastJoinThreshold", -1)  # as for a wide table
    checked = relax_members(df, [Rule("code", domain)], broadcast_rows=limit)
    found = {r.k: (r.code, r._violated) for r in checked.collect()}
    assert found == {
        1: ("1", []), 2: ("013", []), 3: (None, ["code"]), 4: (None, ["code"]),
        5: (None, []), 6: ("13", []), 7: (None, ["code"]), 8: ("1", []),
    }
    if limit == 2:  # the domain does not fit, the codes that it lacks do
        assert "SortMergeJoin" not in plan(checked, capsys)


def test_without_gates_nothing_is_looked_up(spark, capsys):
    raw = spark.createDataFrame([(f"{i:08d}", "S") for i in range(40)], "cnpj_basico string, opcao_pelo_simples string")
    opts = Options(strict_membership=False, gates=False)
    assert "Join" not in plan(build_table(raw, REGIMES, opts=opts, chunk=F.lit(1)).clean, capsys)


def test_gated_chunks_are_broadcast_however_many_records(spark, capsys, request):
    rows = write_and_reread(spark.range(100).withColumn("_chunk", F.col("id") % 10))
    records = write_and_reread(spark.range(10).select(F.col("id").alias("chunk"), (F.col("id") == 3).alias("gated")))
    set_conf(spark, request, "spark.sql.autoBroadcastJoinThreshold", -1)  # as if they were beyond it
    kept = accepted_rows(rows, records)
    assert "BroadcastHashJoin" in plan(kept, capsys) and kept.count() == 90

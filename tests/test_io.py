"""Sources, sinks, plans and streams over real files."""

import json
import zipfile
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from registrum.options import Options
from registrum.plans.integrity import integrity_pass
from registrum.plans.tables import (
    build_all, build_table, read_folder, read_rejected, selected, write_result,
)
from registrum.sinks.records import records_per_file, write_json_lines
from registrum.sinks.sql_folder import run_sql_folder
from registrum.sinks.tables import PART, save_bucketed, write_by_state, write_exchange, write_table
from registrum.sources import archives
from registrum.sources.delimited import (
    decode_lines, field_count, malformed, parse_lines, read_delimited, read_lines, read_table,
)
from registrum.sources.listing import latest_snapshot, links
from registrum.specs import COMPANIES, COUNTRIES, REGIMES, TABLES
from registrum.streaming.ingest import ingest, ingested, running_stats, running_totals, stream_table

UTF8 = Options(encoding="UTF-8")


def put(path, content, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content.encode(encoding) if isinstance(content, str) else content)
    return str(path)


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*(names or df.columns)).collect()), key=repr)


def test_two_files_with_mark_and_line_ends(spark, tmp_path):
    put(tmp_path / "in/a.csv", b"\xef\xbb\xbf1;A\r\n2;B")
    put(tmp_path / "in/b.CSV", "3;C\r\n4;D\r\n")
    df = read_table(spark, COUNTRIES, str(tmp_path / "in"), UTF8)
    assert rows(df, "codigo", "nome") == [("1", "A"), ("2", "B"), ("3", "C"), ("4", "D")]


def test_quotes_short_long_and_null_tokens(spark, tmp_path):
    path = put(tmp_path / "p.csv", '1;"a;""b"""\n2\n3;x;y\n4;NULL\n5;""\n')
    df = read_delimited(spark, path, COUNTRIES.read_schema(), UTF8)
    assert rows(malformed(df, 2), "line") == [("3;x;y",)]
    clean = read_table(spark, COUNTRIES, path, UTF8)
    assert rows(clean, "codigo", "nome") == [
        ("1", 'a;"b"'), ("2", None), ("4", None), ("5", None),
    ]
    assert clean.count() == 4 and rows(clean, "codigo") == [("1",), ("2",), ("4",), ("5",)]
    kept = read_table(spark, COUNTRIES, path, replace(UTF8, na_tokens=()))
    assert ("4", "NULL") in rows(kept, "codigo", "nome")


def test_field_count(spark):
    df = spark.createDataFrame([('a;"b;c";d',), ("",), ('"x""y;";z',)], "line string")
    assert [r[0] for r in df.select(field_count(F.col("line"))).collect()] == [3, 1, 2]


def test_encodings_per_file(spark, tmp_path):
    put(tmp_path / "in/a.txt", "1;Qualificação\n", "latin-1")
    put(tmp_path / "in/b.txt", "﻿2;Qualificação\n")
    lines = decode_lines(read_lines(spark, str(tmp_path / "in")))
    parsed = parse_lines(lines, COUNTRIES.read_schema(), UTF8)
    assert rows(parsed, "codigo", "nome") == [("1", "Qualificação"), ("2", "Qualificação")]


def test_archives(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    for name, members in {
        "Empresas1.zip": {"a.csv": b"1;x\r\n2;y", "../out.csv": b"no", "/abs.csv": b"no"},
        "Empresas2.zip": {"d/b.csv": "3;é\n".encode("latin-1")},
        "Socios.zip": {"c.csv": b"\xef\xbb\xbf4;\xc3\xa9\n"},
    }.items():
        with zipfile.ZipFile(folder / name, "w") as z:
            for member, data in members.items():
                z.writestr(member, data)
    put(folder / "Bad.zip", b"this is not a zip file")
    broken = bytearray((folder / "Socios.zip").read_bytes())
    broken[40] ^= 0xFF
    put(folder / "Broken.zip", bytes(broken))
    files = archives.list_files(spark, str(folder))
    missing = spark.createDataFrame([(f"file:{folder}/None.zip",)], "path string")
    report = archives.archive_report(files.select("path").union(missing)).collect()
    status = {r.path.rsplit("/", 1)[1]: (r.ok, r.status) for r in report}
    assert status["Empresas1.zip"] == (True, "ok")
    assert status["Bad.zip"] == (False, "not a zip")
    assert status["Broken.zip"][0] is False
    assert status["None.zip"] == (False, "missing")
    named, rejects = archives.read_archives(spark, str(folder))
    left = {(r.path.rsplit("/", 1)[1], r.member): r.reason for r in rejects.collect()}
    assert left == {
        ("Bad.zip", None): "not a zip", ("Empresas1.zip", "../out.csv"): "unsafe member",
        ("Empresas1.zip", "/abs.csv"): "unsafe member",
        ("Broken.zip", "c.csv"): "damaged member: BadZipFile",
    }
    assert rows(archives.archive_rejects(missing), "member", "reason") == [(None, "missing")]
    assert rows(archives.archive_members(files), "member") == [("a.csv",), ("c.csv",), ("d/b.csv",)]
    assert rows(named, "category", "member", "line_no", "line") == [
        ("empresas", "a.csv", 1, "1;x"), ("empresas", "a.csv", 2, "2;y"),
        ("empresas", "d/b.csv", 1, "3;é"), ("socios", "c.csv", 1, "4;é"),
    ]


def test_overlong_lines_are_recorded(spark, tmp_path):
    put(tmp_path / "in/paises/a.csv", "1;Um\n2;B;extra\n3;Tres\n")
    folder = str(tmp_path / "in")
    opts = replace(UTF8, strict_membership=False)
    built = build_all(read_folder(spark, folder, opts), opts, rejected=read_rejected(spark, folder, opts))
    result = built[COUNTRIES.name]
    assert sorted(r.codigo for r in result.clean.collect()) == [1, 3]
    assert [(r.reason, json.loads(r.row)) for r in result.quarantine.collect()] == [
        ("malformed_line", {"line": "2;B;extra"})
    ]


def test_chunks_of_a_shuffled_source_are_stable(spark):
    # Of the rows of a chunk, either all or none are loaded, however often they are read.
    raw = spark.range(40_000).select(
        F.concat("id", F.lit("")).alias("cnpj_basico"), F.lit("x").alias("razao_social")
    )
    missing = [c for c in COMPANIES.column_names if c not in raw.columns]
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in missing}).repartition(7)
    opts = Options(strict_membership=False, chunk_size=1000, gate_null_delta_ratio=0.05)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        result = build_table(raw, COMPANIES, {}, opts)
        first = result.clean.count()
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
        again = len(result.clean.select("cnpj_basico", "razao_social").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    accepted = result.telemetry.where("not gated").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    assert first == again == accepted
    assert result.telemetry.agg(F.sum("rows")).first()[0] == 40_000


@pytest.mark.parametrize("by_state", [False, True])
def test_clustering_survives_the_write(spark, tmp_path, by_state):
    raw = spark.range(3000).select(
        F.lpad(F.reverse(F.col("id").cast("string")), 8, "0").alias("cnpj_basico"),
        F.element_at(F.array(*map(F.lit, ("SP", "RJ", "MG"))), (F.col("id") % 3 + 1).cast("int")).alias("uf"),
    )
    spec = TABLES["estabelecimentos"]
    missing = [c for c in spec.column_names if c not in raw.columns]
    raw = raw.withColumns({c: F.lit(None).cast("string") for c in missing})
    opts = Options(strict_membership=False, gates=False, cluster_by_state=True, partition_by_state=by_state)
    write_result(build_table(raw, spec, {}, opts), str(tmp_path / "out"), opts)
    written = spark.read.parquet(str(tmp_path / f"out/tables/{spec.table}"))
    by_file: dict = {}
    for r in written.select(F.input_file_name().alias("f"), "uf", "cnpj_basico").collect():
        by_file.setdefault(r.f, []).append((r.uf, r.cnpj_basico))
    assert written.count() == 3000
    assert all(found == sorted(found) for found in by_file.values())


@pytest.mark.parametrize(
    ("name", "safe"),
    [("a.csv", True), ("d/../a.csv", True), ("../a", False), ("/a", False), ("d/../../a", False),
     ("..\\a", False), ("C:\\a", False), ("..", False)],
)
def test_safe_members(name, safe):
    assert archives.safe_member(name) is safe


def test_categories(spark):
    df = spark.createDataFrame([("/x/Empresas4.zip",), ("Socios.zip",), ("/y/123.zip",)], "p string")
    got = [r[0] for r in df.select(archives.category(F.col("p"))).collect()]
    assert got == ["empresas", "socios", "desconhecido"]


def test_listing(spark):
    df = spark.createDataFrame([("2025-10/",), ("2025-11/",), ("2024-12/",), ("x",)], "e string")
    assert latest_snapshot(df, "e").head()[0] == "2025-11"
    assert latest_snapshot(df.where("e = 'x'"), "e").head()[0] is None
    html = "<p><a class=x href='Lote-A.ZIP'>A</a><a href=\"notes.pdf\">n</a> <A HREF=\"http://mirror/lote-b.zip\">B</A></p>"
    page = spark.createDataFrame([(html,)], "html string")
    got = rows(links(page, "html", F.lit("http://base/")), "link")
    assert got == [("http://base/Lote-A.ZIP",), ("http://mirror/lote-b.zip",)]


def test_save_modes(spark, tmp_path):
    df = spark.range(3)
    write_table(df, str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        write_table(df, str(tmp_path / "t"))
    write_table(spark.range(5), str(tmp_path / "t"), allow_overwrite=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_exchange_text_keeps_blanks_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(" a;\"b\" ", [1, 2], None)], "t string, c array<int>, n string")
    write_exchange(df, str(tmp_path / "x"))
    text = "".join(p.read_text() for p in (tmp_path / "x").glob("part-*"))
    assert text == '" a;""b"" ";{1,2};\n'


def test_json_lines_append_and_split(spark, tmp_path):
    df = spark.range(100).select("id", F.lit("x" * 50).alias("t")).coalesce(1)
    limit = 10 * 75
    write_json_lines(df, str(tmp_path / "j"), max_bytes=limit, run_date="20240101")
    files = list((tmp_path / "j/run_date=20240101").glob("*.json"))
    assert len(files) > 5 and max(f.stat().st_size for f in files) <= limit * 1.2
    write_json_lines(df, str(tmp_path / "j"), run_date="20240101")
    assert spark.read.json(str(tmp_path / "j")).count() == 200
    assert records_per_file(df.limit(0), 10) == 1


def test_state_folders(spark, tmp_path):
    df = spark.createDataFrame([("SP",), ("XX",), (None,)], "uf string")
    write_by_state(df, str(tmp_path / "s"))
    assert {p.name for p in (tmp_path / "s").glob(f"{PART}=*")} == {f"{PART}=SP", f"{PART}=default"}


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE reg LOCATION '{tmp_path}/reg'")
    for name in ("reg.a", "reg.b"):
        save_bucketed(spark.range(100), name, ["id"], 4, allow_overwrite=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("reg.a").join(spark.table("reg.b"), "id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sql_folder_stops_at_the_first_error(spark, tmp_path):
    put(tmp_path / "q/2.sql", "SELECT nope FROM t;")
    put(tmp_path / "q/1.sql", "SELECT count(*) AS n FROM t;")
    with pytest.raises(AnalysisException):
        run_sql_folder(spark, str(tmp_path / "q"), {"t": spark.range(3)})
    put(tmp_path / "q/2.sql", "SELECT max(id) AS n FROM t")
    got = run_sql_folder(spark, str(tmp_path / "q"), {"t": spark.range(3)})
    assert [(k, df.head()[0]) for k, df in got.items()] == [("1.sql", 3), ("2.sql", 2)]


# Two companies, one with two establishments; partners and regimes of both.
FILES = {
    "paises": ["105;Uruguai", "76;Chile"],
    "municipios": ["7;Vila Nova", "8;Porto Alto"],
    "qualificacoes": ["5;Administração", "22;Sócia"],
    "naturezas": ["2062;Limitada"],
    "cnaes": ["4711301;Mercearia", "5611201;Restaurante"],
    "empresas": ["40200310;Padaria Aurora;2062;5;12.345,67;3;", '40200311;"Moinho; Filhos";2062;22;0,50;1;'],
    "estabelecimentos": [
        "40200310;0001;30;1;Aurora Centro;2;20210115;0;;105;20190304;4711301;5611201,4711301;Avenida;Do Sol;"
        "77 B;;Norte;40301-110;RS;7;51;33445566;;;;;loja@aurora.example;;",
        "40200310;0002;11;2;;8;20230630;1;;76;20200229;5611201;;Rua;Das Pedras;9;fundos;Sul;40301120;xx;8;;;;;;;;;",
        "40200311;0001;85;1;Moinho;2;20220101;0;;;20220101;4711301;;Rua;Larga;1;;;40301130;PR;7;;;;;;;;;",
    ],
    "simples": ["40200310;S;20190304;00000000;N;00000000;00000000", "40200311;N;;;S;20220101;"],
    "socios": [
        "40200310;2;Ana Prado;52998224725;22;20190304;105;;;;4",
        "40200311;2;Rui Matos;***982247**;5;20220101;;;;;7",
    ],
}


def test_all_tables_from_files(spark, tmp_path):
    for name, lines in FILES.items():
        put(tmp_path / "in" / name / f"{name}.csv", "\n".join(lines), "latin-1")
    opts = Options(stage=True, metrics=True, partition_by_state=True, cluster_by_state=True)
    results = build_all(read_folder(spark, str(tmp_path / "in"), opts), replace(opts, strict_membership=False))
    assert list(results) == list(FILES)
    for result in results.values():
        write_result(result, str(tmp_path / "out"), opts)
    tables = {
        r.spec.table: spark.read.parquet(str(tmp_path / "out/tables" / r.spec.table))
        for r in results.values()
    }
    assert {r.spec.name: tables[r.spec.table].count() for r in results.values()} == {n: len(v) for n, v in FILES.items()}
    first, second, _ = tables["estabelecimentos"].orderBy("cnpj_basico", "cnpj_ordem").collect()
    assert first.cnae_fiscal_secundaria == [5611201, 4711301] and first.uf_part == "RS"
    assert first.cep == "40301110" and str(first.data_inicio_atividade) == "2019-03-04"
    assert (second.uf, second.uf_part, str(second.data_inicio_atividade)) == (None, "default", "2020-02-29")
    firms = {r.cnpj_basico: r for r in tables["empresas"].collect()}
    assert str(firms["40200310"].capital_social) == "12345.67" and firms["40200311"].razao_social == "Moinho; Filhos"
    assert tables["qualificacoes_socios"].where("codigo = 5").head().nome == "Administração"
    assert tables["estabelecimentos"].join(tables["empresas"], "cnpj_basico").count() == 3
    integrity_pass(tables, opts, strict=True)
    summary = json.loads(next((tmp_path / "out/summary/empresas").glob("*.json")).read_text())
    assert summary["rows_total"] == 2
    assert summary["column_stats"]["razao_social"] == {"nulls": 0, "min": "Moinho; Filhos", "max": "Padaria Aurora"}
    metrics = "".join(p.read_text() for p in (tmp_path / "out/metrics/empresas").glob("part-*"))
    assert 'cnpj_auto_repair_rows_total{table="empresas"} 2' in metrics


def test_subsets_and_missing_parents(spark):
    assert [s.name for s in selected(only=["cnaes", "paises"])] == ["paises", "cnaes"]
    assert "socios" not in [s.name for s in selected(exclude=["socios"])]
    raw = spark.createDataFrame([tuple("1" * 7)], COMPANIES.read_schema())
    with pytest.raises(RuntimeError):
        build_table(raw, COMPANIES)
    relaxed = build_table(raw, COMPANIES, opts=Options(strict_membership=False))
    assert relaxed.clean.count() == 1


def test_level_none_never_gates(spark):
    raw = spark.createDataFrame([("x", "S", "", "", "", "", "")] * 30, REGIMES.read_schema())

    def build(level):
        opts = Options(level=level)
        return build_table(raw, REGIMES, opts=opts, chunk=F.lit(1)).clean.count()

    assert build("none") == 30 and build("basic") == 0


def test_stream_is_loaded_once_and_goes_on_after_a_bad_batch(spark, tmp_path):
    def lines(first, bad):
        return "\n".join(
            f"{'x' if bad else f'{i:08d}'};S;20240101;;N;;" for i in range(first, first + 30)
        )

    put(tmp_path / "in/a.csv", lines(0, False))
    put(tmp_path / "in/b.csv", lines(30, True))

    def run():
        stream = stream_table(spark, REGIMES, str(tmp_path / "in"), UTF8, files_per_batch=1)
        query = ingest(stream, REGIMES, str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        return ingested(spark, str(tmp_path / "out")).count()

    assert run() == 30
    assert run() == 30
    put(tmp_path / "in/c.csv", lines(60, False))
    assert run() == 60
    totals = running_totals(spark, str(tmp_path / "out")).head()
    assert (totals.rows_total, totals.chunks_processed, totals.quality_gate_chunks) == (60, 2, 1)
    stats = {r.column: r for r in running_stats(spark, str(tmp_path / "out")).collect()}
    assert stats["cnpj_basico"].max == "00000089"
    reasons = ingested(spark, str(tmp_path / "out"), "quarantine").select("reason").distinct()
    assert rows(reasons) == [("quality_gate",)]


def test_nine_presets():
    assert list(TABLES) == [
        "paises", "municipios", "qualificacoes", "naturezas", "cnaes", "empresas",
        "estabelecimentos", "simples", "socios",
    ]

"""Operators on small frames with known faults."""

import pytest
from pyspark.sql import functions as F

from registrum.operators import integrity, joins, membership, quality, search
from registrum.operators.chunks import CHUNK, chunk_by_file, chunk_by_position
from registrum.operators.enrich import enrich_by_city_name, enrich_by_postal_code
from registrum.operators.membership import MembershipError, Rule
from registrum.operators.profile import sample_diffs, selectivity
from registrum.operators.repair import conform, repair
from registrum.options import Options
from registrum.specs import COMPANIES, ESTABLISHMENTS, PARTNERS, REGIMES, TABLES

JOIN_KINDS = ["inner", "left", "left_semi", "left_anti"]


def rows(df, *names):
    return sorted((tuple(r) for r in df.select(*(names or df.columns)).collect()), key=repr)


@pytest.mark.parametrize("how", JOIN_KINDS)
@pytest.mark.parametrize("share", [0.5, 0.05, 0.001])
def test_balanced_join_equals_plain_join(spark, how, share):
    # Key 1 holds a third of the rows, another part has no key at all.
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1)
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 400)
        .alias("k"),
        F.col("id").alias("v"),
    )
    right = spark.range(0, 500, 2).select((F.col("id") + 1).alias("k"), F.col("id").alias("w"))
    right = right.union(right.where(F.col("k") == 1).withColumn("w", F.lit(-1)))
    got = joins.balanced_join(left, right, ["k"], how, share)
    assert rows(got) == rows(left.join(right, ["k"], how))


def test_balanced_join_splits_the_hot_key(spark):
    left = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(1, "x")], "k int, w string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.balanced_join(left, right, ["k"], "inner", 0.05)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 4000
        assert len(sizes) > 4 and max(r["count"] for r in sizes) < 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_lookup_join_beyond_the_broadcast_bound(spark):
    left = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    right = spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    small = joins.lookup_join(left, right, ["k"])
    large = joins.lookup_join(left, right, ["k"], broadcast_rows=2)
    assert rows(small) == rows(large)
    assert joins.fits_broadcast(right, 5) and not joins.fits_broadcast(right, 4)


def test_chunks(spark, tmp_path):
    spark.range(0, 1000, 1, 7).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    sizes = chunk_by_position(df, 300).groupBy(CHUNK).count().orderBy(CHUNK).collect()
    assert [tuple(r) for r in sizes] == [(1, 300), (2, 300), (3, 300), (4, 100)]
    named = df.withColumn("_file", F.lit("f"))
    blocks = chunk_by_file(named, 50).groupBy(CHUNK).count().collect()
    assert sum(r["count"] for r in blocks) == 1000 and max(r["count"] for r in blocks) <= 50


def establishments(spark, *given):
    names = ["cnpj_basico", "cnpj_ordem", "cnpj_dv", "uf", "pais_codigo", "correio_eletronico"]
    schema = ", ".join(f"{n} string" for n in names) + ", _chunk long"
    return spark.createDataFrame([(*r, 1) for r in given], schema)


def test_repair_touches_only_present_columns(spark):
    df = spark.createDataFrame([("12",), ("12345678",)], "cnpj_basico string")
    out = repair(df, REGIMES)
    assert rows(out, "cnpj_basico") == [("12345678",), (None,)]
    assert out.columns == ["cnpj_basico", "_before", "_invalid_id"]
    assert rows(repair(df, REGIMES, "none"), "cnpj_basico") == [("12",), ("12345678",)]


def test_repair_of_partners(spark):
    df = spark.createDataFrame(
        [("12345678", "123.456.789-09", "000.000.000-00", "  ")],
        "cnpj_basico string, cnpj_cpf_socio string, representante_legal_cpf string, "
        "nome_socio_ou_razao_social string",
    )
    out = repair(df, PARTNERS).drop("_before", "_invalid_id")
    assert rows(out) == [("12345678", "12345678909", None, None)]


def test_telemetry_of_an_email_that_changed(spark):
    df = establishments(spark, ("11222333", "0001", "81", "sp", "1", "USER@ExAmple.com"))
    out = repair(df, ESTABLISHMENTS, "aggressive")
    record = quality.telemetry(out, ESTABLISHMENTS, "aggressive").head()
    assert record.changed_counts == {"uf": 1, "correio_eletronico": 1}
    assert record.null_deltas["uf"] == 0 and record.invalid_ids == 0
    diff = sample_diffs(out, ["correio_eletronico"], ["cnpj_basico"]).head()
    assert (diff.before, diff.after) == ("USER@ExAmple.com", "user@example.com")
    basic = quality.telemetry(out, ESTABLISHMENTS, "basic").head()
    assert basic.changed_counts == {}
    none = quality.telemetry(out, ESTABLISHMENTS, "none").head()
    assert none.after_nulls == {} and none.null_deltas == {}


def gated(spark, changed, delta, rows_count=100, **opts):
    records = spark.createDataFrame(
        [("t", "c", 1, rows_count, {"a": changed}, {"a": delta, "b": 0})],
        "`table` string, config string, chunk int, rows long, changed_counts map<string,bigint>, "
        "null_deltas map<string,bigint>",
    )
    return quality.with_gate(records, Options(**opts)).head()


def test_gate_is_strictly_above_its_limit(spark):
    assert not gated(spark, 30, 0).gated
    one = gated(spark, 31, -40)
    assert one.gated
    assert one.trigger_columns["a"].asDict() == {
        "type": "changed", "ratio": 0.31, "count": 31, "delta": None,
        "null_delta_ratio": 0.4, "null_delta": -40,
    }
    nulls = gated(spark, 0, -31).trigger_columns["a"]
    assert (nulls.type, nulls.ratio, nulls.delta) == ("null_delta", 0.31, -31)
    assert not gated(spark, 19, 19, rows_count=19).gated
    assert not gated(spark, 90, 90, gates=False).gated
    assert gated(spark, 1, 1, rows_count=1, gate_min_rows=1).gated


def test_quarantine_reasons_and_rows(spark):
    df = establishments(
        spark,
        ("12345678", "0001", "00", "SP", "9", None),
        (None, "0001", "81", "SP", "1", None),
        ("11222333", "0001", "81", "SP", "1", None),
    )
    domain = spark.createDataFrame([(1, "x")], "codigo int, nome string")
    checked = membership.relax_members(
        repair(df, ESTABLISHMENTS), [Rule("pais_codigo", domain)]
    )
    found = quality.row_records(checked, ESTABLISHMENTS).collect()
    by_reason = {r.reason: r for r in found}
    assert set(by_reason) == {"critical_fields_null", "invalid_cnpj", "fk_violation"}
    assert '"pais_codigo":"9"' in by_reason["invalid_cnpj"].row
    assert "pais_codigo" not in by_reason["fk_violation"].row
    assert by_reason["fk_violation"].fields == ["pais_codigo"]
    skipped = quality.row_records(checked, ESTABLISHMENTS, skip_invalid=True).collect()
    assert {r.reason for r in skipped} == {"critical_fields_null", "invalid_cnpj"}
    assert quality.skip_invalid_ids(checked).count() == 2


def test_strict_and_relaxed_membership(spark):
    df = spark.createDataFrame([("XX", "1"), ("SP", "07"), (None, None)], "uf string, c string")
    domain = spark.createDataFrame([(7,)], "codigo smallint")
    rules = [Rule("uf", allowed=("SP",)), Rule("c", domain), Rule("absent", domain)]
    with pytest.raises(MembershipError, match=r"c: 1 rows .*'1'.*; uf: 1 rows .*'XX'"):
        membership.check_members(df, rules, strict=True)
    for bound in (100, 0):
        out = membership.check_members(df, rules, strict=False, broadcast_rows=bound)
        assert rows(out, "uf", "c", "_violated") == [
            ("SP", "07", []), (None, None, ["uf", "c"]), (None, None, []),
        ]
    assert membership.check_members(df.where("uf = 'SP'"), rules).count() == 1


def test_empty_domains(spark):
    full = spark.createDataFrame([(1,)], "codigo int")
    empty = full.where("codigo > 1")
    assert membership.require_loaded({"a": full}) == []
    assert membership.require_loaded({"a": full, "b": empty, "c": None}, strict=False) == ["b", "c"]
    with pytest.raises(membership.EmptyDomainError):
        membership.require_loaded({"b": empty})


POSTAL = "cep string, uf string, municipio_codigo string"


def test_postal_map_with_repeated_keys_and_state_policies(spark):
    df = spark.createDataFrame(
        [("12345678", None, None), ("12345678", "RJ", "5"), (None, None, None), ("9", "SP", None)],
        "cep string, uf string, municipio_codigo string",
    )
    lookup = spark.createDataFrame(
        [("12345-678", "sp", "20"), ("12345-678", "MG", "30"), ("00000000", "AC", "1")], POSTAL
    )
    columns = ["cep", "uf", "municipio_codigo", "uf_source", "municipio_source"]
    tag = "cep_map_exact"
    first = rows(enrich_by_postal_code(df, lookup), *columns)
    assert first == sorted(
        [
            ("12345678", "SP", "20", tag, tag), ("12345678", "RJ", "5", None, None),
            (None, None, None, None, None), ("9", "SP", None, None, None),
        ],
        key=repr,
    )
    second = rows(
        enrich_by_postal_code(df, lookup, only_if_null=False, broadcast_rows=0), *columns
    )
    assert ("12345678", "SP", "5", tag, None) in second and len(second) == 4


def test_city_name_map(spark):
    df = spark.createDataFrame(
        [(" SÃO PAULO ", None, "SP"), ("sao paulo", None, "RJ"), (None, None, "SP")],
        "municipio_nome string, municipio_codigo string, uf string",
    )
    with_state = spark.createDataFrame(
        [("São Paulo", "7", "sp"), ("SAO PAULO", "3", "SP")],
        "municipio_nome string, municipio_codigo string, uf string",
    )
    out = enrich_by_city_name(df, with_state)
    assert rows(out, "uf", "municipio_codigo", "municipio_source") == [
        ("RJ", None, None), ("SP", "3", "mun_name_map"), ("SP", None, None),
    ]
    out = enrich_by_city_name(df, with_state.drop("uf"))
    assert [r[0] for r in rows(out, "municipio_codigo")] == ["3", "3", None]


def test_conform_strict(spark):
    df = spark.createDataFrame([("12345678", "x" * 256, "70000")],
                               "cnpj_basico string, razao_social string, porte_empresa string")
    assert conform(df, COMPANIES).head()._overflow == ["razao_social", "porte_empresa"]
    with pytest.raises(ValueError, match="razao_social"):
        conform(df, COMPANIES, strict=True)


def test_keys_and_backfill(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b")], "codigo int, nome string")
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "ref int")
    once = integrity.backfill(parent, "codigo", [(child, "ref")], "nome", "?")
    assert rows(once) == [(1, "a"), (2, "b"), (9, "?")]
    assert rows(integrity.backfill(once, "codigo", [(child, "ref")], "nome", "?")) == rows(once)
    relation = integrity.Relation("child", "ref", "parent", "codigo")
    tables = {"child": child, "parent": parent}
    report = integrity.foreign_key_report(tables, [relation])
    assert tuple(report.head())[3:] == (2, 1, "9")
    with pytest.raises(integrity.IntegrityError):
        integrity.require_keys(report, ["orphan_rows"])
    done = integrity.foreign_key_report({**tables, "parent": once}, [relation])
    integrity.require_keys(done, ["orphan_rows"])
    keys = integrity.primary_key_report(child, ["ref"], "child").head()
    assert tuple(keys)[2:] == (1, 1, 1)


def test_trigram_similarity(spark):
    df = spark.createDataFrame([("word", "two words"), ("", ""), ("abc", "abc")], "a string, b string")
    got = df.select(search.similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert [round(r.s, 6) for r in got] == [round(4 / 11, 6), 0.0, 1.0]


def test_name_search_takes_wildcards_literally(spark):
    df = spark.createDataFrame([("100% Puro",), ("1000 Puro",)], "nome string")
    assert rows(search.name_contains(df, "nome", "100% p")) == [("100% Puro",)]


def test_full_id_lookup_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    establishments(spark, ("11222333", "0001", "81", "SP", "1", None)).write.parquet(path)
    found = search.by_full_id(spark.read.parquet(path), "11222333000181")
    assert found.count() == 1
    plan = found._jdf.queryExecution().toString()
    assert "EqualTo(cnpj_basico,11222333)" in plan


def test_selectivity(spark):
    got = {r.column: r.selectivity for r in selectivity(spark.range(1000).withColumn(
        "two", F.col("id") % 2), ["id", "two"]).collect()}
    assert got["id"] > 0.8 and got["two"] < 0.01


def test_critical_fields_of_presets():
    assert TABLES["empresas"].critical == ("cnpj_basico",)
    assert TABLES["estabelecimentos"].critical == ("cnpj_basico", "cnpj_ordem", "cnpj_dv")
    assert TABLES["socios"].critical == ("cnpj_basico", "cnpj_cpf_socio")
    assert TABLES["simples"].critical == ("cnpj_basico",)
    assert len(TABLES["estabelecimentos"].source_columns) == 30


def test_every_table_is_built():
    """A query of all nine tables is registered, and none of them is left out of its counts."""
    from checks import CHECKS
    from registrum.specs import TABLES

    built = CHECKS["build_every_table"].sql
    assert all(f"'{spec.table}'" in built for spec in TABLES.values())


def test_relations_of_a_child_come_from_one_scan(spark):
    from registrum.operators.integrity import Relation, foreign_key_report, keys_in_use

    parents = {
        "p": spark.createDataFrame([(1,), (13,), (None,)], "codigo int"),
        "q": spark.createDataFrame([("a",), ("b",)], "id string"),
    }
    child = spark.createDataFrame(
        [("013", "a", 1), ("13", "x", 1), ("7", "x", 2), (None, None, 9), ("10", "b", None), ("x", "a", 9), ("7", "a", 9)],
        "c string, d string, e int",
    )
    tables = {**parents, "child": child, "other": child}
    relations = [
        Relation("child", "c", "p", "codigo"), Relation("child", "d", "q", "id"),
        Relation("child", "e", "p", "codigo"), Relation("other", "d", "q", "id"),
    ]
    got = {(r.child, r.column): tuple(r)[3:] for r in foreign_key_report(tables, relations).collect()}
    # 7 is less than 10 as a number; what is no number comes first only as text.
    assert got == {
        ("child", "c"): (4, 3, "x"), ("child", "d"): (2, 1, "x"),
        ("child", "e"): (4, 2, "2"), ("other", "d"): (2, 1, "x"),
    }
    used = {(r.relation, r.key): r.rows for r in keys_in_use(tables, relations).collect()}
    assert used[0, "13"] == 2 and used[2, "9"] == 3 and len(used) == 4 + 3 + 3 + 3
    assert foreign_key_report({**tables, "child": child.limit(0)}, relations[:1]).head()["orphan_rows"] == 0

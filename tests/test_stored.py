"""Capped files, sketches, the index of codes and the manifest, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from registrum.operators import code_index
from registrum.operators.sketches import column_sketches, error, estimates, merged
from registrum.sinks.records import numbered_files, write_json_lines
from registrum.sources.manifest import listed, load_new, pending, read_manifest


def test_no_file_is_over_the_cap(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, "é" * rng.choice([0, 3, 40, 300]), None if i % 3 else {"a\"b": i}) for i in range(500)]
    rows += [(1000, "x" * 5000, None), (1001, None, None)]
    df = spark.createDataFrame(rows, "row long, file string, part map<string,long>").repartition(7)
    write_json_lines(df, str(tmp_path), max_bytes=2000, run_date="20240101")
    files = list((tmp_path / "run_date=20240101").glob("*.json"))
    assert sorted(f.stat().st_size > 2000 for f in files) == [False] * (len(files) - 1) + [True]
    big = max(files, key=lambda f: f.stat().st_size)
    assert len(big.read_text().splitlines()) == 1
    # Greedy filling: two neighbouring files of a task never fit one.
    total = sum(f.stat().st_size for f in files)
    assert len(files) <= 2 * total / 2000 + 8
    back = spark.read.schema(df.schema).json(str(tmp_path)).drop("run_date").collect()
    assert sorted(map(repr, back)) == sorted(map(repr, df.collect()))


def test_file_numbers_have_no_gaps(spark):
    df = spark.range(300).repartition(5)
    numbers = {r.file for r in numbered_files(df, 100).select("file").distinct().collect()}
    assert numbers == set(range(len(numbers))) and len(numbers) > 5


def test_capped_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "a int")
    write_json_lines(df, str(tmp_path / "e"), max_bytes=10, daily=False)
    assert spark.read.schema("a int").json(str(tmp_path / "e")).count() == 0


def test_sketches_merge_to_those_of_the_whole(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 7).alias("chunk"),
        (F.col("id") % 3000).alias("n"),
        F.concat(F.lit("v"), F.col("id") % 11).alias("t"),
        F.when(F.col("id") % 2 == 0, F.col("id").cast("decimal(12,2)")).alias("d"),
        F.lit(None).cast("int").alias("nothing"),
        F.col("id").alias("a'b.c"),
    )
    columns = ["n", "t", "d", "nothing", "a'b.c"]
    states = column_sketches(df, columns, ["chunk"])
    assert states.count() == 7 * len(columns)
    twice = merged(merged(states, ["chunk"]))
    found = {r["column"]: r for r in estimates(twice, [0.5]).collect()}
    for name, exact, values in [("n", 3000, 20_000), ("t", 11, 20_000), ("d", 10_000, 10_000), ("a'b.c", 20_000, 20_000)]:
        assert found[name]["values"] == values
        assert abs(found[name].distinct - exact) <= 3 * error() * exact + 1
    assert (found["nothing"]["values"], found["nothing"].distinct, found["nothing"].selectivity) == (0, 0, None)
    assert found["nothing"].quantiles == [None] and found["t"].quantiles == [None]
    assert abs(found["n"].quantiles[0] - 1500) < 150 and abs(found["d"].quantiles[0] - 10_000) < 1000
    empty = estimates(merged(column_sketches(df.limit(0), ["n"], ["chunk"])))
    assert empty.count() == 0


def test_code_index_matches_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = []
    for i in range(1500):
        row = rng.choice([i, i * 97, i + 2**40, -i])
        rows.append((row, rng.choice([None, [], rng.choices([1, 2, 3, 4, None], k=rng.randint(0, 4))])))
    rows += [(None, [1, 2]), (5, [1]), (5, [2])]
    df = spark.createDataFrame(rows, "row long, codes array<int>").repartition(6)
    index = code_index.write_code_index(df, "row", "codes", str(tmp_path / "i"))
    sets = {}
    for row, codes in rows:
        if row is not None:
            sets.setdefault(row, set()).update(c for c in codes or [] if c is not None)

    def numbers(found):
        got = [r.row for r in found.collect()]
        assert len(got) == len(set(got))
        return set(got)

    for wanted in ([1], [1, 2], [2, 3, 4], [3, 3], [9], [1, 9]):
        assert numbers(code_index.rows_with_all(index, wanted)) == {r for r, c in sets.items() if c >= set(wanted)}
        assert numbers(code_index.rows_with_any(index, wanted)) == {r for r, c in sets.items() if c & set(wanted)}
    counts = {r.code: r.rows for r in code_index.count_rows(index, [1, 4]).collect()}
    assert counts == {c: sum(c in s for s in sets.values()) for c in (1, 4)}
    assert numbers(code_index.rows_with_any(index, [])) == set()
    with pytest.raises(ValueError, match="no codes"):
        code_index.rows_with_all(index, [])


def test_code_search_reads_its_codes_only(spark, tmp_path):
    df = spark.range(50_000).select("id", F.array((F.col("id") % 40).cast("int"), F.lit(99)).alias("codes"))
    index = code_index.write_code_index(df, "id", "codes", str(tmp_path / "i"))
    plan = code_index.rows_with_all(index, [7, 99])._jdf.queryExecution().executedPlan().toString()
    assert "In(code, [7,99])" in plan


def test_dense_rows(spark):
    df = spark.range(1000).repartition(9).where("id % 5 <> 0")
    found = code_index.dense_rows(df).collect()
    assert sorted(r.row for r in found) == list(range(800))
    assert sorted(r.id for r in found) == [i for i in range(1000) if i % 5]
    assert code_index.dense_rows(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="row"):
        code_index.dense_rows(df.withColumnRenamed("id", "row"))


def test_manifest_reads_new_and_changed_files_once(spark, tmp_path):
    source, manifest = tmp_path / "in", str(tmp_path / "manifest")
    (source / "deep").mkdir(parents=True)
    (source / "a.csv").write_text("1\n")
    (source / "deep/b.csv").write_text("2\n")
    (source / "c.txt").write_text("no\n")
    seen = []

    def load(paths):
        seen.append([p.rsplit("/", 1)[1] for p in paths])

    def run(name, **options):
        return load_new(spark, str(source), manifest, name, load, "*.csv", **options)

    assert run("one") == 2 and run("two") == 0
    (source / "a.csv").write_text("1\n3\n")
    (source / "d.csv").write_text("4\n")
    (source / "e.csv").write_text("")
    (source / "deep/b.csv").unlink()
    assert run("three") == 2
    assert seen == [["a.csv", "b.csv"], ["a.csv", "d.csv"]]
    assert sorted(r.run for r in read_manifest(spark, manifest).collect()) == ["one", "one", "three", "three"]


def test_failed_load_publishes_nothing(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("1\n")

    def fail(paths):
        raise RuntimeError("lost")

    manifest = str(tmp_path / "m")
    with pytest.raises(RuntimeError, match="lost"):
        load_new(spark, str(tmp_path / "in"), manifest, "one", fail)
    assert load_new(spark, str(tmp_path / "in"), manifest, "two", lambda paths: None) == 1


def test_checksums_tell_same_length_and_time(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1\n")
    with_sums = listed(spark, str(tmp_path), checksum=True)
    before = spark.createDataFrame([(*r, "one") for r in with_sums.collect()], read_manifest(spark, str(tmp_path / "none")).schema)
    assert pending(with_sums, before).count() == 0
    other = before.withColumn("checksum", F.lit("0"))
    assert pending(with_sums, other).count() == 1

"""Loads are checked by content, replaced as a whole, and parsed once."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.operators.checksum import Checksum, checksum
from ferrytally.plans import migrate
from ferrytally.sources import readers, replace, sinks

SCHEMA = "a bigint, b string, c double, d array<string>, e map<string,int>, f struct<g:int,h:date>"


def frame(spark, rows, schema="k bigint, v string"):
    return spark.createDataFrame(rows, schema)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_checksum_depends_on_rows_alone(spark):
    rng = random.Random(1)
    rows = [(i % 9 or None, rng.choice(["x", "", None]), rng.choice([0.5, float("nan"), None]), ["p", None], {"q": i % 2}, (i % 3, None)) for i in range(60)]
    df = frame(spark, rows, SCHEMA)
    rng.shuffle(rows)
    again = frame(spark, rows, SCHEMA).repartition(7).select("f", "e", F.col("b").alias("B"), "a", "d", "c")
    assert checksum(df) == checksum(again) and checksum(df).rows == 60
    assert checksum(df.limit(0)) == Checksum()
    parts = [checksum(df.filter("a > 4")), checksum(df.filter("not coalesce(a, 0) > 4"))]
    assert parts[0] + parts[1] == checksum(df)
    # A column of nulls is like none.
    assert checksum(df.withColumn("z", F.lit(None).cast("int"))) == checksum(df)


@pytest.mark.parametrize("other", [
    [(1, "x"), (2, "y"), (2, "z")], [(1, "x"), (2, "y"), (3, None)], [(1, "x"), (2, "z"), (3, "y")], [(1, "x"), (2, "y")],
    [(1, "x"), (2, "y"), (3, "z"), (3, "z")], [(1, "x"), (1, "x"), (3, "z")],
])
def test_checksum_finds_changes(spark, other):
    assert checksum(frame(spark, other)) != checksum(frame(spark, [(1, "x"), (2, "y"), (3, "z")]))


def test_swapped_columns_are_found(spark):
    df = frame(spark, [("p", None), (None, "q"), ("r", "s")], "a string, b string")
    assert checksum(df) != checksum(df.selectExpr("b AS a", "a AS b"))


def broken(spark, n=40):
    """A frame whose last rows fail when they are written."""
    fails = F.when(F.col("id") == n - 1, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string"))
    return spark.range(0, n, 1, 8).select(F.col("id").alias("k"), fails.cast("string").alias("v"))


@pytest.fixture
def refs(spark, tmp_path):
    """A path and a catalog table."""
    yield [str(tmp_path / "t"), "loads_t"]
    for name in ("loads_t", "loads_t__next", "loads_t__previous"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_failed_replacement_leaves_the_table(spark, refs):
    for ref in refs:
        old = frame(spark, [(1, "old"), (2, "old")])
        sinks.write_table(old, ref)
        with pytest.raises(Exception, match="broken"):
            sinks.write_table(broken(spark), ref)
        assert values(readers.read_ref(spark, ref)) == [(1, "old"), (2, "old")]
        sinks.write_table(frame(spark, [(3, "new")]), ref)
        assert values(readers.read_ref(spark, ref)) == [(3, "new")]


def test_failed_first_write_leaves_nothing(spark, refs):
    for ref in refs:
        with pytest.raises(Exception, match="broken"):
            sinks.write_table(broken(spark), ref)
        assert not sinks.exists(spark, ref)


@pytest.mark.parametrize("finished", [True, False])
def test_cut_off_between_the_renames(spark, refs, finished):
    """A finished new version is completed, otherwise the old one comes back."""
    for ref in refs:
        sinks.write_table(frame(spark, [(1, "old")]), ref)
        versions = replace._versions(spark, ref)
        if finished:
            versions.write(frame(spark, [(2, "new")]), 0)
        versions.move("", replace.PREVIOUS)
        assert values(readers.read_ref(spark, ref)) == ([(2, "new")] if finished else [(1, "old")])
        assert not versions.has(replace.PREVIOUS) and not versions.has(replace.NEXT)


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, refs):
    for ref in refs:
        sinks.write_table(frame(spark, [(1, "a"), (2, "b")]), ref)
        sinks.write_table(readers.read_ref(spark, ref).filter("k = 2"), ref)
        assert values(readers.read_ref(spark, ref)) == [(2, "b")]


def test_expected_checksum_of_every_mode(spark, refs):
    for ref in refs:
        sinks.write_table(frame(spark, [(9, "gone")]), ref)
        for rows, mode in (([(1, "a")], "replace"), ([(2, "b"), (2, "b")], "append"), ([("x", "c")], "append")):
            df = frame(spark, rows, "k string, v string" if rows[0][0] == "x" else "k bigint, v string")
            expected = sinks.write_table(df, ref, mode, checked=True)
            assert expected == checksum(readers.read_ref(spark, ref))
            assert sinks.verify_content(spark, ref, expected).first()["ok"]
        assert not sinks.verify_content(spark, ref, expected + Checksum(0, 1, 0)).first()["ok"]


STAGED = T.StructType([T.StructField("K", T.LongType()), T.StructField("V", T.StringType())])


def stage(spark, tmp_path, rows):
    return sinks.write_stage(frame(spark, rows, "k string, v string"), str(tmp_path / "stage"), "s")


def test_rejects_are_counted_by_the_load(spark, tmp_path):
    folder, target = stage(spark, tmp_path, [("1", "a"), ("x", "b"), ("3", "c\nd")]), str(tmp_path / "t")
    load = sinks.load_stage(spark, folder, target, STAGED)
    assert (load.rejected, load.added.rows) == (1, 2) and load.added == load.total == checksum(readers.read_ref(spark, target))
    again = sinks.load_stage(spark, folder, target, STAGED, if_exists="append")
    assert (again.added, again.total) == (load.added, load.total + load.total)


@pytest.mark.parametrize("mode", ["replace", "append"])
def test_an_aborted_load_changes_nothing(spark, tmp_path, mode):
    folder, target = stage(spark, tmp_path, [("1", "a"), ("x", "b")]), str(tmp_path / "t")
    with pytest.raises(ValueError, match="do not fit"):
        sinks.load_stage(spark, folder, target, STAGED, if_exists=mode, on_error="abort")
    assert not sinks.exists(spark, target)
    sinks.write_table(frame(spark, [(7, "old")], "K bigint, V string"), target)
    with pytest.raises(ValueError, match="do not fit"):
        sinks.load_stage(spark, folder, target, STAGED, if_exists=mode, on_error="abort")
    assert values(readers.read_ref(spark, target)) == [(7, "old")]
    good = sinks.write_stage(frame(spark, [(1, "a")]), str(tmp_path / "good"), "s")
    sinks.load_stage(spark, good, target, STAGED, if_exists=mode, on_error="abort")
    assert values(readers.read_ref(spark, target)) == [(1, "a"), *([(7, "old")] if mode == "append" else [])]


def test_staged_files_are_parsed_once(spark, tmp_path):
    folder = stage(spark, tmp_path, [(str(i), "a") for i in range(50)])
    read = spark.sparkContext.accumulator(0)
    real = sinks._stage_rows

    def counting(*args):
        read.add(1)
        return real(*args)

    sinks._stage_rows = counting
    try:
        sinks.load_stage(spark, folder, str(tmp_path / "t"), STAGED, on_error="abort")
    finally:
        sinks._stage_rows = real
    assert read.value == 1


def test_migrations_notice_changed_values(spark, tmp_path, monkeypatch):
    source, target = frame(spark, [(i, f"v{i}") for i in range(20)]), str(tmp_path / "t")
    assert migrate.migrate(source, target).first()[:] == (20, 20, True)
    assert migrate.via_stage(source, str(tmp_path / "stage"), "s", target, "append").first()[:] == (20, 20, 0, True)
    real = sinks.replace_table
    changed = lambda df, *args: real(df.withColumn("V", F.when(F.col("K") == 3, "other").otherwise(F.col("V"))), *args)
    monkeypatch.setattr(sinks, "replace_table", changed)
    assert migrate.migrate(source, target).first()[:] == (20, 20, False)
    assert migrate.via_stage(source, str(tmp_path / "more"), "s", target).first()[:] == (20, 20, 0, False)

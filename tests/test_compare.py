import pytest
from pyspark.sql import functions as F

from checks.inputs import frame
from ferrytally.operators import compare
from ferrytally.operators.numbering import first_rows, number_within, profile_keys
from ferrytally.plans.report import compare_tables, compare_with_csv, executive_summary, schema_diff

SCHEMA = "id string, day string, amount double"
ROWS = [("C001", "2024-01-01", 100.5), ("C002", "2024-01-02", 200.75), ("C003", "2024-01-03", 150.25)]


def frame_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def one(df):
    return df.first().asDict()


def test_table_matches_itself(spark):
    df = frame_of(spark, ROWS)
    s = one(compare_tables(df, df, ["id", "day"]).summary)
    assert s["overall_match"] and s["status"] == "PERFECT MATCH" and s["common_rows"] == 3


def test_null_key_matches_null_key_and_blank_does_not(spark, rows):
    left = frame_of(spark, [(None, "a", 1.0), ("", "a", 2.0)])
    right = frame_of(spark, [(None, "a", 1.0), (" ", "a", 2.0)])
    sides = compare.compare_join(left, right, ["id", "day"]).select("id", "side")
    assert rows(sides) == [(None, "both"), ("", "left_only"), (" ", "right_only")]


def test_nan_equals_nan_and_null(spark, rows):
    left = frame_of(spark, [("a", "d", float("nan")), ("b", "d", None), ("c", "d", float("nan"))])
    right = frame_of(spark, [("a", "d", float("nan")), ("b", "d", float("nan")), ("c", "d", 1.0)])
    stats = compare.column_stats(left, right, ["id", "day"])
    assert rows(stats) == [("amount", 2, 1, False, 0.0, 1)]


def test_nan_key(spark):
    left = spark.createDataFrame([(float("nan"), 1), (None, 2)], "k double, v int")
    s = one(compare_tables(left, left, ["k"]).summary)
    assert (s["common_rows"], s["left_duplicate_rows"]) == (2, 2)


def test_duplicate_keys_pair_by_occurrence(spark):
    left = frame_of(spark, [("a", "d", 1.0), ("a", "d", 2.0), ("a", "d", 3.0)])
    right = frame_of(spark, [("a", "d", 1.0), ("a", "d", 9.0)])
    s = one(compare_tables(left, right, ["id", "day"]).summary)
    assert (s["common_rows"], s["left_only_rows"], s["rows_with_differences"]) == (2, 1, 1)
    assert (s["left_duplicate_rows"], s["right_duplicate_rows"]) == (3, 2)


def test_tolerance(spark):
    left = frame_of(spark, [("a", "d", 100.0), ("b", "d", 100.0)])
    right = frame_of(spark, [("a", "d", 100.9), ("b", "d", 102.0)])
    stats = one(compare.column_stats(left, right, ["id", "day"], 0.01, 0.01))
    assert (stats["match_cnt"], stats["unequal_cnt"], stats["max_diff"]) == (1, 1, 2.0)


def test_column_names_match_in_any_case_and_types_may_differ(spark):
    left = spark.createDataFrame([(1, "7"), (2, "8")], "Key bigint, V string")
    right = spark.createDataFrame([("1", 7), ("2", 9)], "KEY string, v int")
    report = compare_tables(left, right, ["key"])
    s = one(report.summary)
    assert (s["common_rows"], s["rows_with_differences"], s["schema_match"]) == (2, 1, False)


@pytest.mark.parametrize("repeated", [False, True])
def test_odd_column_names(spark, repeated):
    data = [(1, 2.0), (1 if repeated else 2, 3.0)]
    df = spark.createDataFrame(data, ["Customer ID.x", "Total `Amount`"])
    s = one(compare_tables(df, df, ["Customer ID.x"]).summary)
    assert s["overall_match"] and s["common_rows"] == 2
    assert compare.left_only(df, df, ["Customer ID.x"]).count() == 0
    s = one(compare_tables(df, df, ["Customer ID.x"], hot_rows=1).summary)
    assert s["overall_match"]


def test_mixed_types_on_repeated_keys(spark):
    left = spark.createDataFrame([(1, "1"), (1, "2")], "k int, v string")
    right = spark.createDataFrame([(1, 1), (1, 3)], "k int, v int")
    s = one(compare_tables(left, right, ["k"]).summary)
    assert (s["common_rows"], s["rows_with_differences"]) == (2, 1)


def test_empty_sides(spark):
    df, empty = frame_of(spark, ROWS), frame_of(spark, [])
    s = one(compare_tables(df, empty, ["id", "day"]).summary)
    assert (s["left_only_rows"], s["percentage"], s["overall_match"]) == (3, 100.0, False)
    s = one(compare_tables(empty, empty, ["id", "day"]).summary)
    assert s["overall_match"] and s["is_negligible"]


def test_key_only_tables(spark):
    df = frame_of(spark, ROWS).select("id")
    assert one(compare_tables(df, df, ["id"]).summary)["overall_match"]
    assert compare.column_stats(df, df, ["id"]).count() == 0


def test_left_only_mirrors_right_only(spark, sf):
    left, right = frame(spark, sf, "lineitem"), frame(spark, sf, "right_lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    a, b = compare.left_only(left, right, keys), compare.right_only(right, left, keys)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    s = one(compare_tables(left, right, keys).summary)
    assert s["left_rows"] == left.count() == s["common_rows"] + s["left_only_rows"]
    assert s["right_rows"] == right.count() and a.count() == s["left_only_rows"]


@pytest.mark.parametrize("hot_rows", [100, 1000, 100_000])
def test_hot_keys_change_the_plan_but_not_the_result(spark, sf, hot_rows):
    left, right = frame(spark, sf, "hot_left"), frame(spark, sf, "hot_right")
    plain = one(compare_tables(left, right, ["l_orderkey"]).summary)
    assert one(compare_tables(left, right, ["l_orderkey"], hot_rows=hot_rows).summary) == plain
    stats = compare.column_stats(left, right, ["l_orderkey"])
    hot = compare.column_stats(left, right, ["l_orderkey"], hot_rows=hot_rows)
    assert stats.exceptAll(hot).isEmpty()


def test_identical_copies_of_a_hot_row(spark):
    """5,000 equal rows under one key: numbered 1..5000 through bounded chunks."""
    df = spark.range(5000).select(F.lit("k").alias("k"), F.lit(1).alias("v")).unionByName(
        spark.range(3).select(F.lit("k").alias("k"), F.lit(0).alias("v"))
    )
    numbered = number_within(df, ["k"], ["v"], "n", hot_rows=100)
    assert numbered.agg(F.count("n"), F.countDistinct("n"), F.min("n"), F.max("n")).first()[:] == (5003, 5003, 1, 5003)
    assert numbered.filter("v = 0").agg(F.max("n")).first()[0] == 3


def test_injected_changes_are_all_reported(spark, sf):
    left = frame(spark, sf, "orders")
    changed = left.withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 50 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    ).filter("o_orderkey % 100 <> 3")
    s = one(compare_tables(left, changed, ["o_orderkey"]).summary)
    expected = left.filter("o_orderkey % 50 = 7 AND o_orderkey % 100 <> 3").count()
    assert s["rows_with_differences"] == expected and s["columns_with_differences"] == 1
    assert s["left_only_rows"] == left.filter("o_orderkey % 100 = 3").count()


def test_sample_does_not_depend_on_partitioning(spark, sf):
    left, right = frame(spark, sf, "orders"), frame(spark, sf, "right_orders")
    a = one(compare_tables(left, right, ["o_orderkey"], sample="auto").summary)
    b = one(compare_tables(left.repartition(13), right.repartition(3, "o_custkey"), ["o_orderkey"], sample="auto").summary)
    assert a == b and a["left_rows"] == left.count()


@pytest.mark.parametrize("method", ["ordered", "first", "random"])
def test_sampling_methods(spark, sf, method):
    left = frame(spark, sf, "orders")
    s = one(compare_tables(left, left, ["o_orderkey"], sample=100, method=method).summary)
    assert s["common_rows"] == 100 and s["overall_match"]


def test_transform_and_schema_options(spark):
    left = spark.createDataFrame([("1", "5.0"), ("2", "6")], ["Order No. 1", "Amount $"])
    right = spark.createDataFrame([("1", "5"), ("2", "6.00")], ["ORDER_NUMBER_1", "AMOUNT_$"])
    s = one(compare_tables(left, right, ["Order No. 1"], transform=True, schema="AMOUNT_$:NUMBER").summary)
    assert s["overall_match"] and s["common_rows"] == 2


def test_csv_verdict_uses_text_keys(spark):
    left = spark.createDataFrame([("01", 1.0)], "k string, v double")
    right = spark.createDataFrame([(1, 1.0)], "k int, v double")
    s = one(compare_with_csv(left, right, ["k"]).summary)
    assert (s["common_rows"], s["schema_match"]) == (0, False)


def test_profile(spark):
    left = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (2,)], "k int")
    profile = profile_keys([left, right], ["k"], hot_rows=2)
    assert (profile.largest, profile.hot_keys, profile.has_null) == (2, 1, True)


def test_first_rows_large_equals_small(spark, sf):
    lines = frame(spark, sf, "lineitem")
    order = [F.col("l_shipdate"), F.col("l_quantity")]
    direct = first_rows(lines, order, 1200)
    spread = first_rows(lines, order, 1200, direct_limit=100)
    assert direct.exceptAll(spread).isEmpty() and spread.count() == 1200
    assert first_rows(lines, order, 10**6, direct_limit=100).count() == lines.count()
    customers = frame(spark, sf, "left_customer")
    last = first_rows(customers, [F.col("c_custkey")], 30, nulls_last=True, direct_limit=10)
    assert last.filter("c_custkey IS NULL").isEmpty() and last.count() == 30


def test_schema_diff(spark):
    left = spark.createDataFrame([], "a string, b bigint, c double, d timestamp_ntz, only_left int")
    right = spark.createDataFrame([], "a string, b string, c double, d date, only_right int")
    diff = schema_diff(left, right)
    assert diff.missing == ["only_left"] and diff.extra == ["only_right"]
    assert [m[0] for m in diff.mismatches] == ["b"]
    assert [m[0] for m in schema_diff(left, right, exact=True).mismatches] == ["b", "d"]


def test_summary_bands(spark):
    left = spark.createDataFrame([(i, 1.0, "x", "y") for i in range(100)], "k int, v double, _batch_id_ string, t string")
    right = left.drop("_batch_id_").filter("k < 97").withColumn("t", F.lit("z"))
    lines = {r["ordinal"]: r for r in executive_summary(compare_tables(left, right, ["k"]), "a -> b").collect()}
    assert lines[4]["severity"] == "warn" and "3.00% difference" in lines[4]["text"]
    assert lines[5]["severity"] == "ok" and lines[6]["severity"] == "ok"
    assert lines[13]["text"] == "Rows missing on the right: 3"
    assert lines[15]["text"].endswith("t")
    reference = executive_summary(compare_tables(left, right, ["k"]), differing="reference")
    assert reference.filter("ordinal = 15").first()["text"] == "All values matched"

import pytest
from pyspark.sql import functions as F

from ferrytally.functions import bands, cells, names, types
from ferrytally.operators import cleaning, control, counts, sampling
from ferrytally.operators.scoring import length_minutes


def apply(spark, rule, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_transform_name(spark):
    given = ["Customer ID", "order date", "Customer-ID", "123Numbers", "Order #", "Total $ Amount", "No. of x", "a&b?"]
    want = ["CUSTOMER_ID", "ORDER_DATE", "CUSTOMER_ID", "123NUMBERS", "ORDER_NUMBER", "TOTAL_$_AMOUNT", "NUMBER_OF_X", "AANDB"]
    assert apply(spark, names.transform_name, given) == want


@pytest.mark.parametrize("rule", [names.transform_name, names.warehouse_name, names.identifier, names.stage_alias,
                                  names.match_key, names.source_identifier])
def test_name_rules_are_idempotent(spark, rule):
    given = ["", " ", "#", "a  b", "No. 1", "Ünï cödé", "__x__", "(a)/b.c?", "ORDER", "1 $ x", "a\tb", "é" * 300, "-_-"]
    once = apply(spark, rule, given)
    assert apply(spark, rule, once) == once


def test_other_name_rules(spark):
    assert apply(spark, names.warehouse_name, ["Order #", "", "$$", "a--b"]) == ["ORDER_NUMBER", "UNNAMED_COLUMN", "UNNAMED_COLUMN", "A_B"]
    assert apply(spark, names.identifier, ["a b", "!!", "x" * 300]) == ["A_B", "UNNAMED", "X" * 255]
    assert apply(spark, names.is_reserved, ["Order", "orders", "LIMIT"]) == [True, False, True]
    df = spark.createDataFrame(
        [("a-1", "Sales Data with Spaces"), ("a-1", " "), ("1.x_", None), ("id", "Unknown"), ("z", "9 lives"), ("z", "a" * 300)],
        "id string, name string",
    )
    got = [r[0] for r in df.select(names.table_name(F.col("id"), F.col("name"))).collect()]
    assert got == ["sales_data_with_spaces", "a_1", "id_1_x", "id", "tbl_9_lives", "a" * 240]


def test_rename_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["BRAND", "BRAND_", "brand "])
    assert names.rename_columns(df).columns == ["BRAND", "BRAND_1", "BRAND_2"]
    assert names.rename_columns(df, names.warehouse_name).columns == ["BRAND", "BRAND_1", "BRAND_2"]
    clash = spark.createDataFrame([(1, 2, 3)], ["a_1", "a", "a "])
    assert names.rename_columns(clash, names.warehouse_name).columns == ["A_1", "A", "A_2"]
    assert names.rename_columns(clash).columns == ["A_1", "A", "A_2"]
    late = spark.createDataFrame([(1, 2, 3, 4)], ["a", "a ", "a_1", "a_1 "])
    assert names.rename_columns(late).columns == ["A", "A_2", "A_1", "A_1_1"]


def test_sample_size(spark):
    assert [bands.sample_size_of(n) for n in (0, 500, 1000, 10_000, 100_000)] == [0, 500, 1000, 370, 383]
    df = spark.createDataFrame([(500,), (10_000,), (100_000,)], "n bigint")
    assert [r[0] for r in df.select(bands.sample_size(F.col("n"))).collect()] == [500, 370, 383]


@pytest.mark.parametrize(("left", "right", "negligible", "pct", "reason"), [
    (0, 0, True, 0.0, "Both datasets are empty"),
    (0, 1000, False, 100.0, "One dataset is empty"),
    (1000, 1500, False, 100 / 3, "Significant difference: 500 rows (33.333%)"),
    (10000, 10005, True, 5 / 10005 * 100, "Very small absolute difference (5 rows)"),
    (100000, 100090, True, 90 / 100090 * 100, "Very small percentage difference (0.090%)"),
    (10000, 10050, True, 50 / 10050 * 100, "Small percentage difference for large dataset (0.498%)"),
    (5000, 5030, False, 30 / 5030 * 100, "Significant difference: 30 rows (0.596%)"),
])
def test_count_bands(spark, left, right, negligible, pct, reason):
    row = counts.row_count_diff(spark.range(left), spark.range(right)).first()
    assert (row["is_negligible"], row["reason"], row["difference"]) == (negligible, reason, right - left)
    assert row["percentage"] == pytest.approx(pct)


def test_type_rules(spark):
    pairs = [("STRING", "VARCHAR"), ("LONG", "INTEGER"), ("DOUBLE", "FLOAT"), ("DATETIME", "timestamp_ntz"), ("WHAT", "ANY"), ("LONG", "VARCHAR")]
    df = spark.createDataFrame(pairs, "l string, r string")
    got = [r[0] for r in df.select(types.types_compatible(F.col("l"), F.col("r"))).collect()]
    assert got == [True] * 5 + [False] == [types.is_compatible(a, b) for a, b in pairs]
    assert apply(spark, types.cast_type, ["date", "LONG", "Decimal", "TEXT", "x"]) == ["timestamp", "number", "float", "text", "varchar(16777216)"]


def test_parsing(spark):
    assert apply(spark, types.as_double, ["1", " 2.5 ", "1e3", "nan", "1d", "0x1", "inf", "", None]) == [1.0, 2.5, 1000.0, None, None, None, float("inf"), None, None]
    assert apply(spark, types.as_long, ["1", "9007199254740993", "2.0", "2.5", "x"]) == [1, 9007199254740993, 2, None, None]
    stamps = apply(spark, types.as_timestamp, ["2024-01-15", "2024-01-15T10:20", "01/15/2024", "2024", "2024-13-01", "x"])
    assert [s and s.isoformat() for s in stamps] == ["2024-01-15T00:00:00", "2024-01-15T10:20:00", "2024-01-15T00:00:00", None, None, None]
    assert apply(spark, types.as_boolean, ["TRUE", "no", "0", "x"]) == [True, False, False, None]


def test_cells(spark):
    assert apply(spark, cells.mask_prefix, ["secret", "ab", "", None]) == ["se****", "***", "***", "***"]
    assert apply(spark, cells.mask_middle, ["1234567", "123456"]) == ["123*567", "***"]
    assert apply(spark, cells.split_ids, ["a,\nb,,c \n", None, " "]) == [["a", "b", "c"], [], []]
    assert apply(spark, cells.clean_ids, ["b,a,\nb", ""]) == ["a,\nb", ""]
    sci = ["5.942683660313343e+17", "1.5e+00", "-2.5e+0", "1e5", "1.0e+30", "x"]
    assert apply(spark, cells.fix_scientific, sci)[:4] == ["594268366031334272", "2", "-2", "1e5"]
    assert apply(spark, cells.blank_to_null, ["", "\t ", "a"]) == [None, None, "a"]


def test_schema_string():
    parsed = cleaning.parse_schema("ID:TEXT, DATE:date,AMOUNT:NUMBER,EXACT:DECIMAL(18,2),odd,FLAG:BOOL,X:WHAT")
    assert parsed == {"ID": "string", "DATE": "timestamp_ntz", "AMOUNT": "double", "EXACT": "decimal(18,2)", "FLAG": "boolean", "X": "string"}


def test_apply_schema_exact_decimal_and_bad_values(spark):
    df = spark.createDataFrame([("1", "0.10", "x", "False"), (None, "bad", None, "maybe")], ["id", "a", "d", "b"])
    got = [tuple(r) for r in cleaning.apply_schema(df, "a:DECIMAL(10,2),d:DATE,b:BOOLEAN", ["id"]).collect()]
    assert str(got[0][1]) == "0.10" and got[0][2:] == (None, False) and got[1] == ("", None, None, None)


def test_auto_types_order(spark):
    df = spark.createDataFrame([("1", "yes", "2024-01-01"), ("0", "NO", "2024-01-02"), (None, None, None)], [" n", "b ", "d"])
    out = cleaning.auto_types(df)
    assert dict(out.dtypes) == {"n": "double", "b": "boolean", "d": "timestamp_ntz"} and out.count() == 2


def test_infer_logical_types_sampled(spark):
    df = spark.createDataFrame([(1, "5", "5", "2024-01-01"), (2, "x", "6", "y")], "k int, price string, other string, d string")
    got = {r["name"]: r["logical_type"] for r in cleaning.logical_types(df, 1, ["k"]).collect()}
    assert got == {"k": "LONG", "price": "DOUBLE", "other": "STRING", "d": "DATETIME"}


def test_length_minutes(spark):
    cases = [("Filter", 499, 0, 0.0), ("Filter", 1000, 0, 1.5), ("Filter", 10**6, 0, 15.0), ("Filter", 0, 1700, 1.0),
             ("Filter", 0, 10**6, 12.0), ("Filter", 0, 0, 0.0), ("SelectValues", 10**6, 0, 0.0)]
    df = spark.createDataFrame(cases, "t string, c bigint, f bigint, want double")
    assert all(r[0] == r[1] for r in df.select(length_minutes(F.col("t"), F.col("c"), F.col("f")), "want").collect())


def test_control_helpers(spark):
    df = spark.createDataFrame([("a", "Not Migrated"), ("b", None), ("c", "MIGRATED")], "id string, status string")
    assert [r["id"] for r in control.pending(df).collect()] == ["b"]
    with pytest.raises(ValueError):
        control.standardize(df, [control.Field("table_name", ["Model Name"], required=True)])
    typed = control.standardize(df.select("id"), control.MIGRATION)
    assert typed.first()[1:] == ("Unknown", "Pending")
    ids = spark.createDataFrame([("", "df_002"), (None, "df_001"), ("x", " df_001 "), ("y", "")], "a string, f string")
    assert sorted(r[0] for r in control.unique_ids(ids, "f").collect()) == ["df_001", "df_002"]
    kept = control.exclude_ids(ids, spark.createDataFrame([("zzz",)], ["other"]), "f")
    assert kept.count() == 4


def test_key_lookup_blank_and_null(spark, rows):
    df = spark.createDataFrame([("a", ""), ("a", None), ("a", " "), ("b", "x"), (None, "x")], "k string, j string")
    blank = spark.createDataFrame([("a", "  ")], "k string, j string")
    assert rows(sampling.rows_for_keys(df, blank, ["k", "j"])) == [("a", None), ("a", "")]
    null = spark.createDataFrame([(None, "x")], "k string, j string")
    assert rows(sampling.rows_for_keys(df, null, ["k", "j"])) == [(None, "x")]
    single = spark.createDataFrame([("b",), (None,)], "k string")
    assert rows(sampling.rows_for_keys(df, single, ["k"])) == [("b", "x")]


def test_random_rows(spark):
    assert sampling.random_rows(spark.range(1000), 10).count() == 10
    assert sampling.random_rows(spark.range(300_000), 150_000).distinct().count() == 150_000

"""Type inference, schema enforcement, cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import frame, oracle
from checks.registry import query
from ferrytally.columns import col
from ferrytally.functions import cells
from ferrytally.operators import cleaning
from ferrytally.operators.schema import load_schema

TEXTS = ["mostly_number", "some_price", "iso_date", "yes_no", "padded", "scientific"]
NUMBER = "'^\\s*[+-]?(([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\\s*$'"
DATE = "'^[0-9]{4}-[0-9]{2}-[0-9]{2}$'"


def number_sql(c):
    return f"CASE WHEN regexp_matches({c}, {NUMBER}) THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def date_sql(c):
    return f"CASE WHEN regexp_matches(trim({c}), {DATE}) THEN TRY_CAST(trim({c}) AS TIMESTAMP) END"


def bool_sql(c):
    return f"CASE WHEN lower({c}) IN ('true', '1', 'yes') THEN true WHEN lower({c}) IN ('false', '0', 'no') THEN false END"


def shares(c):
    """One-row table of what a column's values look like, ``(v, n, d, b)``."""
    return f"""(SELECT count({c}) AS v, count({number_sql(c)}) AS n, count({date_sql(c)}) AS d,
  count(*) FILTER ({c} IS NOT NULL AND {bool_sql(c)} IS NULL) = 0 AND count(DISTINCT {c}) <= 2 AND count({c}) > 0 AS b FROM dirty_text)"""


def fingerprint(df, names):
    """Type and text of each column, so that a result does not change shape with its types."""
    out = [F.col("o_orderkey")]
    for name in names:
        out += [F.lit(df.schema[name].dataType.simpleString()).alias(f"{name}_type")]
        c = col(name)
        if isinstance(df.schema[name].dataType, T.DoubleType):
            c = c.cast("decimal(20,2)")
        out += [c.cast("string").alias(f"{name}_text")]
    return df.select(*out)


def inferred_sql(steps):
    parts = ["o_orderkey"]
    for c in TEXTS:
        kind, text = "'string'", c
        branches = []
        if "numeric" in steps:
            branches.append((f"(SELECT v > 0 AND n >= 0.8 * v FROM {shares(c)})", "'double'",
                             f"CAST(CAST({number_sql(c)} AS DECIMAL(20,2)) AS VARCHAR)"))
        if "datetime" in steps:
            branches.append((f"(SELECT v > 0 AND d >= 0.8 * v FROM {shares(c)})", "'timestamp_ntz'",
                             f"CAST({date_sql(c)} AS VARCHAR)"))
        if "boolean" in steps:
            branches.append((f"(SELECT b FROM {shares(c)})", "'boolean'", f"CAST({bool_sql(c)} AS VARCHAR)"))
        kind_sql = " ".join(f"WHEN {cond} THEN {k}" for cond, k, _ in branches)
        text_sql = " ".join(f"WHEN {cond} THEN {t}" for cond, _, t in branches)
        parts += [f"CASE {kind_sql} ELSE {kind} END AS {c}_type", f"CASE {text_sql} ELSE {text} END AS {c}_text"]
    return f"SELECT {', '.join(parts)} FROM dirty_text"


def dirty(spark, sf):
    return frame(spark, sf, "dirty_text")


@query("infer_numeric", oracle(["dirty_text"], inferred_sql(["numeric"])))
def infer_numeric(spark, sf):
    return fingerprint(cleaning.infer_numeric(dirty(spark, sf)), TEXTS)


@query("infer_datetime", oracle(["dirty_text"], inferred_sql(["datetime"])))
def infer_datetime(spark, sf):
    return fingerprint(cleaning.infer_datetime(dirty(spark, sf)), TEXTS)


_FORMS = {
    "zone": ("%Y-%m-%dT00:00:00Z", "yyyy-MM-dd'T00:00:00Z'"), "us_time": ("%m/%d/%Y 10:20:30", "MM/dd/yyyy' 10:20:30'"),
    "slash": ("%Y/%m/%d", "yyyy/MM/dd"), "name_day": ("%d-%b-%Y", "dd-MMM-yyyy"), "name_us": ("%b %d, %Y", "MMM dd, yyyy"),
}


@query("infer_datetime_forms", "SELECT o_orderkey, " + ", ".join(
    f"'timestamp_ntz' AS {n}_type, CAST(date_trunc('day', o_orderdate){' + INTERVAL 37230 SECOND' if n == 'us_time' else ''} AS VARCHAR) AS {n}_text"
    for n in _FORMS) + " FROM orders")
def infer_datetime_forms(spark, sf):
    """Dates with a zone, with slashes, with month names, and month/day/year with a time."""
    orders = frame(spark, sf, "orders")
    texts = orders.select("o_orderkey", *[F.date_format("o_orderdate", f).alias(n) for n, (_, f) in _FORMS.items()])
    return fingerprint(cleaning.infer_datetime(texts), list(_FORMS))


@query("infer_boolean", oracle(["dirty_text"], inferred_sql(["boolean"])))
def infer_boolean(spark, sf):
    return fingerprint(cleaning.infer_boolean(dirty(spark, sf)), TEXTS)


@query("auto_types", oracle(["dirty_text"], inferred_sql(["numeric", "datetime", "boolean"])))
def auto_types(spark, sf):
    padded = dirty(spark, sf).withColumnRenamed("yes_no", " yes_no ")
    return fingerprint(cleaning.auto_types(padded), TEXTS)


@query("derive_load_schema", oracle(["dirty_text"], "SELECT 1 AS ordinal, 'o_orderkey' AS name, 'INTEGER' AS ddl_type" + "".join(
    f"""\nUNION ALL SELECT {i}, '{c}', CASE WHEN v > 0 AND n >= 0.8 * v THEN 'FLOAT' WHEN v > 0 AND d >= 0.8 * v THEN 'TIMESTAMP'
  WHEN b THEN 'BOOLEAN' ELSE 'VARCHAR(16777216)' END FROM {shares(c)}""" for i, c in enumerate(TEXTS, 2))))
def derive_load_schema(spark, sf):
    return load_schema(cleaning.auto_types(dirty(spark, sf)))


@query("null_count_introduced", oracle(["dirty_text"], """
SELECT 'mostly_number' AS "column", count(*) FILTER (mostly_number = 'n/a') AS introduced_nulls FROM dirty_text
UNION ALL SELECT 'iso_date', count(*) FILTER (iso_date = 'junk') FROM dirty_text
UNION ALL SELECT 'yes_no', count(*) FILTER (lower(yes_no) NOT IN ('yes', 'no')) FROM dirty_text"""))
def null_count_introduced(spark, sf):
    rows = dirty(spark, sf)
    return cleaning.null_counts_introduced(rows, cleaning.conversions(rows))


@query("infer_logical_type", oracle(["dirty_text"], "\nUNION ALL ".join(
    f"""SELECT {i} AS ordinal, '{c}' AS name, t AS logical_type,
  CASE t WHEN 'LONG' THEN 'number' WHEN 'DOUBLE' THEN 'float' WHEN 'DATETIME' THEN 'timestamp' ELSE 'varchar(16777216)' END AS warehouse_type
FROM (SELECT {"'LONG'" if c == 'o_orderkey' else f"CASE WHEN v > 0 AND d >= 0.8 * v THEN 'DATETIME' WHEN v > 0 AND n >= 0.8 * v AND {str('price' in c or 'number' in c).lower()} THEN 'DOUBLE' ELSE 'STRING' END"} AS t
  FROM {shares(c if c != 'o_orderkey' else 'padded')})""" for i, c in enumerate(["o_orderkey", *TEXTS], 1))))
def infer_logical_type(spark, sf):
    return cleaning.logical_types(dirty(spark, sf))


@query("infer_logical_type_stray", """SELECT 1 AS ordinal, 'note' AS name, 'STRING' AS logical_type, 'varchar(16777216)' AS warehouse_type FROM (SELECT count(*) FROM orders)
UNION ALL SELECT 2, 'day', 'DATETIME', 'timestamp'""")
def infer_logical_type_stray(spark, sf):
    """One date among texts leaves the column text; a column of dates with one stray text is one of dates."""
    orders = frame(spark, sf, "orders")
    first = orders.agg(F.min("o_orderkey")).first()[0]
    stray = F.col("o_orderkey") == first
    return cleaning.logical_types(orders.select(
        F.when(stray, "2024-01-01").otherwise(F.col("o_orderpriority")).alias("note"),
        F.when(stray, "none").otherwise(F.col("o_orderdate").cast("string")).alias("day"),
    ))


SCIENTIFIC = "'^-?[0-9]+\\.[0-9]+e[+-][0-9]+$'"
FIXED = f"""CASE WHEN regexp_matches(scientific, {SCIENTIFIC})
  THEN CAST(CAST(round_even(CAST(scientific AS DOUBLE), 0) AS BIGINT) AS VARCHAR) ELSE scientific END"""


@query("fix_scientific", oracle(["dirty_text"], f"SELECT o_orderkey, scientific, {FIXED} AS fixed FROM dirty_text"))
def fix_scientific(spark, sf):
    return dirty(spark, sf).select("o_orderkey", "scientific", cells.fix_scientific(F.col("scientific")).alias("fixed"))


@query("apply_schema", oracle(["dirty_text"], f"""
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {number_sql('mostly_number')} AS mostly_number,
  TRY_CAST(some_price AS BIGINT) AS some_price, {date_sql('iso_date')} AS iso_date, {bool_sql('yes_no')} AS yes_no,
  coalesce(padded, '') AS padded,
  CASE WHEN scientific IS NULL OR scientific = 'nan' THEN '' ELSE {FIXED} END AS scientific FROM dirty_text"""))
def apply_schema(spark, sf):
    declared = ("mostly_number:NUMBER, some_price:INT,iso_date:DATE,yes_no:BOOL,padded:VARCHAR,scientific:TEXT,"
                "absent:DATE,ignored")
    return cleaning.apply_schema(dirty(spark, sf), declared, keys=["o_orderkey"])


@query("coerce_on_type_error", oracle(["dirty_text"], """
SELECT o_orderkey, mostly_number, some_price, TRY_CAST(nullif(trim(yes_no), '') AS BOOLEAN) AS yes_no FROM dirty_text"""))
def coerce_on_type_error(spark, sf):
    target = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("mostly_number", T.DoubleType()),
        T.StructField("some_price", T.LongType()), T.StructField("yes_no", T.BooleanType()),
    ])
    return cleaning.coerce_failing_to_string(
        dirty(spark, sf).select("o_orderkey", "mostly_number", "some_price", "yes_no"), target
    )


@query("blank_to_null", oracle(["dirty_text"], """
SELECT o_orderkey, CASE WHEN trim(padded) <> '' THEN padded END AS padded FROM dirty_text"""))
def blank_to_null(spark, sf):
    return cleaning.blank_to_null(dirty(spark, sf).select("o_orderkey", "padded"))


@query("drop_empty_rows", oracle(["sparse_rows"], "SELECT * FROM sparse_rows WHERE a IS NOT NULL OR b IS NOT NULL"))
def drop_empty_rows(spark, sf):
    return cleaning.drop_empty_rows(frame(spark, sf, "sparse_rows"))


@query("mask_columns", """
SELECT c_custkey, CASE WHEN length(c_name) > 2 THEN substr(c_name, 1, 2) || repeat('*', length(c_name) - 2) ELSE '***' END AS prefixed,
  CASE WHEN length(c_mktsegment) > 6 THEN substr(c_mktsegment, 1, 3) || repeat('*', length(c_mktsegment) - 6) || right(c_mktsegment, 3) ELSE '***' END AS middled,
  CASE WHEN length(CAST(c_nationkey AS VARCHAR)) > 1 THEN substr(CAST(c_nationkey AS VARCHAR), 1, 1) || repeat('*', length(CAST(c_nationkey AS VARCHAR)) - 1) ELSE '***' END AS short
FROM customer""")
def mask_columns(spark, sf):
    rows = frame(spark, sf, "customer").select(
        "c_custkey", F.col("c_name").alias("prefixed"), F.col("c_mktsegment").alias("middled"),
        F.col("c_nationkey").alias("short"),
    )
    masked = cleaning.mask_columns(rows, ["prefixed"])
    return cleaning.mask_columns(cleaning.mask_columns(masked, ["middled"], "middle"), ["short"], visible=1)

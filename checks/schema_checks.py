"""Schema operators over a catalog of column tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks.inputs import TABLES, frame, oracle
from checks.name_checks import TRANSFORM
from checks.registry import query
from ferrytally.functions.types import cast_type
from ferrytally.operators import schema
from ferrytally.plans.stage_models import stage_models

COLUMNS = ["left_columns", "right_columns"]
COMPATIBLE_SQL = """CASE left_type
  WHEN 'STRING' THEN regexp_matches(upper(right_type), '^(VARCHAR|STRING|TEXT|CHAR)')
  WHEN 'LONG' THEN regexp_matches(upper(right_type), '^(NUMBER|INTEGER|BIGINT|INT)')
  WHEN 'DOUBLE' THEN regexp_matches(upper(right_type), '^(FLOAT|DOUBLE|DECIMAL|NUMERIC)')
  WHEN 'DATETIME' THEN regexp_matches(upper(right_type), '^(TIMESTAMP|DATETIME|DATE)') ELSE true END"""
CAST_SQL = """CASE WHEN upper({0}) IN ('DATETIME', 'DATE', 'TIMESTAMP') THEN 'timestamp' WHEN upper({0}) IN ('DOUBLE', 'DECIMAL') THEN 'float'
  WHEN upper({0}) = 'LONG' THEN 'number' WHEN upper({0}) = 'TEXT' THEN 'text' ELSE 'varchar(16777216)' END"""


def join_sql(name="name"):
    def side(t, kind):
        return f"SELECT dataset, {name} AS name, arg_max(type, ordinal) AS {kind} FROM {t} GROUP BY ALL"

    return f"""WITH sl AS ({side('left_columns', 'left_type')}), sr AS ({side('right_columns', 'right_type')}),
s AS (SELECT *, CASE WHEN right_type IS NULL THEN 'missing' WHEN left_type IS NULL THEN 'extra' ELSE 'common' END AS status
  FROM sl FULL JOIN sr USING (dataset, name))"""


def pair(spark, sf):
    return frame(spark, sf, "left_columns"), frame(spark, sf, "right_columns")


@query("schema_join", oracle(COLUMNS, join_sql() + " SELECT * FROM s"))
def schema_join(spark, sf):
    return schema.schema_join(*pair(spark, sf))


@query("schema_join_transformed", oracle(COLUMNS, join_sql(TRANSFORM.replace("raw_name", "name")) + " SELECT * FROM s"))
def schema_join_transformed(spark, sf):
    return schema.schema_join(*pair(spark, sf), transform=True)


@query("type_mismatches", oracle(COLUMNS, join_sql() + f"""
SELECT dataset, name, left_type, right_type FROM s WHERE status = 'common' AND NOT {COMPATIBLE_SQL}"""))
def type_mismatches(spark, sf):
    return schema.type_mismatches(*pair(spark, sf))


@query("type_mismatches_exact", oracle(COLUMNS, join_sql() + """
SELECT dataset, name, left_type, right_type FROM s WHERE status = 'common' AND left_type <> right_type"""))
def type_mismatches_exact(spark, sf):
    return schema.type_mismatches_exact(*pair(spark, sf))


@query("schema_summary", oracle(COLUMNS, join_sql() + f""",
c AS (SELECT dataset, count(left_type) AS left_columns, count(right_type) AS right_columns,
  count(*) FILTER (status = 'common') AS common_columns, count(*) FILTER (status = 'missing') AS missing_columns,
  count(*) FILTER (status = 'extra') AS extra_columns,
  count(*) FILTER (status = 'common' AND NOT {COMPATIBLE_SQL}) AS type_mismatches FROM s GROUP BY dataset)
SELECT *, missing_columns = 0 AND extra_columns = 0 AND type_mismatches = 0 AS schema_match FROM c"""))
def schema_summary(spark, sf):
    return schema.schema_summary(*pair(spark, sf))


@query("column_set_diff", oracle(COLUMNS, """
SELECT dataset, name, 'left_only' AS part FROM (SELECT dataset, name FROM left_columns EXCEPT SELECT dataset, name FROM right_columns)
UNION ALL SELECT dataset, name, 'right_only' FROM (SELECT dataset, name FROM right_columns EXCEPT SELECT dataset, name FROM left_columns)
UNION ALL SELECT dataset, name, 'both' FROM (SELECT dataset, name FROM left_columns INTERSECT SELECT dataset, name FROM right_columns)"""))
def column_set_diff(spark, sf):
    return schema.column_sets(*pair(spark, sf))


@query("combine_schemas", oracle(COLUMNS, """
SELECT dataset, ordinal, name, type FROM left_columns
UNION ALL
SELECT dataset, coalesce(last, 0) + row_number() OVER (PARTITION BY dataset ORDER BY o), name, type
FROM (SELECT dataset, name, min(ordinal) AS o, arg_min(type, ordinal) AS type FROM right_columns r
  WHERE NOT EXISTS (SELECT 1 FROM left_columns l WHERE l.dataset = r.dataset AND l.name = r.name) GROUP BY ALL)
LEFT JOIN (SELECT dataset, max(ordinal) AS last FROM left_columns GROUP BY dataset) USING (dataset)"""))
def combine_schemas(spark, sf):
    return schema.combine_schemas(*pair(spark, sf))


@query("concat_batches", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders WHERE o_orderkey % 3 = 0""")
def concat_batches(spark, sf):
    orders = frame(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return schema.concat_batches([orders, orders.filter("o_orderkey % 3 = 0").select("o_custkey", "o_orderkey")])


def match_sql(left="left_columns", right="right_columns"):
    key = "regexp_replace(lower(name), '[^a-z0-9]', '', 'g')"
    return f"""WITH ml AS (SELECT dataset, {key} AS key, arg_max(name, ordinal) AS left_name, arg_max(type, ordinal) AS lt FROM {left} GROUP BY ALL),
mr AS (SELECT dataset, {key} AS key, name AS right_name, type AS rt FROM {right}),
m AS (SELECT *, dataset IN (SELECT dataset FROM {left}) AS hl, dataset IN (SELECT dataset FROM {right}) AS hr
  FROM ml FULL JOIN mr USING (dataset, key)),
matched AS (SELECT dataset, coalesce(right_name, left_name) AS name,
  CASE WHEN left_name IS NOT NULL THEN {CAST_SQL.format('lt')} ELSE lower(rt) END AS data_type,
  coalesce(lt, 'UNKNOWN') AS left_type,
  CASE WHEN left_name IS NOT NULL THEN left_name WHEN NOT hl THEN right_name ELSE 'MISSING_IN_LEFT_' || right_name END AS left_name,
  CASE WHEN NOT hr THEN 'target_missing' WHEN NOT hl THEN 'default_type' WHEN left_name IS NOT NULL AND right_name IS NOT NULL THEN 'matched'
    WHEN left_name IS NOT NULL THEN 'left_only' ELSE 'right_only' END AS status FROM m)"""


@query("fuzzy_schema_join", oracle(COLUMNS, match_sql() + " SELECT * FROM matched"))
def fuzzy_schema_join(spark, sf):
    return schema.match_columns(*pair(spark, sf))


@query("map_logical_type", oracle(["left_columns"], f"""
SELECT dataset, name, type, {CAST_SQL.format('type')} AS warehouse_type FROM left_columns"""))
def map_logical_type(spark, sf):
    rows = frame(spark, sf, "left_columns")
    return rows.select("dataset", "name", "type", cast_type(F.col("type")).alias("warehouse_type"))


MODELS = """models AS (SELECT 'ds_' || s_suppkey AS dataset_id, 'ds_' || s_suppkey AS table_name, 'stg_' || s_suppkey || '.sql' AS model,
  CASE WHEN s_suppkey % 4 = 0 THEN 'True' ELSE NULL END AS chk FROM supplier),
todo AS (SELECT * FROM models WHERE chk IS NULL),
wl AS (SELECT model AS dataset, ordinal, name, type FROM todo JOIN left_columns ON dataset_id = dataset),
wr AS (SELECT model AS dataset, ordinal, name, type FROM todo JOIN right_columns ON table_name = dataset)"""


def _model_control(spark, sf):
    key = F.col("s_suppkey").cast("string")
    return frame(spark, sf, "supplier").select(
        F.concat(F.lit("ds_"), key).alias("Dataset ID"), F.concat(F.lit("ds_"), key).alias("Name"),
        F.concat(F.lit("stg_"), key, F.lit(".sql")).alias("Model"),
        F.when(F.col("s_suppkey") % 4 == 0, "True").alias("Check"),
    )


@query("stage_models", oracle(COLUMNS, "WITH " + MODELS + ",\n" + match_sql("wl", "wr")[5:] + """
SELECT * EXCLUDE (dataset, a), dataset AS model, a AS alias, CASE WHEN status IN ('matched', 'default_type')
  THEN 'cast("' || name || '" as ' || data_type || ') as ' || a END AS expression
FROM (SELECT *, lower(regexp_replace(replace(name, ' ', '_'), '[^0-9A-Za-z_]', '', 'g')) AS a FROM matched)"""))
def models(spark, sf):
    return stage_models(_model_control(spark, sf), *pair(spark, sf), use_cast=True).columns


@query("stage_models_control", oracle(COLUMNS, "WITH " + MODELS + ",\n" + match_sql("wl", "wr")[5:] + """
SELECT dataset_id AS "Dataset ID", table_name AS "Name", model AS "Model",
  CASE WHEN model IN (SELECT dataset FROM matched WHERE status IN ('matched', 'default_type')) THEN 'True' ELSE chk END AS "Check"
FROM models"""))
def models_control(spark, sf):
    return stage_models(_model_control(spark, sf), *pair(spark, sf)).control


# Logical types of the given tables' columns, for the oracle.
LOGICAL = {"BIGINT": "LONG", "INTEGER": "LONG", "DOUBLE": "DOUBLE", "TIMESTAMP": "DATETIME", "VARCHAR": "STRING"}
GIVEN = {
    "orders": [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "VARCHAR"),
               ("o_totalprice", "DOUBLE"), ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "VARCHAR")],
    "customer": [("c_custkey", "BIGINT"), ("c_name", "VARCHAR"), ("c_nationkey", "INTEGER"), ("c_acctbal", "DOUBLE"),
                 ("c_mktsegment", "VARCHAR")],
    "labels": [("doc_id", "BIGINT"), ("quality", "INTEGER"), ("toxic", "INTEGER")],
}


@query("scan_table_columns", "\nUNION ALL ".join(
    f"""SELECT '{t}' AS dataset, (SELECT count(*) FROM {t}) AS rows, {i} AS ordinal, '{c}' AS name,
  '{LOGICAL[k]}' AS type, (SELECT count({c}) FROM {t}) AS "values\""""
    for t, columns in GIVEN.items() for i, (c, k) in enumerate(columns, 1)))
def scan_table_columns(spark, sf):
    parts = [schema.profiled_columns(frame(spark, sf, t), t) for t in GIVEN]
    return reduce(lambda a, b: a.unionByName(b), parts)


assert set(GIVEN) <= set(TABLES)

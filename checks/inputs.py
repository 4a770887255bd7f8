"""Inputs of the registered queries.

Every input is SQL over the given tables, written once and run unchanged by Spark and by the
oracle, so both sides start from the same rows at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

_TEXT = "CAST({} AS STRING)"


def _s(expression: str) -> str:
    return _TEXT.format(expression)


_COLUMN_NAME = f"""CASE p_partkey % 4
    WHEN 0 THEN p_name || ' ' || {_s('p_partkey')}
    WHEN 1 THEN upper(p_name) || '_' || {_s('p_partkey')}
    WHEN 2 THEN p_name || ' #' || {_s('p_partkey')}
    ELSE '(' || p_name || ')-' || {_s('p_partkey')} END"""

# name -> (inputs it reads, SQL)
INPUTS: dict[str, tuple[list[str], str]] = {
    "right_orders": (["orders"], """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 29 = 0 THEN o_totalprice * CAST(1.05 AS DOUBLE)
       WHEN o_orderkey % 17 = 0 THEN o_totalprice + 5
       WHEN o_orderkey % 13 = 0 THEN o_totalprice + CAST(0.005 AS DOUBLE)
       ELSE o_totalprice END AS o_totalprice,
  o_orderdate,
  CASE WHEN o_orderkey % 23 = 0 THEN lower(o_orderpriority) ELSE o_orderpriority END AS o_orderpriority
FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 101 = 0"""),
    "right_lineitem": (["lineitem"], """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_partkey % 31 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE l_partkey % 89 <> 0"""),
    "hot_left": (["lineitem"], """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey, l_returnflag, l_quantity, l_shipdate
FROM lineitem"""),
    "hot_right": (["lineitem"], """
SELECT CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_orderkey END AS l_orderkey, l_returnflag,
  CASE WHEN l_partkey % 31 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_shipdate
FROM lineitem WHERE l_partkey % 89 <> 0"""),
    "left_customer": (["customer"], """
SELECT CASE WHEN c_custkey % 211 = 0 THEN NULL ELSE c_custkey END AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer"""),
    "right_customer": (["customer"], """
SELECT CASE WHEN c_custkey % 211 = 0 THEN NULL ELSE c_custkey END AS c_custkey, c_name, c_nationkey,
  CASE WHEN c_custkey % 37 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer WHERE c_custkey % 53 <> 0"""),
    "text_key_orders": (["orders"], f"""
SELECT {_s('o_orderkey')} AS o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 5 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderkey % 97 <> 0"""),
    "messy_names": (["part"], f"""
SELECT p_partkey, p_size AS dataset, CASE p_partkey % 9
    WHEN 0 THEN p_name || ' #'
    WHEN 1 THEN '(' || p_name || ')'
    WHEN 2 THEN 'No. ' || p_name
    WHEN 3 THEN p_name || '-A/B'
    WHEN 4 THEN p_name || ' & Co.'
    WHEN 5 THEN '  ' || p_name || ' ?'
    WHEN 6 THEN upper(p_name) || ' $ total'
    WHEN 7 THEN {_s('p_size')} || ' ' || p_name
    ELSE CASE CAST(floor(p_partkey / 9) AS BIGINT) % 6 WHEN 0 THEN 'order' WHEN 1 THEN 'Date' WHEN 2 THEN 'unknown'
         WHEN 3 THEN '' WHEN 4 THEN '#' ELSE '__ ' END END AS raw_name
FROM part"""),
    "left_columns": (["part"], f"""
SELECT 'ds_' || {_s('p_size')} AS dataset, p_partkey AS ordinal, {_COLUMN_NAME} AS name,
  CASE p_partkey % 6 WHEN 0 THEN 'STRING' WHEN 1 THEN 'LONG' WHEN 2 THEN 'DOUBLE' WHEN 3 THEN 'DATETIME'
       WHEN 4 THEN 'BOOLEAN' ELSE 'TEXT' END AS type
FROM part WHERE p_size <> 50"""),
    "right_columns": (["part"], f"""
SELECT 'ds_' || {_s('p_size')} AS dataset, p_partkey AS ordinal,
  CASE WHEN p_partkey % 3 = 0 THEN upper(replace({_COLUMN_NAME}, ' ', '_')) ELSE {_COLUMN_NAME} END AS name,
  CASE WHEN p_partkey % 7 = 0 THEN 'BINARY'
       ELSE CASE p_partkey % 6 WHEN 0 THEN 'VARCHAR(100)' WHEN 1 THEN 'BIGINT' WHEN 2 THEN 'Float'
            WHEN 3 THEN 'TIMESTAMP_NTZ' WHEN 4 THEN 'BOOLEAN' ELSE 'VARCHAR' END END AS type
FROM part WHERE p_partkey % 11 <> 0 AND p_size <> 49
UNION ALL
SELECT 'ds_' || {_s('p_size')}, p_partkey + 1000000000, 'extra ' || {_s('p_partkey')}, 'VARCHAR'
FROM part WHERE p_partkey % 13 = 0 AND p_size <> 49"""),
    "dirty_text": (["orders"], f"""
SELECT o_orderkey,
  CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' ELSE {_s('CAST(o_totalprice AS DECIMAL(18,2))')} END AS mostly_number,
  CASE WHEN o_orderkey % 3 = 0 THEN 'n/a' ELSE {_s('o_custkey')} END AS some_price,
  CASE WHEN o_orderkey % 10 = 0 THEN 'junk' ELSE substr({_s('o_orderdate')}, 1, 10) END AS iso_date,
  CASE WHEN o_orderkey % 2 = 0 THEN 'Yes' ELSE 'no' END AS yes_no,
  CASE WHEN o_orderkey % 5 = 0 THEN '   ' WHEN o_orderkey % 11 = 0 THEN '' ELSE o_orderpriority END AS padded,
  CASE o_orderkey % 4
    WHEN 0 THEN {_s('1 + o_orderkey % 9')} || '.942683660313343e+' || {_s('CAST(floor(o_orderkey / 4) AS BIGINT) % 18')}
    WHEN 1 THEN 'nan' WHEN 2 THEN NULL ELSE 'plain' END AS scientific
FROM orders"""),
    "sparse_rows": (["orders"], """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey END AS a,
  CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 2 = 0 THEN NULL ELSE o_orderstatus END AS b
FROM orders"""),
    "control": (["customer"], f"""
SELECT c_custkey AS row_id,
  CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '  '
       ELSE 'ds-' || {_s('CAST(floor(c_custkey / 3) AS BIGINT)')} END AS dataset_id,
  CASE c_custkey % 5 WHEN 0 THEN c_name || '.SQL' WHEN 1 THEN 'unknown'
       WHEN 2 THEN '2 Sales-Data.v' || {_s('c_custkey')} WHEN 3 THEN c_name || ' (x)' ELSE '' END AS model_name,
  CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Pending' WHEN 2 THEN 'Migrated' WHEN 3 THEN 'Not migrated'
       WHEN 4 THEN 'Testing now' ELSE 'Failed' END AS status,
  CASE c_custkey % 4 WHEN 0 THEN 'id, date,, ' WHEN 1 THEN 'id' WHEN 2 THEN NULL ELSE ' , ' END AS key_columns,
  CASE c_custkey % 4 WHEN 0 THEN '100' WHEN 1 THEN ' 250 ' WHEN 2 THEN 'many' ELSE NULL END AS sample_size,
  CASE c_custkey % 5 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'enabled' WHEN 2 THEN 'no' WHEN 3 THEN NULL ELSE '1' END AS transform,
  CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN ' old note ' ELSE NULL END AS notes,
  CASE c_custkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'true' WHEN 2 THEN NULL ELSE 'False' END AS check_text,
  CASE c_custkey % 5 WHEN 0 THEN 'yes' WHEN 1 THEN 'Y' WHEN 2 THEN '0' WHEN 3 THEN NULL ELSE 'TRUE' END AS required
FROM customer"""),
    "excluded": (["customer"], f"""
SELECT CASE WHEN c_custkey % 8 = 0 THEN '   ' ELSE '  ds-' || {_s('c_custkey')} || ' ' END AS dataset_id
FROM customer WHERE c_custkey % 4 = 0"""),
    "existing": (["customer"], f"""
SELECT 'ds-' || {_s('c_custkey')} AS dataset_id FROM customer WHERE c_custkey % 7 = 0"""),
    "ids": (["customer"], f"""
SELECT c_custkey AS ordinal, 'ds-' || {_s('c_custkey')} AS dataset_id FROM customer"""),
    "results": (["customer"], f"""
SELECT c_custkey AS ordinal, 'ds-' || {_s('c_custkey')} AS dataset_id,
  CASE WHEN c_custkey % 11 = 3 THEN 'failed' WHEN c_custkey % 11 = 5 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN c_custkey % 11 IN (3, 5) THEN 'Dataset ds-' || {_s('c_custkey')} || ': broken' ELSE NULL END AS error
FROM customer"""),
    "ragged": (["part"], """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ',' || p_brand
  WHEN 2 THEN p_name || ',' || p_brand || ',' || p_type ELSE p_name || ',' || p_brand || ',' || p_type || ',more' END AS line
FROM part"""),
    "flows": (["nation", "customer", "orders"], f"""
SELECT 'FN' || {_s('n_nationkey')} AS flow_id,
  'R' || {_s('n_regionkey')} || ',' || chr(10) || 'R' || {_s('n_regionkey')} AS source_ids,
  'N' || {_s('n_nationkey')} AS output_ids FROM nation
UNION ALL
SELECT 'FC' || {_s('c_custkey')}, 'N' || {_s('c_nationkey')} || ', ,',
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'C' || {_s('c_custkey')} END FROM customer
UNION ALL
SELECT 'FO' || {_s('o_orderkey')}, 'C' || {_s('o_custkey')} || chr(10) || 'C' || {_s('o_custkey')},
  'O' || {_s('o_orderkey')} || 'b,' || chr(10) || 'O' || {_s('o_orderkey')} || ', ' FROM orders"""),
    "edges": (["region", "nation", "customer", "orders"], f"""
SELECT 'R' || {_s('r_regionkey')} AS output_id, 'R' || {_s('(r_regionkey + 1) % 3')} AS source_id
FROM region WHERE r_regionkey < 3
UNION ALL SELECT 'N' || {_s('n_nationkey')}, 'R' || {_s('n_regionkey')} FROM nation
UNION ALL SELECT 'C' || {_s('c_custkey')}, 'N' || {_s('c_nationkey')} FROM customer
UNION ALL SELECT 'O' || {_s('o_orderkey')}, 'C' || {_s('o_custkey')} FROM orders"""),
    "chains": (["orders"], f"""
SELECT 'o' || {_s('o_orderkey')} AS output_id,
  'o' || {_s('CASE WHEN o_orderkey % 256 = 255 THEN o_orderkey - 2 ELSE o_orderkey + 1 END')} AS source_id FROM orders"""),
    "steps": (["conversations"], """
SELECT conv_id AS dataflow_id, turn AS position,
  CASE WHEN turn % 5 = 4 THEN 'Mystery' WHEN role = 'system' THEN 'SelectValues' WHEN role = 'user' THEN 'Filter'
       ELSE 'MergeJoin' END AS action_type,
  CAST(CASE WHEN turn % 3 = 2 THEN 0 ELSE length(text) END AS BIGINT) AS sql_chars,
  CAST(2 * length(text) AS BIGINT) AS fallback_chars
FROM conversations"""),
}


def view_all(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    for name in names:
        frame(spark, sf_dir, name).createOrReplaceTempView(name)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived input as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    needs, sql = INPUTS[name]
    view_all(spark, sf_dir, needs)
    return spark.sql(sql)


def oracle(names: list[str], body: str, recursive: bool = False) -> str:
    """Oracle SQL: the inputs as CTEs in front of ``body``; ``body`` may go on with more CTEs."""
    ctes = [f"{n} AS ({INPUTS[n][1]})" for n in names]
    body = body.strip()
    if body.upper().startswith("WITH "):
        ctes.append(body[5:])
        return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(ctes)
    return (("WITH " + ",\n".join(ctes) + "\n") if ctes else "") + body

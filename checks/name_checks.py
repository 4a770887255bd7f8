"""Name rules over a catalog of messy names."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import frame, oracle
from checks.registry import query
from ferrytally.functions import names
from ferrytally.functions.names import RESERVED_WORDS
from ferrytally.operators.schema import unique_in_header, unique_names
from ferrytally.plans.stage_models import source_manifest, stage_select

TRANSFORM = """upper(trim(regexp_replace(translate(replace(replace(regexp_replace(lower(raw_name), '\\bno\\.\\s*', 'number_', 'g'),
  '#', 'number'), '&', 'and'), '() -/.?', '_______'), '_+', '_', 'g'), '_'))"""
SQUEEZED = "trim(regexp_replace(lower(regexp_replace(replace(raw_name, '#', 'number'), '[^a-zA-Z0-9_]', '_', 'g')), '_+', '_', 'g'), '_')"
WAREHOUSE = f"upper(CASE WHEN {SQUEEZED} = '' THEN 'unnamed_column' ELSE {SQUEEZED} END)"


def _rule(key, rule, sql):
    @query(key, oracle(["messy_names"], f"SELECT p_partkey, raw_name, {sql} AS name FROM messy_names"))
    def run(spark, sf):
        return frame(spark, sf, "messy_names").select("p_partkey", "raw_name", rule(F.col("raw_name")).alias("name"))

    return run


_rule("name_transform", names.transform_name, TRANSFORM)
_rule("name_match_key", names.match_key, "regexp_replace(lower(raw_name), '[^a-z0-9]', '', 'g')")
_rule("name_stage_alias", names.stage_alias,
      "lower(regexp_replace(replace(raw_name, ' ', '_'), '[^0-9A-Za-z_]', '', 'g'))")
_rule("name_source_ident", names.source_identifier,
      "upper(replace(regexp_replace(raw_name, '[^0-9a-zA-Z_ ]', '', 'g'), ' ', '_'))")
_IDENT = "trim(regexp_replace(regexp_replace(upper(raw_name), '[^A-Z0-9_]', '_', 'g'), '_+', '_', 'g'), '_')"
_rule("name_identifier", names.identifier,
      f"substr(CASE WHEN {_IDENT} = '' THEN 'UNNAMED' ELSE {_IDENT} END, 1, 255)")


def _suffixed(name):
    return f"""WITH named AS (SELECT *, {name} AS n FROM messy_names),
k AS (SELECT *, row_number() OVER (PARTITION BY dataset, n ORDER BY p_partkey) - 1 AS k FROM named)
SELECT p_partkey, dataset, raw_name, CASE WHEN k = 0 THEN n ELSE n || '_' || k END AS final_name FROM k"""


@query("rename_transformed", oracle(["messy_names"], _suffixed(TRANSFORM)))
def rename_transformed(spark, sf):
    rows = frame(spark, sf, "messy_names")
    return unique_names(rows, names.transform_name(F.col("raw_name")), ["dataset"], "p_partkey")


def _chained(scope):
    """Names with suffixed ones among them: the numbers that make no name of the scope, counted off."""
    return f"""WITH named AS (
  SELECT dataset, p_partkey, raw_name, {TRANSFORM} AS n FROM messy_names
  UNION ALL SELECT dataset, p_partkey + 1000000000, raw_name, {TRANSFORM} || '_' || (1 + p_partkey % 7) FROM messy_names WHERE p_partkey % 3 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY {scope} n ORDER BY p_partkey) - 1 AS k FROM named),
free AS (SELECT {scope} n, s, row_number() OVER (PARTITION BY {scope} n ORDER BY s) AS k FROM (
  SELECT {scope} n, unnest(range(1, max(k) + 10)) AS s FROM k GROUP BY {scope} n HAVING max(k) > 0) AS tries
  WHERE NOT EXISTS (SELECT 1 FROM named AS o WHERE {"o.dataset = tries.dataset AND " if scope else ""}o.n = tries.n || '_' || tries.s))
SELECT k.dataset, k.p_partkey, k.raw_name, CASE WHEN k.k = 0 THEN k.n ELSE k.n || '_' || free.s END AS final_name
FROM k LEFT JOIN free USING ({scope} n, k)"""


def _with_chains(spark, sf):
    rows = frame(spark, sf, "messy_names").select("dataset", "p_partkey", "raw_name")
    named = rows.withColumn("n", names.transform_name(F.col("raw_name")))
    more = named.filter("p_partkey % 3 = 0").withColumn("n", F.concat("n", F.lit("_"), (1 + F.col("p_partkey") % 7).cast("string")))
    return named.unionByName(more.withColumn("p_partkey", F.col("p_partkey") + 1000000000))


@query("rename_chained", oracle(["messy_names"], _chained("dataset, ")))
def rename_chained(spark, sf):
    """Headers in which a name may equal another one's suffixed repeat."""
    return unique_names(_with_chains(spark, sf), F.col("n"), ["dataset"], "p_partkey").drop("n")


@query("name_suffix_chained", oracle(["messy_names"], _chained("")))
def name_suffix_chained(spark, sf):
    """The same in one flat list, numbered as hot keys."""
    return unique_names(_with_chains(spark, sf), F.col("n"), [], "p_partkey", hot_rows=20).drop("n")


_FREE = """CASE WHEN NOT list_contains(used, own[1]) THEN own[1] ELSE list_filter(
    list_transform(range(1, len(used) + 2), k -> own[1] || '_' || k), c -> NOT list_contains(used, c))[1] END"""


@query("name_warehouse", oracle(["messy_names"], f"""WITH named AS (
  SELECT dataset, p_partkey, raw_name, {WAREHOUSE} AS n FROM messy_names
  UNION ALL SELECT dataset, p_partkey + 1000000000, raw_name, {WAREHOUSE} || '_1' FROM messy_names WHERE p_partkey % 3 = 0),
h AS (SELECT dataset, list(p_partkey ORDER BY p_partkey) AS ids, list(raw_name ORDER BY p_partkey) AS raws,
  list_reduce(list([n] ORDER BY p_partkey), lambda used, own: list_append(used, {_FREE})) AS finals FROM named GROUP BY dataset)
SELECT dataset, unnest(ids) AS p_partkey, unnest(raws) AS raw_name, unnest(finals) AS final_name FROM h""".replace("k -> ", "lambda k: ").replace("c -> ", "lambda c: ")))
def name_warehouse(spark, sf):
    """Headers in which a name may equal another one's suffixed repeat."""
    rows = frame(spark, sf, "messy_names")
    named = rows.withColumn("n", names.warehouse_name(F.col("raw_name")))
    more = named.filter("p_partkey % 3 = 0").withColumns({
        "p_partkey": F.col("p_partkey") + 1000000000, "n": F.concat("n", F.lit("_1"))
    })
    both = named.unionByName(more)
    return unique_in_header(both, F.col("n"), ["dataset"], "p_partkey").select("dataset", "p_partkey", "raw_name", "final_name")


@query("name_suffix_number", oracle(["messy_names"], f"""WITH named AS (SELECT p_partkey, raw_name, {TRANSFORM} AS n FROM messy_names)
SELECT p_partkey, raw_name, CASE WHEN k = 0 THEN n ELSE n || '_' || k END AS final_name FROM (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY p_partkey) - 1 AS k FROM named)"""))
def name_suffix_number(spark, sf):
    """One flat list of names, in which a few names hold most rows: numbered as hot keys."""
    rows = frame(spark, sf, "messy_names").select("p_partkey", "raw_name")
    return unique_names(rows, names.transform_name(F.col("raw_name")), [], "p_partkey", hot_rows=20)


@query("reserved_word_flag", oracle(["messy_names"], f"""
SELECT p_partkey, raw_name, lower(raw_name) IN ({', '.join(f"'{w}'" for w in RESERVED_WORDS)}) AS reserved FROM messy_names"""))
def reserved_word_flag(spark, sf):
    rows = frame(spark, sf, "messy_names")
    return rows.select("p_partkey", "raw_name", names.is_reserved(F.col("raw_name")).alias("reserved"))


_FROM_NAME = "regexp_replace(translate(trim(lower(raw_name)), ' -.', '___'), '[^a-z0-9_]', '', 'g')"
_FROM_ID = "regexp_replace(translate(id, '-.', '__'), '[^a-zA-Z0-9_]', '', 'g')"


@query("name_table", oracle(["messy_names"], f"""WITH n AS (SELECT *, CASE p_partkey % 2 WHEN 0 THEN 'a-b.' || p_partkey || '_' ELSE p_partkey || '-x' END AS id FROM messy_names),
t AS (SELECT p_partkey, raw_name, id, CASE WHEN trim(raw_name) <> '' AND lower(raw_name) <> 'unknown'
  THEN CASE WHEN regexp_matches({_FROM_NAME}, '^[0-9]') THEN 'tbl_' || {_FROM_NAME} ELSE {_FROM_NAME} END
  ELSE CASE WHEN regexp_matches({_FROM_ID}, '^[0-9]') THEN 'id_' || {_FROM_ID} ELSE {_FROM_ID} END END AS t FROM n)
SELECT p_partkey, raw_name, id, rtrim(substr(t, 1, 240), '_') AS table_name FROM t"""))
def name_table(spark, sf):
    key = F.col("p_partkey").cast("string")
    ids = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("a-b."), key, F.lit("_"))).otherwise(
        F.concat(key, F.lit("-x"))
    )
    rows = frame(spark, sf, "messy_names").withColumn("id", ids)
    return rows.select("p_partkey", "raw_name", "id", names.table_name(F.col("id"), F.col("raw_name")).alias("table_name"))


@query("stage_projection", """
SELECT o_orderkey AS order_key, CAST(o_totalprice AS VARCHAR) AS total_price, TRY_CAST(o_orderpriority AS BIGINT) AS priority_no
FROM orders""".replace("CAST(o_totalprice AS VARCHAR)", "o_totalprice"))
def stage_projection(spark, sf):
    rows = frame(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Order Key"), F.col("o_totalprice").alias("Total Price"),
        F.col("o_orderpriority").alias("Priority (No)"), F.col("o_orderstatus").alias("Unmatched"),
    )
    columns = [("Order Key", "number"), ("Total Price", "float"), ("Priority (No)", "number"), ("Absent", "text")]
    return stage_select(rows, columns, use_cast=True)


@query("source_manifest", oracle(["control"], """
SELECT 'DW' AS database, 'SRC' AS schema, upper(model_name) AS name,
  upper(replace(regexp_replace(model_name, '[^0-9a-zA-Z_ ]', '', 'g'), ' ', '_')) AS identifier
FROM control WHERE lower(coalesce(check_text, '')) <> 'true' AND model_name IS NOT NULL"""))
def manifest(spark, sf):
    control = frame(spark, sf, "control").select(F.col("check_text").alias("Check"), F.col("model_name").alias("Name"))
    return source_manifest(control, "DW", "SRC")

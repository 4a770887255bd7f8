"""Scans and sinks, checked by reading back what was written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.inputs import frame, oracle
from checks.registry import query
from ferrytally.plans import report
from ferrytally.session import scratch_path
from ferrytally.sources import readers, sinks
from ferrytally.streaming.stage_ingest import ingest_stage

ORDERS_TEXT = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, o_orderpriority FROM orders"""


def _priced(spark, sf):
    orders = frame(spark, sf, "orders").drop("o_orderdate")
    return orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


@query("scan_csv", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate FROM orders")
def scan_csv(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.save_csv(frame(spark, sf, "orders"), path)
    scanned = readers.read_csv(spark, path)
    return scanned.withColumns({
        "o_orderkey": F.col("o_orderkey").cast("bigint"), "o_custkey": F.col("o_custkey").cast("bigint"),
        "o_orderdate": F.col("o_orderdate").cast("timestamp_ntz"),
    })


@query("scan_csv_as_strings", ORDERS_TEXT)
def scan_csv_as_strings(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.save_csv(_priced(spark, sf), path)
    return readers.read_csv(spark, path, infer=False)


@query("save_csv", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def save_csv(spark, sf):
    """Whole texts with quotes and line breaks survive the round trip."""
    path = scratch_path(spark, "csv")
    sinks.save_csv(frame(spark, sf, "documents"), path)
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return readers.read_csv(spark, path, schema=columns, multi_line=True)


@query("scan_csv_quoted_breaks", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_quoted_breaks(spark, sf):
    """The texts in plain files, each read by many tasks."""
    path = scratch_path(spark, "csv")
    sinks.save_csv(frame(spark, sf, "documents"), path)
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return readers.read_csv(spark, path, schema=columns, multi_line=True, split_bytes=0)


@query("scan_dataset", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority")
def scan_dataset(spark, sf):
    sql = "SELECT o_orderpriority, count(*) AS n FROM {table} WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"
    return readers.read_dataset(frame(spark, sf, "orders"), sql)


@query("scan_limited", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 1000")
def scan_limited(spark, sf):
    return readers.read_dataset(frame(spark, sf, "orders"), limit=1000, order=["o_orderkey"])


CATALOG = ["nation", "customer", "part", "orders", "lineitem", "documents"]


@query("scan_catalog", "\nUNION ALL ".join(
    f"""SELECT '{t}' AS id, '{t}' AS name, '' AS description, '' AS created,
  {"coalesce(strftime((SELECT max(o_orderdate) FROM orders), '%Y-%m-%d %H:%M:%S'), '')" if t == 'orders' else "''"} AS last_updated,
  (SELECT count(*) FROM {t}) AS row_count, (SELECT count(*) FROM (DESCRIBE {t})) AS column_count,
  {"'sales'" if t == 'orders' else "''"} AS owner""" for t in CATALOG))
def scan_catalog(spark, sf):
    orders = frame(spark, sf, "orders")
    metadata = orders.agg(F.max("o_orderdate").alias("last_updated")).select(
        F.lit("orders").alias("id"), "last_updated", F.lit("sales").alias("owner")
    )
    return readers.dataset_catalog({t: frame(spark, sf, t) for t in CATALOG}, metadata)


@query("scan_dataflow_inventory", """
SELECT CAST(s_suppkey AS VARCHAR) AS "Dataflow ID", s_name AS "Name", CASE WHEN s_suppkey % 2 = 0 THEN 'true' ELSE '' END AS "Enabled",
  '' AS "Draft", CAST(s_nationkey AS VARCHAR) AS "NumOutputs" FROM supplier""")
def scan_dataflow_inventory(spark, sf):
    flows = frame(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.when(F.col("s_suppkey") % 2 == 0, True).alias("enabled"), F.col("s_nationkey").alias("num_outputs"),
    )
    return readers.dataflow_inventory(flows)


@query("scan_control_table", oracle(["control"], """
SELECT CAST(row_id AS VARCHAR) AS row_id, nullif(model_name, '') AS model_name, status, key_columns FROM control"""))
def scan_control_table(spark, sf):
    path = scratch_path(spark, "control")
    sinks.save_csv(
        frame(spark, sf, "control").select("row_id", F.nullif("model_name", F.lit("")).alias("model_name"), "status", "key_columns"),
        path,
    )
    return readers.read_control(spark, path)


@query("scan_stage_files", """SELECT ceil(count(*) / 500.0) <= 1 OR count(*) > 500 AS several, true AS named, true AS sized, true AS dated,
  count(*) AS rows FROM orders""")
def scan_stage_files(spark, sf):
    """Whether every listed file has a name, a size and a time, and the rows of the listed files."""
    stage = scratch_path(spark, "stage")
    folder = sinks.write_stage(frame(spark, sf, "orders"), stage, "orders", file_rows=500)
    rows = readers.read_csv(spark, folder, infer=False).groupBy(F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("file")).agg(
        F.count(F.lit(1)).alias("n")
    )
    listed = readers.list_stage(spark, stage).join(rows, F.col("name") == F.col("file"), "full")
    return listed.agg(
        (F.count("name") > 1).alias("several"), F.bool_and(F.col("name").endswith(".csv.gz")).alias("named"),
        F.bool_and(F.col("size") > 0).alias("sized"), F.bool_and(F.col("last_modified").isNotNull()).alias("dated"),
        F.sum("n").alias("rows"),
    )


@query("sink_table_append_types", """SELECT o_orderkey::VARCHAR AS k, o_custkey AS v FROM orders
UNION ALL SELECT 'x' || o_orderkey, o_custkey FROM orders""")
def sink_table_append_types(spark, sf):
    """Text appended to numbers, and whole doubles to integers: the table stays readable and keeps every value."""
    orders, path = frame(spark, sf, "orders"), scratch_path(spark, "table")
    sinks.write_table(orders.select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("v")), path)
    more = orders.select(F.concat(F.lit("x"), "o_orderkey").alias("k"), F.col("o_custkey").cast("double").alias("v"))
    sinks.write_table(more, path, "append")
    return spark.read.parquet(path)


@query("sink_table", """
SELECT 'replace' AS mode, count(*) AS rows, sum(o_orderkey)::BIGINT AS keys FROM orders
UNION ALL SELECT 'append', 2 * count(*), 2 * sum(o_orderkey)::BIGINT FROM orders
UNION ALL SELECT 'fail', 2 * count(*), 2 * sum(o_orderkey)::BIGINT FROM orders""")
def sink_table(spark, sf):
    """The target after a replace, an append, and a refused write."""
    orders, path = frame(spark, sf, "orders"), scratch_path(spark, "table")
    states = []
    for mode in ("replace", "append", "fail"):
        try:
            sinks.write_table(orders, path, mode, file_rows=100_000)
        except Exception:
            if mode != "fail":
                raise
        totals = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))
        states.append(totals.select(F.lit(mode).alias("mode"), "rows", "keys").collect()[0])
    return spark.createDataFrame(states, "mode string, rows bigint, keys bigint")


STAGED = T.StructType([
    T.StructField("ORDER_KEY", T.LongType()), T.StructField("PADDED", T.StringType()), T.StructField("PRICE_NUMBER", T.DoubleType()),
])
STAGED_SQL = """SELECT o_orderkey AS "ORDER_KEY", CASE WHEN trim(padded) <> '' THEN padded END AS "PADDED",
  CAST(mostly_number AS DOUBLE) AS "PRICE_NUMBER" FROM dirty_text WHERE mostly_number <> 'n/a'"""


def _staged(spark, sf):
    rows = frame(spark, sf, "dirty_text").select(
        F.col("o_orderkey").alias("order key"), "padded", F.col("mostly_number").alias("price #")
    )
    stage = scratch_path(spark, "stage")
    sinks.write_stage(rows, stage, "orders")
    return stage


@query("sink_stage_csv", oracle(["dirty_text"], """
SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER_KEY", CASE WHEN trim(padded) <> '' THEN padded END AS "PADDED", mostly_number AS "PRICE_NUMBER" FROM dirty_text"""))
def sink_stage_csv(spark, sf):
    return readers.read_csv(spark, _staged(spark, sf) + "/orders", infer=False)


@query("load_from_stage", oracle(["dirty_text"], STAGED_SQL))
def load_from_stage(spark, sf):
    """Rows whose price is no number do not fit the schema and are skipped."""
    target = scratch_path(spark, "loaded")
    sinks.load_stage(spark, _staged(spark, sf), target, STAGED)
    return spark.read.parquet(target)


@query("load_from_stage_incremental", oracle(["dirty_text"], STAGED_SQL + " UNION ALL " + STAGED_SQL))
def load_from_stage_incremental(spark, sf):
    """Two arrivals of files, three runs: every file is loaded once."""
    stage, target, state = (scratch_path(spark, n) for n in ("stage", "loaded", "state"))
    rows = frame(spark, sf, "dirty_text").select(
        F.col("o_orderkey").alias("order key"), "padded", F.col("mostly_number").alias("price #")
    )
    sinks.write_stage(rows, stage, "first")
    ingest_stage(spark, stage, target, STAGED, state)
    ingest_stage(spark, stage, target, STAGED, state)
    sinks.write_stage(rows, stage, "second")
    ingest_stage(spark, stage, target, STAGED, state)
    return spark.read.parquet(target)


@query("rejected_rows", oracle(["dirty_text"], """
SELECT o_orderkey || ',' || coalesce(CASE WHEN trim(padded) <> '' THEN padded END, '') || ',n/a' AS record FROM dirty_text WHERE mostly_number = 'n/a'"""))
def rejected_rows(spark, sf):
    rejects = sinks.load_rejects(spark, _staged(spark, sf), STAGED)
    return rejects.select(F.regexp_replace("record", "[\\r\\n]+$", "").alias("record"))


@query("verify_load", "SELECT count(*) AS expected, count(*) AS actual, true AS ok FROM lineitem")
def verify_load(spark, sf):
    lines, path = frame(spark, sf, "lineitem"), scratch_path(spark, "table")
    sinks.write_table(lines, path)
    return sinks.verify_count(spark, path, lines.count())


@query("verify_load_content", """SELECT 'copied' AS "case", count(*) AS expected, count(*) AS actual, true AS ok FROM lineitem
UNION ALL SELECT 'changed', count(*), count(*), false FROM lineitem UNION ALL SELECT 'swapped', count(*), count(*), false FROM lineitem
UNION ALL SELECT 'nulled', count(*), count(*), false FROM lineitem UNION ALL SELECT 'replaced', count(*), count(*), false FROM lineitem""")
def verify_load_content(spark, sf):
    """A load is right if it holds the very rows: one changed value, two columns swapped, a null, or a row in place of another are found."""
    lines, checks = frame(spark, sf, "lineitem"), []
    least = lines.agg(F.min(F.struct("l_orderkey", "l_linenumber"))).first()[0]
    one = (F.col("l_orderkey") == least[0]) & (F.col("l_linenumber") == least[1])
    cases = {
        "copied": lines.repartition(5),
        "changed": lines.withColumn("l_tax", F.when(one, F.col("l_tax") + 1).otherwise(F.col("l_tax"))),
        "swapped": lines.withColumns({"l_partkey": F.col("l_suppkey"), "l_suppkey": F.col("l_partkey")}),
        "nulled": lines.withColumn("l_shipdate", F.when(~one, F.col("l_shipdate"))),
        "replaced": lines.filter(~one).unionByName(lines.filter(one).withColumn("l_orderkey", F.col("l_orderkey") + 1000000000)),
    }
    for case, loaded in cases.items():
        path = scratch_path(spark, "table")
        expected = sinks.write_table(lines, path, checked=True)
        sinks.write_table(loaded, path)
        checks.append(sinks.verify_content(spark, path, expected).select(F.lit(case).alias("case"), "*"))
    return reduce(DataFrame.unionByName, checks)


@query("sink_table_failed_replace", "SELECT count(*) AS rows, sum(o_orderkey)::BIGINT AS keys, true AS failed FROM orders")
def sink_table_failed_replace(spark, sf):
    """A replacement that fails half-way: the old rows are still there."""
    orders, path = frame(spark, sf, "orders"), scratch_path(spark, "table")
    sinks.write_table(orders, path)
    last = orders.agg(F.max("o_orderkey")).first()[0]
    broken = F.when(F.col("o_orderkey") == last, F.raise_error(F.lit("broken"))).otherwise(F.col("o_orderkey"))
    failed = False
    try:
        sinks.write_table(orders.repartition(8, "o_orderkey").withColumn("o_orderkey", broken.cast("bigint")), path)
    except Exception:
        failed = True
    return readers.read_ref(spark, path).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"), F.lit(failed).alias("failed")
    )


@query("write_report", oracle(["right_orders"], """
SELECT 'left_only' AS part, o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM right_orders)
UNION ALL SELECT 'right_only', o_orderkey FROM right_orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'summary', common FROM (SELECT count(*) AS common FROM orders JOIN right_orders USING (o_orderkey))
UNION ALL SELECT 'column_stats', 5 UNION ALL SELECT 'left_duplicates', 0 UNION ALL SELECT 'right_duplicates', 0"""))
def write_report(spark, sf):
    """A written report read back: its whole lists of rows, and a number of each other table."""
    compared = report.compare_tables(frame(spark, sf, "orders"), frame(spark, sf, "right_orders"), ["o_orderkey"])
    compared = compared.settled()
    path = scratch_path(spark, "report")
    sinks.write_report(compared.frames(), path)
    sinks.write_text(report.executive_summary(compared, "orders"), f"{path}/text")
    parts = [
        spark.read.parquet(f"{path}/{part}").select(F.lit(part).alias("part"), "o_orderkey")
        for part in ("left_only", "right_only")
    ]
    parts.append(spark.read.parquet(f"{path}/summary").select(F.lit("summary"), "common_rows"))
    for part in ("column_stats", "left_duplicates", "right_duplicates"):
        parts.append(spark.read.parquet(f"{path}/{part}").agg(F.lit(part), F.count(F.lit(1))))
    return reduce(lambda a, b: a.union(b), parts)



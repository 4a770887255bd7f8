"""Migrations and batches over datasets cut from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.compare_checks import CUSTOMER, ORDERS, totals_sql
from checks.inputs import frame, oracle
from checks.registry import query
from checks.source_checks import _priced
from ferrytally.plans import batch, migrate, report
from ferrytally.session import scratch_path
from ferrytally.sources import readers, sinks

UPPER = ", ".join(f'{c} AS "{c.upper()}"' for c in
                  ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])


@query("migrate", f"SELECT {UPPER} FROM orders")
def migrate_full(spark, sf):
    target = scratch_path(spark, "target")
    check = migrate.migrate(frame(spark, sf, "orders"), target, limit=None).first()
    if not check["ok"]:
        raise ValueError(f"loaded {check['actual']} of {check['expected']} rows")
    return readers.read_ref(spark, target)


@query("migrate_default", "SELECT count(*) AS expected, count(*) AS actual, true AS ok FROM lineitem")
def migrate_default(spark, sf):
    """Without a limit the whole table is loaded."""
    return migrate.migrate(frame(spark, sf, "lineitem"), scratch_path(spark, "target"))


@query("migrate_limited", f"SELECT {UPPER} FROM orders ORDER BY o_orderkey LIMIT 1000")
def migrate_limited(spark, sf):
    target = scratch_path(spark, "target")
    migrate.migrate(frame(spark, sf, "orders"), target, limit=1000, order=["o_orderkey"])
    return readers.read_ref(spark, target)


def _by_region(spark, sf, table="left_customer"):
    """Resolve ``region_<n>`` to the customers of that region."""
    customers, nations = frame(spark, sf, table), frame(spark, sf, "nation")

    def resolve(dataset_id):
        region = int(dataset_id.rsplit("_", 1)[1])
        wanted = nations.filter(F.col("n_regionkey") == region).select(F.col("n_nationkey").alias("c_nationkey"))
        return customers.join(wanted, "c_nationkey", "left_semi").select(*CUSTOMER)

    return resolve


def _in(folder):
    return lambda name: f"{folder}/{name}"


@query("migrate_batch", """WITH n AS (SELECT n_regionkey AS r, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT ROW_NUMBER() OVER (ORDER BY d) AS ordinal, d AS dataset_id, 't' || r AS target_table,
  CASE WHEN n IS NULL THEN 'error' ELSE 'success' END AS status, CASE WHEN n IS NULL THEN 'no data extracted' END AS error,
  n AS expected, n AS actual, CAST(NULL AS BIGINT) AS row_limit
FROM (SELECT 'region_' || range AS d, range AS r FROM range(6)) LEFT JOIN n USING (r)""")
def migrate_batch(spark, sf):
    """Five regions and one that does not exist: its failure does not stop the others."""
    mapping = {f"region_{i}": f"t{i}" for i in range(6)}
    folder = scratch_path(spark, "batch")
    return migrate.migrate_many(spark, mapping, _by_region(spark, sf, "customer"), _in(folder))


@query("migrate_repeated_target", """WITH n AS (SELECT n_regionkey AS r, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
SELECT r + 1 AS ordinal, CASE WHEN r IN (2, 4) THEN 'error' ELSE 'success' END AS status,
  CASE r WHEN 2 THEN 'Target T0 is that of row 1 already' WHEN 4 THEN 'Target t0 is that of row 1 already' END AS error,
  CASE WHEN r NOT IN (2, 4) THEN n END AS actual FROM n""")
def migrate_repeated_target(spark, sf):
    """Datasets that would overwrite each other: the first is loaded, the others are errors."""
    mapping = {f"region_{i}": {2: "T0", 4: "t0"}.get(i, f"t{i}") for i in range(5)}
    folder = scratch_path(spark, "batch")
    done = migrate.migrate_many(spark, mapping, _by_region(spark, sf, "customer"), _in(folder))
    return done.select("ordinal", "status", "error", "actual")


def _control(spark, sf):
    """One control row per region, with a blank id and finished rows among them."""
    key = F.col("r_regionkey").cast("string")
    rows = frame(spark, sf, "region").select(
        F.col("r_regionkey").alias("row"),
        F.when(F.col("r_regionkey") == 3, " ").otherwise(F.concat(F.lit("region_"), key)).alias("Dataset ID"),
        F.concat(F.col("r_name"), F.lit(" Customers")).alias("Model Name"),
        F.when(F.col("r_regionkey") == 1, "Migrated").when(F.col("r_regionkey") != 2, "Pending").alias("Status"),
    )
    return rows


CONTROL_SQL = """SELECT r_regionkey AS row, CASE WHEN r_regionkey = 3 THEN ' ' ELSE 'region_' || r_regionkey END AS "Dataset ID",
  r_name || ' Customers' AS "Model Name",
  CASE WHEN r_regionkey = 3 THEN 'Pending' ELSE 'Migrated' END AS "Status", CASE WHEN r_regionkey IN (1, 3) THEN 0 ELSE
  (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey) END AS loaded FROM region"""


@query("migrate_from_control", CONTROL_SQL)
def migrate_from_control(spark, sf):
    """The updated control table, with the rows each target holds."""
    folder = scratch_path(spark, "targets")
    run = migrate.migrate_control(_control(spark, sf), _by_region(spark, sf, "customer"), _in(folder), "row")
    loaded = run.outcomes.select(F.col("ordinal").alias("o"), F.col("actual").alias("loaded"))
    joined = run.control.join(loaded, F.col("row") == F.col("o"), "left").drop("o")
    return joined.withColumn("loaded", F.coalesce("loaded", F.lit(0)))


@query("migrate_control_to_stage", """
SELECT replace(upper(r_name), ' ', '_') || '_CUSTOMERS' AS folder, CAST(sum(1) AS BIGINT) AS rows, CAST(sum(1) AS BIGINT) AS expected, CAST(sum(1) AS BIGINT) AS actual FROM region JOIN nation ON n_regionkey = r_regionkey
JOIN customer ON c_nationkey = n_nationkey WHERE r_regionkey NOT IN (1, 3) GROUP BY ALL""")
def migrate_control_to_stage(spark, sf):
    """Rows staged per dataset folder, beside what the outcomes say."""
    stage = scratch_path(spark, "stage")
    run = migrate.control_to_stage(_control(spark, sf), _by_region(spark, sf, "customer"), stage, "row")
    rows = spark.read.option("header", True).option("recursiveFileLookup", True).csv(stage)
    found = rows.groupBy(F.regexp_extract(F.input_file_name(), "([^/]+)/[^/]+$", 1).alias("folder")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    told = run.outcomes.filter("status = 'success'").select(
        F.upper(F.regexp_replace("target_table", "[^A-Za-z0-9]+", "_")).alias("folder"), "expected", "actual"
    )
    return found.join(told, "folder", "left")


@query("migrate_to_stage", """SELECT CAST(o_orderkey AS VARCHAR) AS "O_ORDERKEY", CAST(o_custkey AS VARCHAR) AS "O_CUSTKEY",
  o_orderstatus AS "O_ORDERSTATUS", CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS "O_TOTALPRICE", o_orderpriority AS "O_ORDERPRIORITY" FROM orders""")
def migrate_to_stage(spark, sf):
    stage = scratch_path(spark, "stage")
    migrate.to_stage(_priced(spark, sf), stage, "orders")
    return readers.read_csv(spark, f"{stage}/orders", infer=False)


@query("migrate_via_stage", f"""SELECT {UPPER}, o_orderdate + INTERVAL 123456 MICROSECOND AS "STAMP",
  count(*) OVER () AS expected, count(*) OVER () AS actual, CAST(0 AS BIGINT) AS rejected FROM orders""")
def migrate_via_stage(spark, sf):
    """The loaded rows, with a time in microseconds, beside the verification."""
    stage, target = scratch_path(spark, "stage"), scratch_path(spark, "target")
    orders = frame(spark, sf, "orders").withColumn("stamp", F.expr("cast(o_orderdate + INTERVAL '0.123456' SECOND AS timestamp)"))
    check = migrate.via_stage(orders, stage, "orders", target).first()
    loaded = readers.read_ref(spark, target).withColumn("STAMP", F.col("STAMP").cast("timestamp_ntz"))
    return loaded.withColumns({n: F.lit(check[n]).cast("bigint") for n in ("expected", "actual", "rejected")})


def _saved(spark, sf, name):
    path = scratch_path(spark, "csv")
    sinks.save_csv(frame(spark, sf, name), path)
    return readers.read_csv(spark, path)


@query("compare_with_csv", oracle(["right_orders"], totals_sql(
    "orders", "right_orders", ["o_orderkey"], ORDERS, tol=0.01, simple=True)))
def compare_with_csv(spark, sf):
    """The file's inferred types and the table's are brought to one set of types first."""
    return report.compare_with_csv(frame(spark, sf, "orders"), _saved(spark, sf, "right_orders"), ["o_orderkey"]).summary


@query("compare_with_csv_identical", totals_sql("orders", "orders", ["o_orderkey"], ORDERS, tol=0.01, simple=True))
def compare_with_csv_identical(spark, sf):
    """All columns of a table against its own file: a perfect match."""
    return report.compare_with_csv(frame(spark, sf, "orders"), _saved(spark, sf, "orders"), ["o_orderkey"]).summary


def _csv_verdict(right):
    return f"""SELECT '{right}' AS file, (SELECT count(*) FROM (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, round(o_totalprice) FROM orders EXCEPT
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, round(o_totalprice) FROM {right})) = 0
  AND (SELECT count(*) FROM orders) = (SELECT count(*) FROM {right}) AS overall_match"""


@query("compare_with_csv_quick", oracle(["right_orders"], _csv_verdict("orders") + " UNION ALL " + _csv_verdict("right_orders")))
def compare_with_csv_quick(spark, sf):
    """The quick verdict on an identical and on a changed file."""
    orders = frame(spark, sf, "orders")
    verdicts = [
        report.quick_csv_match(orders, _saved(spark, sf, name), ["o_orderkey"]).select(F.lit(name).alias("file"), "overall_match")
        for name in ("orders", "right_orders")
    ]
    return verdicts[0].unionByName(verdicts[1])


def _comparisons(spark, sf):
    """One comparison per region: one has no keys, one is not under test, one reads a missing column."""
    key = F.col("r_regionkey").cast("string")
    region = F.col("r_regionkey")
    return frame(spark, sf, "region").select(
        region.alias("row"), F.concat(F.lit("region_"), key).alias("Output ID"),
        F.concat(F.lit("region_"), key).alias("Model Name"),
        F.when(region == 1, " ").when(region == 4, "no_such_column").otherwise("c_custkey, c_name").alias("Key Columns"),
        F.when(region == 2, "Done").otherwise("testing").alias("Status"), F.lit("seen").alias("Notes"),
    )


VERDICTS = """SELECT r_regionkey::BIGINT AS ordinal, CASE WHEN r_regionkey = 4 THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN r_regionkey <> 4 THEN (SELECT count(*) FILTER (c_custkey % 53 = 0 OR c_custkey % 37 = 0 OR c_custkey % 41 = 0) = 0
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey) END AS overall_match FROM region"""


@query("compare_batch", VERDICTS + " WHERE r_regionkey NOT IN (1, 2)")
def compare_batch(spark, sf):
    left, right = _by_region(spark, sf), _by_region(spark, sf, "right_customer")
    outcomes = batch.compare_many(_comparisons(spark, sf), left, right, "row").outcomes
    return outcomes.select("ordinal", "status", "overall_match")


@query("compare_inventory", VERDICTS + " WHERE r_regionkey <> 1")
def compare_inventory(spark, sf):
    left, right = _by_region(spark, sf), _by_region(spark, sf, "right_customer")
    outcomes = batch.compare_inventory(_comparisons(spark, sf), left, right, "row").outcomes
    return outcomes.select("ordinal", "status", "overall_match")

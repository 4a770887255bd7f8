"""Comparison, counts, duplicates and samples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from checks.inputs import frame, oracle
from checks.registry import query
from ferrytally.functions.bands import sample_size
from ferrytally.operators import compare, counts, sampling
from ferrytally.operators.numbering import first_rows
from ferrytally.plans import report

ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
LINES = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
HOT = ["l_orderkey", "l_returnflag", "l_quantity", "l_shipdate"]
CUSTOMER = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
LINE_KEYS = ["l_orderkey", "l_linenumber"]
NUMERIC = {
    "o_orderkey", "o_custkey", "o_totalprice", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "c_nationkey", "c_acctbal",
}


def _order(columns, keys):
    return ", ".join(f"{c} ASC NULLS FIRST" for c in columns if c not in keys)


def joined_sql(left, right, keys, columns):
    """CTEs ``l``, ``r`` and the full match ``j`` of two tables."""
    part = ", ".join(keys)

    def numbered(t):
        return f"SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {_order(columns, keys)}) AS occ FROM {t}"

    on = " AND ".join(f"l.{k} IS NOT DISTINCT FROM r.{k}" for k in keys)
    out = [f"CASE WHEN l.occ IS NOT NULL THEN l.{k} ELSE r.{k} END AS {k}" for k in keys]
    out += [f"l.{c} AS {c}_left, r.{c} AS {c}_right" for c in columns if c not in keys]
    return f"""WITH l AS ({numbered(left)}), r AS ({numbered(right)}),
j AS (SELECT {', '.join(out)}, coalesce(l.occ, r.occ) AS occurrence,
  CASE WHEN l.occ IS NULL THEN 'right_only' WHEN r.occ IS NULL THEN 'left_only' ELSE 'both' END AS side
  FROM l FULL JOIN r ON {on} AND l.occ = r.occ)"""


def _equal(c, tol):
    a, b = f"{c}_left", f"{c}_right"
    if tol and c in NUMERIC:
        return f"coalesce({a} IS NOT DISTINCT FROM {b} OR abs({a} - {b}) <= {tol} + {tol} * abs({b}), false)"
    return f"({a} IS NOT DISTINCT FROM {b})"


def stats_sql(columns, keys, tol=0):
    parts = []
    for c in [c for c in columns if c not in keys]:
        diff = f"coalesce(max(abs(CAST({c}_left AS DOUBLE) - CAST({c}_right AS DOUBLE))), 0)" if c in NUMERIC else "0"
        parts.append(f"""SELECT '{c}' AS "column", count(*) FILTER ({_equal(c, tol)}) AS match_cnt,
  count(*) FILTER (NOT {_equal(c, tol)}) AS unequal_cnt, count(*) = count(*) FILTER ({_equal(c, tol)}) AS all_match,
  CAST({diff} AS DOUBLE) AS max_diff, count(*) FILTER (({c}_left IS NULL) <> ({c}_right IS NULL)) AS null_diff
  FROM j WHERE side = 'both'""")
    return "\nUNION ALL\n".join(parts)


def totals_sql(left, right, keys, columns, schema_match=True, tol=0, simple=False, counted=None):
    """Summary row of a comparison whose tables have the same columns."""
    rest = [c for c in columns if c not in keys]
    any_unequal = " OR ".join(f"NOT {_equal(c, tol)}" for c in rest)
    part = ", ".join(keys)
    cl, cr = counted or (left, right)
    negligible = (
        "pct < 1.0" if simple else
        "(left_rows = 0 AND right_rows = 0) OR (left_rows > 0 AND right_rows > 0 AND (abs(right_rows - left_rows) <= 10 "
        "OR pct <= 0.1 OR (pct <= 1.0 AND greatest(left_rows, right_rows) >= 10000)))"
    )

    def dup(t):
        return f"(SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM {t} GROUP BY {part}) WHERE n > 1)"

    diff_columns = " + ".join(f"CAST(count(*) FILTER (side = 'both' AND NOT {_equal(c, tol)}) > 0 AS BIGINT)" for c in rest)
    return joined_sql(left, right, keys, columns) + f""",
t AS (SELECT (SELECT count(*) FROM {cl}) AS left_rows, (SELECT count(*) FROM {cr}) AS right_rows,
  count(*) FILTER (side = 'both') AS common_rows, count(*) FILTER (side = 'left_only') AS left_only_rows,
  count(*) FILTER (side = 'right_only') AS right_only_rows,
  count(*) FILTER (side = 'both' AND ({any_unequal})) AS rows_with_differences,
  {diff_columns} AS columns_with_differences,
  {dup(left)} AS left_duplicate_rows, {dup(right)} AS right_duplicate_rows FROM j),
p AS (SELECT *, CASE WHEN greatest(left_rows, right_rows) = 0 THEN 0.0
  ELSE CAST(abs(right_rows - left_rows) AS DOUBLE) / greatest(left_rows, right_rows) * 100 END AS pct FROM t),
v AS (SELECT *, right_rows - left_rows AS difference, left_rows = right_rows AS count_match, pct AS percentage,
  {negligible} AS is_negligible, {str(schema_match).lower()} AS schema_match,
  left_only_rows = 0 AND right_only_rows = 0 AND rows_with_differences = 0 AS data_match FROM p)
SELECT * EXCLUDE (pct), schema_match AND (count_match OR is_negligible) AND data_match AS overall_match,
  CASE WHEN schema_match AND (count_match OR is_negligible) AND data_match THEN 'PERFECT MATCH'
  ELSE 'DISCREPANCIES FOUND' END AS status FROM v"""


def orders_pair(spark, sf):
    return frame(spark, sf, "orders"), frame(spark, sf, "right_orders")


def lines_pair(spark, sf):
    return frame(spark, sf, "lineitem"), frame(spark, sf, "right_lineitem")


def customer_pair(spark, sf):
    return frame(spark, sf, "left_customer"), frame(spark, sf, "right_customer")


ORDERS_JOIN = joined_sql("orders", "right_orders", ["o_orderkey"], ORDERS)
LINES_JOIN = joined_sql("lineitem", "right_lineitem", LINE_KEYS, LINES)
CUSTOMER_JOIN = joined_sql("left_customer", "right_customer", ["c_custkey"], CUSTOMER)
CUSTOMERS = ["left_customer", "right_customer"]


@query("compare_tables", oracle(["right_orders"], totals_sql("orders", "right_orders", ["o_orderkey"], ORDERS)))
def compare_orders(spark, sf):
    return report.compare_tables(*orders_pair(spark, sf), ["o_orderkey"]).summary


@query("compare_tables_duplicate_keys",
       oracle(["right_lineitem"], totals_sql("lineitem", "right_lineitem", LINE_KEYS, LINES)))
def compare_lines(spark, sf):
    return report.compare_tables(*lines_pair(spark, sf), LINE_KEYS).summary


def _hot_limit(df):
    """A twentieth of the rows, so that small tables have hot keys too."""
    return df.count() // 20


@query("compare_tables_hot_key",
       oracle(["hot_left", "hot_right"], totals_sql("hot_left", "hot_right", ["l_orderkey"], HOT)))
def compare_hot(spark, sf):
    """A third of all rows share one (NULL) key, which counts as hot at every scale."""
    left, right = frame(spark, sf, "hot_left"), frame(spark, sf, "hot_right")
    return report.compare_tables(left, right, ["l_orderkey"], hot_rows=_hot_limit(left)).summary


NULL_PAIR = ["a", "b", "v"]
_NULLED = """SELECT CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE 1 END AS a, CASE WHEN l_orderkey % 2 = 0 THEN 1 ELSE NULL END AS b,
  l_quantity {} AS v FROM lineitem"""
_NULLED_SQL = {"nl": _NULLED.format(""), "nr": _NULLED.format("+ CASE WHEN l_partkey % 31 = 0 THEN 1 ELSE 0 END")}


@query("compare_tables_hot_composite_null", "WITH " + ", ".join(f"{n} AS ({s})" for n, s in _NULLED_SQL.items()) + "," +
       totals_sql("nl", "nr", ["a", "b"], NULL_PAIR).removeprefix("WITH"))
def compare_hot_composite_null(spark, sf):
    """All rows share two keys, (NULL, 1) and (1, NULL), and both are hot."""
    frame(spark, sf, "lineitem").createOrReplaceTempView("lineitem")
    left, right = (spark.sql(s) for s in _NULLED_SQL.values())
    return report.compare_tables(left, right, ["a", "b"], hot_rows=_hot_limit(left)).summary


@query("compare_tables_error", """SELECT 'ERRORS FOUND' AS status, false AS overall_match, (SELECT count(*) FROM orders) AS left_rows,
  'schema' AS section, 'Key column no_such_column is missing on the ' || side AS error FROM (VALUES ('left'), ('right')) t(side)""")
def compare_error(spark, sf):
    """A key that neither table has: reported, not raised."""
    found = report.compare_tables(*orders_pair(spark, sf), ["no_such_column"])
    verdict = found.summary.first()
    return found.error_list.select(
        F.lit(verdict["status"]).alias("status"), F.lit(verdict["overall_match"]).alias("overall_match"),
        F.lit(verdict["left_rows"]).alias("left_rows"), "section", "error",
    )


@query("column_stats_mixed_dates", """SELECT 'd' AS "column", count(*) AS match_cnt, CAST(0 AS BIGINT) AS unequal_cnt, true AS all_match,
  CAST(0 AS DOUBLE) AS max_diff, CAST(0 AS BIGINT) AS null_diff FROM orders""")
def column_stats_mixed_dates(spark, sf):
    """A date against the same date as a timestamp."""
    day = frame(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return compare.column_stats(day, day.withColumn("d", F.col("d").cast("timestamp")), ["o_orderkey"])


@query("column_stats_big_integers", """SELECT 'n' AS "column", CAST(0 AS BIGINT) AS match_cnt, count(*) AS unequal_cnt, false AS all_match,
  CAST(1 AS DOUBLE) AS max_diff, CAST(0 AS BIGINT) AS null_diff FROM orders""")
def column_stats_big_integers(spark, sf):
    """Neighbours above 2**53, which doubles cannot tell apart."""
    large = frame(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") * 2 + F.lit(2**60)).alias("n"))
    return compare.column_stats(large, large.withColumn("n", F.col("n") + 1), ["o_orderkey"])


@query("rows_left_only_hot_key", oracle(["hot_left", "hot_right"], joined_sql("hot_left", "hot_right", ["l_orderkey"], HOT) + """
SELECT l_orderkey, CAST(count(*) AS BIGINT) AS rows FROM j WHERE side = 'left_only' GROUP BY 1"""))
def rows_left_only_hot_key(spark, sf):
    left, right = frame(spark, sf, "hot_left"), frame(spark, sf, "hot_right")
    only = compare.left_only(left, right, ["l_orderkey"], _hot_limit(left))
    return only.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("rows"))


@query("sampled_keys_join_hot_key", oracle(["hot_left"], """
SELECT * FROM hot_left WHERE l_orderkey IS NULL OR l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)"""))
def sampled_keys_join_hot_key(spark, sf):
    """A long key list that holds the hot (NULL) key."""
    left = frame(spark, sf, "hot_left")
    keys = frame(spark, sf, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    listed = keys.unionByName(spark.range(1).select(F.lit(None).cast("bigint").alias("l_orderkey")))
    return sampling.restrict(left, listed, ["l_orderkey"], None, _hot_limit(left), most=10)


@query("compare_tables_identical", totals_sql("lineitem", "lineitem", LINE_KEYS, LINES))
def compare_identical(spark, sf):
    lines = frame(spark, sf, "lineitem")
    return report.compare_tables(lines, lines, LINE_KEYS).summary


@query("data_match", oracle(["right_orders"], ORDERS_JOIN + f"""
SELECT count(*) FILTER (side <> 'both') = 0
  AND count(*) FILTER (side = 'both' AND ({' OR '.join(f'NOT {_equal(c, 0)}' for c in ORDERS[1:])})) = 0 AS data_match FROM j"""))
def data_match(spark, sf):
    return report.compare_tables(*orders_pair(spark, sf), ["o_orderkey"]).summary.select("data_match")


SAMPLE_RANK = "md5('42|' || coalesce(CAST(o_orderkey AS VARCHAR), '~null~'))"
AUTO_SIZE = """(SELECT CASE WHEN count(*) <= 1000 THEN count(*)
  ELSE least(CAST(ceil(384.16 / (1 + (384.16 - 1) / count(*))) AS BIGINT), count(*)) END FROM orders)"""
DRAWN = f"""drawn AS (SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY k, o_orderkey) AS n
  FROM (SELECT DISTINCT o_orderkey, {SAMPLE_RANK} AS k FROM orders)) WHERE n <= {AUTO_SIZE})"""


@query("compare_tables_sampled", oracle(["right_orders"], f"""WITH {DRAWN},
sl AS (SELECT * FROM orders SEMI JOIN drawn USING (o_orderkey)),
sr AS (SELECT * FROM right_orders SEMI JOIN drawn USING (o_orderkey)),
""" + totals_sql("sl", "sr", ["o_orderkey"], ORDERS, counted=("orders", "right_orders"))[5:]))
def compare_sampled(spark, sf):
    return report.compare_tables(*orders_pair(spark, sf), ["o_orderkey"], sample="auto").summary


@query("compare_join", oracle(["right_orders"], ORDERS_JOIN + " SELECT * FROM j"))
def compare_join(spark, sf):
    return compare.compare_join(*orders_pair(spark, sf), ["o_orderkey"])


@query("compare_join_null_keys", oracle(CUSTOMERS, CUSTOMER_JOIN + " SELECT * FROM j"))
def compare_join_null_keys(spark, sf):
    return compare.compare_join(*customer_pair(spark, sf), ["c_custkey"])


@query("rows_left_only", oracle(["right_lineitem"], LINES_JOIN + """
SELECT l.* EXCLUDE (occ) FROM l ANTI JOIN r ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber AND l.occ = r.occ"""))
def rows_left_only(spark, sf):
    return compare.left_only(*lines_pair(spark, sf), LINE_KEYS)


@query("rows_right_only", oracle(["right_orders"], """
SELECT * FROM right_orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)"""))
def rows_right_only(spark, sf):
    return compare.right_only(*orders_pair(spark, sf), ["o_orderkey"])


@query("rows_common", oracle(CUSTOMERS, CUSTOMER_JOIN + " SELECT * EXCLUDE (side) FROM j WHERE side = 'both'"))
def rows_common(spark, sf):
    return compare.rows_common(*customer_pair(spark, sf), ["c_custkey"])


@query("column_stats", oracle(["right_lineitem"], LINES_JOIN + stats_sql(LINES, LINE_KEYS)))
def column_stats(spark, sf):
    return compare.column_stats(*lines_pair(spark, sf), LINE_KEYS)


@query("column_stats_tolerant", oracle(["right_orders"], ORDERS_JOIN + stats_sql(ORDERS, ["o_orderkey"], 0.01)))
def column_stats_tolerant(spark, sf):
    return compare.column_stats(*orders_pair(spark, sf), ["o_orderkey"], 0.01, 0.01)


STATS = stats_sql(ORDERS, ["o_orderkey"])


@query("columns_with_differences", oracle(["right_orders"], ORDERS_JOIN + f"""
SELECT s.*, 'strict' AS mode FROM ({STATS}) s WHERE unequal_cnt > 0
UNION ALL SELECT s.*, 'reference' AS mode FROM ({STATS}) s WHERE unequal_cnt > 0 AND (max_diff > 0 OR null_diff > 0)"""))
def columns_with_differences(spark, sf):
    stats = report.compare_tables(*orders_pair(spark, sf), ["o_orderkey"]).settled().column_stats
    strict = compare.columns_with_differences(stats).withColumn("mode", F.lit("strict"))
    return strict.unionByName(
        compare.columns_with_differences(stats, "reference").withColumn("mode", F.lit("reference"))
    )


@query("rows_with_differences", oracle(["right_orders"], ORDERS_JOIN + f"""
SELECT o_orderkey, occurrence, concat_ws(',', {', '.join(f"CASE WHEN NOT {_equal(c, 0)} THEN '{c}' END" for c in ORDERS[1:])}) AS differing
FROM j WHERE side = 'both' AND ({' OR '.join(f'NOT {_equal(c, 0)}' for c in ORDERS[1:])})"""))
def rows_with_differences(spark, sf):
    rows = compare.rows_with_differences(*orders_pair(spark, sf), ["o_orderkey"])
    return rows.select("o_orderkey", "occurrence", F.array_join("columns", ",").alias("differing"))


LINE_COUNTS = "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1"


@query("duplicate_row_count", f"""
SELECT CAST(coalesce(sum(rows), 0) AS BIGINT) AS duplicate_rows, count(*) AS duplicate_keys FROM ({LINE_COUNTS})""")
def duplicate_row_count(spark, sf):
    return compare.duplicate_row_count(frame(spark, sf, "lineitem"), LINE_KEYS)


@query("duplicate_keys", LINE_COUNTS)
def duplicate_keys(spark, sf):
    return compare.duplicate_keys(frame(spark, sf, "lineitem"), LINE_KEYS, limit=None)


@query("duplicate_keys_listing", f"SELECT * FROM ({LINE_COUNTS}) ORDER BY l_orderkey, l_linenumber LIMIT 20")
def duplicate_keys_listing(spark, sf):
    return compare.duplicate_keys(frame(spark, sf, "lineitem"), LINE_KEYS, limit=20)


@query("distinct_keys", oracle(["left_customer"], """
SELECT DISTINCT c_custkey, false AS null_dropped FROM left_customer
UNION ALL SELECT DISTINCT c_custkey, true FROM left_customer WHERE c_custkey IS NOT NULL"""))
def distinct_keys(spark, sf):
    left = frame(spark, sf, "left_customer")
    every = compare.distinct_keys(left, ["c_custkey"]).withColumn("null_dropped", F.lit(False))
    return every.unionByName(
        compare.distinct_keys(left, ["c_custkey"], drop_null=True).withColumn("null_dropped", F.lit(True))
    )


@query("occurrence_number", f"""
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_order(LINES, LINE_KEYS)}) AS occurrence FROM lineitem""")
def occurrence_number(spark, sf):
    return compare.occurrence_number(frame(spark, sf, "lineitem"), LINE_KEYS)


@query("occurrence_number_hot_key", oracle(["hot_left"], f"""
SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_order(HOT, ['l_orderkey'])}) AS occurrence FROM hot_left"""))
def occurrence_number_hot_key(spark, sf):
    left = frame(spark, sf, "hot_left")
    return compare.occurrence_number(left, ["l_orderkey"], hot_rows=_hot_limit(left))


@query("string_keys", oracle(["text_key_orders"], """
SELECT t.o_orderkey AS o_orderkey, o.o_custkey AS o_custkey_left, t.o_custkey AS o_custkey_right, 1::BIGINT AS occurrence,
  o.o_orderstatus AS o_orderstatus_left, t.o_orderstatus AS o_orderstatus_right, o.o_totalprice AS o_totalprice_left,
  t.o_totalprice AS o_totalprice_right
FROM orders o JOIN text_key_orders t ON CAST(o.o_orderkey AS VARCHAR) = t.o_orderkey"""))
def string_keys(spark, sf):
    return compare.rows_common(frame(spark, sf, "orders"), frame(spark, sf, "text_key_orders"), ["o_orderkey"])


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf):
    return counts.row_count(frame(spark, sf, "lineitem"))


def bands_sql(left, right):
    pct = "CAST(abs(b - a) AS DOUBLE) / nullif(greatest(a, b), 0) * 100"
    return f"""SELECT a AS left_rows, b AS right_rows, b - a AS difference, a = b AS match,
  coalesce({pct}, 0.0) AS percentage,
  (a = 0 AND b = 0) OR (a > 0 AND b > 0 AND (abs(b - a) <= 10 OR {pct} <= 0.1 OR ({pct} <= 1.0 AND greatest(a, b) >= 10000))) AS is_negligible,
  CASE WHEN a = 0 AND b = 0 THEN 'Both datasets are empty' WHEN a = 0 OR b = 0 THEN 'One dataset is empty'
    WHEN abs(b - a) <= 10 THEN 'Very small absolute difference (' || abs(b - a) || ' rows)'
    WHEN {pct} <= 0.1 THEN 'Very small percentage difference (' || printf('%.3f', {pct}) || '%)'
    WHEN {pct} <= 1.0 AND greatest(a, b) >= 10000 THEN 'Small percentage difference for large dataset (' || printf('%.3f', {pct}) || '%)'
    ELSE 'Significant difference: ' || abs(b - a) || ' rows (' || printf('%.3f', {pct}) || '%)' END AS reason
  FROM (SELECT (SELECT count(*) FROM {left}) AS a, (SELECT count(*) FROM {right}) AS b)"""


COUNT_CASES = {
    "orders": ("orders", "right_orders"),
    "lineitem": ("lineitem", "right_lineitem"),
    "customer": ("left_customer", "right_customer"),
    "same": ("lineitem", "lineitem"),
    "empty": ("(SELECT * FROM orders WHERE o_orderkey < 0)", "right_orders"),
    "none": ("(SELECT * FROM orders WHERE o_orderkey < 0)", "(SELECT * FROM orders WHERE o_orderkey < 0)"),
}


@query("row_count_diff", oracle(
    ["right_orders", "right_lineitem", *CUSTOMERS],
    "\nUNION ALL ".join(f"SELECT '{k}' AS pair, * FROM ({bands_sql(*v)})" for k, v in COUNT_CASES.items())))
def row_count_diff(spark, sf):
    def side(name):
        return frame(spark, sf, "orders").filter("o_orderkey < 0") if name.startswith("(") else frame(spark, sf, name)

    parts = [
        counts.row_count_diff(side(left), side(right)).withColumn("pair", F.lit(k))
        for k, (left, right) in COUNT_CASES.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("sample_count_diff", oracle(["right_lineitem"], """
SELECT a AS left_rows, b AS right_rows, abs(b - a) AS difference, a = b AS match,
  CAST(abs(b - a) AS DOUBLE) / greatest(a, b) * 100 AS percentage,
  CAST(abs(b - a) AS DOUBLE) / greatest(a, b) * 100 < 1.0 AS is_negligible
FROM (SELECT (SELECT count(*) FROM lineitem) AS a, (SELECT count(*) FROM right_lineitem) AS b)"""))
def sample_count_diff(spark, sf):
    return counts.sample_count_diff(*lines_pair(spark, sf))


SIZE_SQL = """CASE WHEN n <= 1000 THEN n
  ELSE least(CAST(ceil(n0 / (1 + (n0 - 1) / n)) AS BIGINT), n) END"""


@query("sample_size", f"""
SELECT l_suppkey, n AS row_count, {SIZE_SQL.replace('n0', '384.16::DOUBLE')} AS sample_95,
  {SIZE_SQL.replace('n0', '(2.576::DOUBLE * 2.576 * 0.25 / (0.02 * 0.02))')} AS sample_99
FROM (SELECT l_suppkey, count(*) * 10 AS n FROM lineitem GROUP BY l_suppkey)""")
def sample_plan(spark, sf):
    sizes = frame(spark, sf, "lineitem").groupBy("l_suppkey").agg((F.count(F.lit(1)) * 10).alias("row_count"))
    return sizes.select(
        "l_suppkey", "row_count", sample_size(F.col("row_count")).alias("sample_95"),
        sample_size(F.col("row_count"), 0.99, 0.02).alias("sample_99"),
    )


@query("sample_ordered", oracle(["left_customer"], """
SELECT * FROM left_customer ORDER BY c_custkey ASC NULLS LAST, c_name LIMIT 370"""))
def sample_ordered(spark, sf):
    return sampling.ordered_sample(frame(spark, sf, "left_customer"), ["c_custkey", "c_name"], 370)


@query("sample_keys_random", f"""WITH {DRAWN} SELECT * FROM drawn""")
def sample_keys_random(spark, sf):
    orders = frame(spark, sf, "orders")
    return sampling.sample_keys(orders, ["o_orderkey"], sampling.sample_size_of(orders.count()))


@query("sample_keys_random_large", f"""
SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY k, o_orderkey) AS n, count(*) OVER () AS m
  FROM (SELECT DISTINCT o_orderkey, {SAMPLE_RANK} AS k FROM orders)) WHERE n <= m // 5""")
def sample_keys_random_large(spark, sf):
    """A fifth of all keys: too many for a top-n, drawn by range partitions."""
    ranked = compare.distinct_keys(frame(spark, sf, "orders"), ["o_orderkey"]).withColumn(
        "rank", sampling.sample_rank(["o_orderkey"])
    )
    n = ranked.count() // 5
    return first_rows(ranked, [F.col("rank")], n, direct_limit=500).select("o_orderkey")


@query("sample_sync_random", oracle(["right_orders"], f"""WITH {DRAWN}
SELECT 'left' AS side, * FROM orders SEMI JOIN drawn USING (o_orderkey)
UNION ALL BY NAME SELECT 'right' AS side, * FROM right_orders SEMI JOIN drawn USING (o_orderkey)"""))
def sample_sync_random(spark, sf):
    left, right = sampling.sync_sample(*orders_pair(spark, sf), ["o_orderkey"])
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))


FIRST = """firsts AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL
  GROUP BY ALL ORDER BY min(l_shipdate), l_orderkey, l_linenumber LIMIT 370)"""


@query("sample_sync_first", oracle(["right_lineitem"], f"""WITH {FIRST}
SELECT 'left' AS side, * FROM lineitem SEMI JOIN firsts USING (l_orderkey, l_linenumber)
UNION ALL BY NAME SELECT 'right' AS side, * FROM right_lineitem SEMI JOIN firsts USING (l_orderkey, l_linenumber)"""))
def sample_sync_first(spark, sf):
    left, right = sampling.sync_first(*lines_pair(spark, sf), LINE_KEYS, ["l_shipdate"], 370)
    return left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))


@query("sampled_keys_join", """
SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey % 10 = 0)""")
def sampled_keys_join(spark, sf):
    keys = frame(spark, sf, "orders").filter("o_custkey % 10 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return sampling.restrict(frame(spark, sf, "lineitem"), keys, ["l_orderkey"])


@query("sample_coverage", oracle(["right_orders"], f"""WITH {DRAWN},
c AS (SELECT (SELECT count(*) FROM drawn) AS expected, (SELECT count(*) FROM orders SEMI JOIN drawn USING (o_orderkey)) AS l,
  (SELECT count(*) FROM right_orders SEMI JOIN drawn USING (o_orderkey) WHERE o_orderstatus = 'F') AS r)
SELECT 'left' AS side, expected, l AS actual, l < expected * 0.8 AS warn FROM c
UNION ALL SELECT 'right', expected, r, r < expected * 0.8 FROM c"""))
def sample_coverage(spark, sf):
    orders, right = orders_pair(spark, sf)
    size = sampling.sample_size_of(orders.count())
    drawn = sampling.sample_keys(orders, ["o_orderkey"], size)
    left_rows = sampling.restrict(orders, drawn, ["o_orderkey"], size)
    right_rows = sampling.restrict(right, drawn, ["o_orderkey"], size).filter("o_orderstatus = 'F'")
    return sampling.coverage({"left": left_rows, "right": right_rows}, drawn)


@query("sample_independent", "SELECT CAST(370 AS BIGINT) AS drawn, CAST(370 AS BIGINT) AS keys, CAST(370 AS BIGINT) AS found FROM (SELECT count(*) FROM orders)")
def sample_independent(spark, sf):
    """Rows drawn, different keys among them, and rows that are rows of the table."""
    orders = frame(spark, sf, "orders")
    drawn = sampling.random_rows(orders, 370)
    found = drawn.join(orders.select(*[F.col(c).alias(f"t_{c}") for c in ORDERS]), reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in ORDERS]
    ), "left")
    return found.agg(
        F.count(F.lit(1)).alias("drawn"), F.countDistinct("o_orderkey").alias("keys"), F.count("t_o_orderkey").alias("found")
    )


@query("top_examples", oracle(["right_orders"], """
SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM right_orders) ORDER BY o_orderkey LIMIT 5"""))
def top_examples(spark, sf):
    return compare.top_examples(compare.left_only(*orders_pair(spark, sf), ["o_orderkey"]), ["o_orderkey"], 5)


@query("key_in_filter", oracle(["left_customer"], """
SELECT * FROM left_customer WHERE c_custkey IN (SELECT c_custkey FROM left_customer WHERE c_nationkey % 5 = 0 AND c_custkey IS NOT NULL)"""))
def key_in_filter(spark, sf):
    left = frame(spark, sf, "left_customer")
    return sampling.rows_for_keys(left, left.filter("c_nationkey % 5 = 0"), ["c_custkey"])


@query("key_tuple_filter", oracle(["control"], """WITH k AS (SELECT DISTINCT dataset_id, notes FROM control WHERE row_id % 2 = 0),
keyed AS (SELECT row_id, dataset_id, notes FROM control)
SELECT * FROM keyed c WHERE EXISTS (SELECT 1 FROM k WHERE
  (CASE WHEN trim(k.dataset_id) = '' THEN c.dataset_id = '' OR c.dataset_id IS NULL ELSE c.dataset_id IS NOT DISTINCT FROM k.dataset_id END)
  AND (CASE WHEN trim(k.notes) = '' THEN c.notes = '' OR c.notes IS NULL ELSE c.notes IS NOT DISTINCT FROM k.notes END))"""))
def key_tuple_filter(spark, sf):
    rows = frame(spark, sf, "control").select("row_id", "dataset_id", "notes")
    return sampling.rows_for_keys(rows, rows.filter("row_id % 2 = 0"), ["dataset_id", "notes"])


@query("executive_summary", oracle(["right_orders"], totals_sql("orders", "right_orders", ["o_orderkey"], ORDERS).rsplit("SELECT * EXCLUDE", 1)[0] + """
SELECT 0 AS ordinal, 'info' AS severity, 'orders -> right_orders' AS text
UNION ALL SELECT 3, CASE WHEN left_duplicate_rows + right_duplicate_rows > 0 THEN 'error' ELSE 'ok' END,
  CASE WHEN left_duplicate_rows + right_duplicate_rows > 0 THEN 'Duplicate keys detected' ELSE 'Duplicate keys: None found' END FROM v
UNION ALL SELECT 4, CASE WHEN abs(difference) * 100.0 / left_rows <= 1 THEN 'ok' WHEN abs(difference) * 100.0 / left_rows <= 5 THEN 'warn' ELSE 'error' END,
  format('Rows: left {:,} vs right {:,}', left_rows, right_rows) || printf(' (%.2f%% difference)', abs(difference) * 100.0 / left_rows) FROM v
UNION ALL SELECT 5, 'ok', 'Columns: left 6 vs right 6'
UNION ALL SELECT 13, 'error', 'Rows missing on the right: ' || left_only_rows FROM v WHERE left_only_rows > 0
UNION ALL SELECT 14, 'warn', 'Extra rows on the right: ' || right_only_rows FROM v WHERE right_only_rows > 0
UNION ALL SELECT 15, 'warn', 'Columns with different values: o_orderstatus, o_totalprice, o_orderpriority' FROM v"""))
def executive_summary(spark, sf):
    compared = report.compare_tables(*orders_pair(spark, sf), ["o_orderkey"]).settled()
    return report.executive_summary(compared, "orders -> right_orders")


LISTED = """(SELECT list('(l_orderkey=' || l_orderkey || ', l_linenumber=' || l_linenumber || ')' ORDER BY l_orderkey, l_linenumber) FROM
  (SELECT * FROM d ORDER BY l_orderkey, l_linenumber LIMIT 10))"""


@query("executive_summary_duplicates", f"""WITH d AS ({LINE_COUNTS}), c AS (SELECT sum(rows) AS rows, count(*) AS n FROM d)
SELECT 1 AS ordinal, 'error' AS severity, 'left: ' || rows || chr(10) || '  left duplicate keys: ' ||
  CASE WHEN n <= 10 THEN array_to_string({LISTED}, ', ')
  ELSE n || ' unique combinations (showing first 5)' || chr(10) || '    First 5: ' || array_to_string({LISTED}[1:5], ', ') END AS text
FROM c WHERE n > 0""")
def executive_summary_duplicates(spark, sf):
    return report.duplicate_lines(frame(spark, sf, "lineitem"), LINE_KEYS, "left", 1)


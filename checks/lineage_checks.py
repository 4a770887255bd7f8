"""Lineage over flow tables, entity maps and edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import frame, oracle
from checks.registry import query
from ferrytally.functions.cells import clean_ids, split_ids
from ferrytally.operators import lineage
from ferrytally.session import scratch_path
from ferrytally.sources.readers import read_lineage

SPLIT = "list_filter(list_transform(regexp_split_to_array(coalesce({0}, ''), '[\\n,]+'), lambda x: trim(x)), lambda x: x <> '')"
SOURCES, OUTPUTS = SPLIT.format("source_ids"), SPLIT.format("output_ids")


def _cell(values):
    return f"array_to_string(list_sort(list_distinct({values})), ',' || chr(10))"


FLOW_EDGES = f"""fe AS (SELECT DISTINCT flow_id, 'source' AS role, unnest({SOURCES}) AS dataset_id FROM flows
UNION SELECT DISTINCT flow_id, 'output', unnest({OUTPUTS}) FROM flows)"""


def entities(spark, sf):
    """Lineage entities: every flow, and every second customer dataset with the flows that read it."""
    refs = "array<struct<id:string,type:string>>"

    def listed(name, kind):
        return F.transform(split_ids(F.col(name)), lambda x: F.struct(x.alias("id"), F.lit(kind).alias("type")))

    other = F.array(F.struct(F.lit("X").alias("id"), F.lit("REPORT").alias("type")))
    flows = frame(spark, sf, "flows").select(
        F.concat(F.lit("DATAFLOW"), "flow_id").alias("entity_key"), F.col("flow_id").alias("id"),
        F.lit("DATAFLOW").alias("type"), F.concat(listed("source_ids", "DATA_SOURCE"), other).cast(refs).alias("parents"),
        listed("output_ids", "DATA_SOURCE").cast(refs).alias("children"),
    )
    flow_id = F.concat(F.lit("FO"), F.col("o_orderkey").cast("string"))
    readers = frame(spark, sf, "orders").filter("o_custkey % 2 = 0").groupBy("o_custkey").agg(
        F.collect_list(F.struct(flow_id.alias("id"), F.lit("DATAFLOW").alias("type"))).alias("children")
    )
    dataset_id = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    datasets = readers.select(
        F.concat(F.lit("DATA_SOURCE"), dataset_id).alias("entity_key"), dataset_id.alias("id"),
        F.lit("DATA_SOURCE").alias("type"), F.lit(None).cast(refs).alias("parents"), F.col("children").cast(refs),
    )
    return flows.unionByName(datasets)


def customer_ids(spark, sf):
    return frame(spark, sf, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("dataset_id"), F.col("c_name").alias("dataset_name")
    )


@query("scan_lineage_json", oracle(["flows"], f"""WITH {FLOW_EDGES}
SELECT flow_id, role, dataset_id FROM fe"""))
def scan_lineage_json(spark, sf):
    """Entities written as JSON exports (one document per entity) and scanned back."""
    path = scratch_path(spark, "lineage")
    entity = F.struct("id", "type", "parents", "children")
    documents = entities(spark, sf).select(F.to_json(F.struct(F.create_map("entity_key", entity).alias("entities"))))
    documents.write.text(path)
    return lineage.lineage_edges(read_lineage(spark, path, multi_line=False)).distinct()


@query("scan_lineage_export", oracle(["flows"], f"""WITH {FLOW_EDGES}
SELECT flow_id, role, dataset_id FROM fe"""))
def scan_lineage_export(spark, sf):
    """One file with one object, its texts full of quotes, braces and escapes: read in byte ranges."""
    path = scratch_path(spark, "export")
    note = F.lit('} \\ " { "entities": { \n \\\\').alias("note")
    member = F.to_json(F.create_map("entity_key", F.struct("id", note, "type", "parents", "children")))
    lines = entities(spark, sf).select(member.alias("m")).selectExpr("1 AS at", "',' || substring(m, 2, length(m) - 2) AS value")
    edges = spark.createDataFrame(
        [(0, '{"version": {"note": "}{"}, "entities" : {"none": null'), (2, '}, "more": [{"entities": {"x": {"id": "no", "type": "DATAFLOW"}}}]}')],
        "at int, value string",
    )
    # A single file is written by a single task; it is sorted with spilling, never held.
    edges.unionByName(lines).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    return lineage.lineage_edges(read_lineage(spark, path)).distinct()


@query("lineage_edges", oracle(["flows"], f"""
SELECT flow_id, 'source' AS role, unnest({SOURCES}) AS dataset_id FROM flows
UNION ALL SELECT flow_id, 'output', unnest({OUTPUTS}) FROM flows"""))
def lineage_edges(spark, sf):
    return lineage.lineage_edges(entities(spark, sf))


@query("producers_of", oracle(["flows"], f"""WITH {FLOW_EDGES},
p AS (SELECT flow_id FROM fe WHERE role = 'output' AND dataset_id IN (SELECT 'C' || c_custkey FROM customer WHERE c_custkey % 3 = 0))
SELECT flow_id, 0::BIGINT AS part, coalesce(string_agg(dataset_id, ',' || chr(10) ORDER BY dataset_id) FILTER (role = 'source'), '') AS source_ids,
  coalesce(string_agg(dataset_id, ',' || chr(10) ORDER BY dataset_id) FILTER (role = 'output'), '') AS output_ids
FROM fe WHERE flow_id IN (SELECT flow_id FROM p) GROUP BY flow_id"""))
def producers_of(spark, sf):
    wanted = frame(spark, sf, "customer").filter("c_custkey % 3 = 0").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("dataset_id")
    )
    return lineage.producers_of(entities(spark, sf), wanted)


@query("producer_ids", oracle(["flows"], f"""WITH {FLOW_EDGES},
p AS (SELECT flow_id FROM fe WHERE role = 'output' AND dataset_id IN (SELECT 'C' || c_custkey FROM customer WHERE c_custkey % 3 = 0))
SELECT DISTINCT flow_id, role AS kind, dataset_id AS id FROM fe WHERE flow_id IN (SELECT flow_id FROM p)"""))
def producer_ids(spark, sf):
    wanted = frame(spark, sf, "customer").filter("c_custkey % 3 = 0").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("dataset_id")
    )
    return lineage.producer_ids(entities(spark, sf), wanted)


CONSUMERS = "SELECT DISTINCT 'C' || o_custkey AS dataset_id, 'FO' || o_orderkey AS flow_id FROM orders"


@query("consumers_of", f"{CONSUMERS} WHERE o_custkey IN (SELECT c_custkey FROM customer)")
def consumers_of(spark, sf):
    return lineage.consumers_of(entities(spark, sf), customer_ids(spark, sf))


REPORT = f"""report AS (SELECT 'C' || c_custkey AS dataset_id, c_name AS dataset_name, 0::BIGINT AS part, coalesce(f, 'None') AS flow_ids,
  coalesce(n, 0) AS flow_count FROM customer LEFT JOIN (SELECT dataset_id, string_agg(flow_id, ', ' ORDER BY flow_id) AS f, count(*) AS n
  FROM ({CONSUMERS}) GROUP BY dataset_id) x ON x.dataset_id = 'C' || c_custkey)"""


@query("lineage_report", f"WITH {REPORT} SELECT * FROM report")
def lineage_report(spark, sf):
    wanted = customer_ids(spark, sf)
    return lineage.lineage_report(wanted, lineage.consumers_of(entities(spark, sf), wanted))


@query("lineage_summary", f"""WITH {REPORT}
SELECT count(*) AS datasets, count(*) FILTER (flow_count > 0) AS datasets_with_flows, CAST(sum(flow_count) AS BIGINT) AS flow_ids,
  CAST(sum(flow_count) AS DOUBLE) / count(*) AS mean_flows FROM report""")
def lineage_summary(spark, sf):
    wanted = customer_ids(spark, sf)
    return lineage.lineage_summary(
        lineage.lineage_report(wanted, lineage.consumers_of(entities(spark, sf), wanted))
    )


@query("split_id_list", oracle(["flows"], f"SELECT flow_id, array_to_string({SOURCES}, '|') AS ids, len({SOURCES})::INT AS n FROM flows"))
def split_id_list(spark, sf):
    ids = split_ids(F.col("source_ids"))
    return frame(spark, sf, "flows").select("flow_id", F.array_join(ids, "|").alias("ids"), F.size(ids).alias("n"))


@query("clean_id_list", oracle(["flows"], f"SELECT flow_id, {_cell(SOURCES)} AS source_ids, {_cell(OUTPUTS)} AS output_ids FROM flows"))
def clean_id_list(spark, sf):
    return frame(spark, sf, "flows").select(
        "flow_id", clean_ids(F.col("source_ids")).alias("source_ids"), clean_ids(F.col("output_ids")).alias("output_ids")
    )


@query("group_concat", oracle(["flows"], f"""WITH d AS (SELECT DISTINCT substr(flow_id, 1, 4) AS k, 's' AS kind, unnest({SOURCES}) AS id FROM flows
  UNION ALL SELECT DISTINCT substr(flow_id, 1, 4), 'o', unnest({OUTPUTS}) FROM flows),
n AS (SELECT *, (row_number() OVER (PARTITION BY k, kind ORDER BY id) - 1) // 10000 AS part FROM d)
SELECT k AS flow_group, part, coalesce(string_agg(id, ',' || chr(10) ORDER BY id) FILTER (kind = 's'), '') AS source_ids,
  coalesce(string_agg(id, ',' || chr(10) ORDER BY id) FILTER (kind = 'o'), '') AS output_ids FROM n GROUP BY k, part"""))
def group_concat(spark, sf):
    flows = frame(spark, sf, "flows").withColumn("flow_group", F.substring("flow_id", 1, 4))
    return lineage.merge_ids(flows, "flow_group", ["source_ids", "output_ids"])


@query("group_concat_long", oracle(["flows"], f"""WITH d AS (SELECT DISTINCT substr(flow_id, 1, 2) AS k, unnest({OUTPUTS}) AS id FROM flows),
n AS (SELECT *, (row_number() OVER (PARTITION BY k ORDER BY id) - 1) // 50 AS part FROM d)
SELECT k AS flow_group, part, string_agg(id, ',' || chr(10) ORDER BY id) AS output_ids FROM n GROUP BY k, part"""))
def group_concat_long(spark, sf):
    """A few groups hold all ids: their lists continue over many cells."""
    flows = frame(spark, sf, "flows").withColumn("flow_group", F.substring("flow_id", 1, 2))
    return lineage.merge_ids(flows, "flow_group", ["output_ids"], cell_ids=50)


EXPLODED = f"""exploded AS (SELECT flow_id, {_cell(SOURCES)} AS source_ids,
  unnest(CASE WHEN len({OUTPUTS}) = 0 THEN [''] ELSE list_distinct({OUTPUTS}) END) AS output_id FROM flows)"""


@query("explode_outputs", oracle(["flows"], f"WITH {EXPLODED} SELECT * FROM exploded"))
def explode_outputs(spark, sf):
    return lineage.explode_outputs(frame(spark, sf, "flows"))


@query("expansion_stats", oracle(["flows"], f"""WITH {EXPLODED}
SELECT (SELECT count(*) FROM flows) AS rows_before, count(*) AS rows_after, count(DISTINCT flow_id) AS unique_flows,
  count(DISTINCT output_id) AS unique_outputs, (SELECT count(DISTINCT s) FROM (SELECT unnest({SOURCES}) AS s FROM flows)) AS unique_sources,
  CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM flows) AS ratio FROM exploded"""))
def expansion_stats(spark, sf):
    return lineage.expansion_stats(frame(spark, sf, "flows"))


@query("source_map", oracle(["flows"], f"""
SELECT DISTINCT output_id, unnest(s) AS source_id FROM (SELECT unnest({OUTPUTS}) AS output_id, {SOURCES} AS s FROM flows)"""))
def source_map(spark, sf):
    return lineage.source_map(frame(spark, sf, "flows"))


CLOSURE = """WITH closure AS (SELECT output_id, source_id FROM edges
  UNION SELECT c.output_id, e.source_id FROM closure c JOIN edges e ON c.source_id = e.output_id)
"""


@query("transitive_sources_deep", oracle(["chains"], CLOSURE.replace("edges", "chains") + """
SELECT output_id, count(*) AS sources, min(source_id) AS first_source FROM closure GROUP BY output_id""", recursive=True))
def transitive_sources_deep(spark, sf):
    """Chains of 256 orders that end in a cycle."""
    closed = lineage.transitive_sources(frame(spark, sf, "chains"))
    return closed.groupBy("output_id").agg(F.count(F.lit(1)).alias("sources"), F.min("source_id").alias("first_source"))


@query("transitive_sources_near", oracle(["edges"], """
SELECT output_id, source_id FROM edges UNION SELECT a.output_id, b.source_id FROM edges a JOIN edges b ON a.source_id = b.output_id
UNION SELECT a.output_id, c.source_id FROM edges a JOIN edges b ON a.source_id = b.output_id JOIN edges c ON b.source_id = c.output_id"""))
def transitive_sources_near(spark, sf):
    """Sources at most three steps away."""
    return lineage.transitive_sources(frame(spark, sf, "edges"), max_hops=3)


@query("transitive_sources_hub", """SELECT o_orderkey::VARCHAR AS output_id, 'hub' AS source_id FROM orders
UNION ALL SELECT 'hub', 'r' || r_regionkey FROM region
UNION ALL SELECT o_orderkey::VARCHAR, 'r' || r_regionkey FROM orders, region""")
def transitive_sources_hub(spark, sf):
    """All orders come from one hub, which comes from the regions."""
    orders, regions = frame(spark, sf, "orders"), frame(spark, sf, "region")
    edges = orders.select(F.col("o_orderkey").cast("string").alias("output_id"), F.lit("hub").alias("source_id")).unionByName(
        regions.select(F.lit("hub").alias("output_id"), F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("source_id"))
    )
    return lineage.transitive_sources(edges, hot_rows=100)


@query("transitive_sources", oracle(["edges"], CLOSURE + "SELECT * FROM closure", recursive=True))
def transitive_sources(spark, sf):
    return lineage.transitive_sources(frame(spark, sf, "edges"))


@query("transitive_source_cells", oracle(["edges"], CLOSURE + """
SELECT output_id, 0::BIGINT AS part, string_agg(source_id, ',' || chr(10) ORDER BY source_id) AS all_source_ids FROM closure GROUP BY output_id""", recursive=True))
def transitive_source_cells(spark, sf):
    return lineage.source_cells(lineage.transitive_sources(frame(spark, sf, "edges")))

"""Effort scoring of dataflow steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import frame, oracle
from checks.registry import query
from ferrytally.operators import scoring

BASE = "CASE action_type WHEN 'SelectValues' THEN 1.0 WHEN 'Filter' THEN 6.0 WHEN 'MergeJoin' THEN 5.0 ELSE 20.0 END::DOUBLE"
LENGTH = """CASE WHEN action_type = 'SelectValues' THEN 0.0
  WHEN sql_chars <= 0 AND fallback_chars > 0 THEN least((fallback_chars // 800) * 0.5, 12)
  ELSE least((sql_chars // 500) * 0.75, 15) END::DOUBLE"""
SCORED = f"scored AS (SELECT *, {BASE} AS base_minutes, {LENGTH} AS length_minutes, {BASE} + {LENGTH} AS total_minutes FROM steps)"
POINTS = """points AS (SELECT dataflow_id, CAST(round_even(sum(total_minutes), 0) AS BIGINT) AS step_points, count(*) AS total_tiles,
  CAST(round_even(sum(total_minutes) + count(*), 0) AS BIGINT) AS subtotal_points FROM scored GROUP BY dataflow_id)"""


def steps(spark, sf):
    return frame(spark, sf, "steps")


def scored(spark, sf):
    return scoring.score_steps(steps(spark, sf), scoring.weights(spark))


@query("weight_lookup_join", oracle(["steps"], f"SELECT *, {BASE} AS base_minutes FROM steps"))
def weight_lookup_join(spark, sf):
    return scoring.with_base_minutes(steps(spark, sf), scoring.weights(spark))


@query("length_minutes", oracle(["steps"], f"SELECT dataflow_id, position, {LENGTH} AS length_minutes FROM steps"))
def length_minutes(spark, sf):
    minutes = scoring.length_minutes(F.col("action_type"), F.col("sql_chars"), F.col("fallback_chars"))
    return steps(spark, sf).select("dataflow_id", "position", minutes.alias("length_minutes"))


@query("step_scores", oracle(["steps"], f"WITH {SCORED} SELECT * FROM scored"))
def step_scores(spark, sf):
    return scored(spark, sf)


@query("step_points", oracle(["steps"], f"WITH {SCORED}, {POINTS} SELECT * FROM points"))
def step_points(spark, sf):
    return scoring.step_points(scored(spark, sf))


@query("flow_scores", oracle(["steps"], f"""WITH {SCORED}, {POINTS},
requested AS (SELECT DISTINCT dataflow_id FROM steps),
shown AS (SELECT *, dataflow_id % 7 <> 0 AS ok FROM requested JOIN points USING (dataflow_id))
SELECT dataflow_id || '.sql' AS filename, dataflow_id, CASE WHEN ok THEN CAST(step_points AS VARCHAR) ELSE '' END AS step_points,
  CASE WHEN ok THEN CAST(total_tiles AS VARCHAR) ELSE '' END AS total_tiles,
  CASE WHEN ok THEN CAST(subtotal_points AS VARCHAR) ELSE '' END AS subtotal_points, '' AS total_points, ok AS translation_ok,
  CASE WHEN ok THEN '' ELSE left(repeat('broken ', 100), 500) END AS error FROM shown"""))
def flow_scores(spark, sf):
    requested = steps(spark, sf).select("dataflow_id").distinct()
    errors = requested.filter("dataflow_id % 7 = 0").withColumn("error", F.repeat(F.lit("broken "), 100))
    return scoring.flow_scores(requested, scored(spark, sf), errors)


@query("pair_by_position", oracle(["steps"], """
SELECT dataflow_id, position, action_type, position % 2 = 0 AS success FROM steps WHERE NOT (dataflow_id % 5 = 0 AND position >= 3)"""))
def pair_by_position(spark, sf):
    actions = steps(spark, sf).select("dataflow_id", "position", "action_type")
    return scoring.pair_by_position(actions, _results(actions), "dataflow_id", "position")


def _results(actions):
    kept = actions.filter("NOT (dataflow_id % 5 = 0 AND position >= 3)")
    return kept.select("dataflow_id", "position", (F.col("position") % 2 == 0).alias("success"))


@query("pair_mismatch", oracle(["steps"], """
SELECT dataflow_id, count(*) AS actions, count(*) FILTER (NOT (dataflow_id % 5 = 0 AND position >= 3)) AS results
FROM steps GROUP BY dataflow_id HAVING actions <> results"""))
def pair_mismatch(spark, sf):
    actions = steps(spark, sf).select("dataflow_id", "position", "action_type")
    return scoring.position_mismatch(actions, _results(actions), "dataflow_id")

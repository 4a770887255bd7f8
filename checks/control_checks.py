"""Control tables, filters, status updates, id selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.inputs import frame, oracle
from checks.registry import query
from ferrytally.operators import control as ctl


def control(spark, sf):
    return frame(spark, sf, "control")


@query("pending_filter", oracle(["control"], """
SELECT * REPLACE (coalesce(status, 'Pending') AS status) FROM control WHERE lower(coalesce(status, 'Pending')) NOT LIKE '%migrated%'"""))
def pending_filter(spark, sf):
    return ctl.pending(control(spark, sf))


@query("testing_filter", oracle(["control"], "SELECT * FROM control WHERE lower(status) LIKE '%testing%'"))
def testing_filter(spark, sf):
    return ctl.testing(control(spark, sf))


@query("valid_config_filter", oracle(["control"], """
SELECT * FROM control WHERE trim(dataset_id) <> '' AND trim(model_name) <> '' AND trim(key_columns) <> ''"""))
def valid_config_filter(spark, sf):
    return ctl.valid(control(spark, sf), ["dataset_id", "model_name", "key_columns"])


@query("unchecked_filter", oracle(["control"], "SELECT * FROM control WHERE lower(coalesce(check_text, '')) <> 'true'"))
def unchecked_filter(spark, sf):
    return ctl.unchecked(control(spark, sf), "check_text")


@query("check_progress", oracle(["control"], """
SELECT count(*) AS total, count(*) FILTER (lower(coalesce(check_text, '')) = 'true') AS done,
  count(*) FILTER (lower(coalesce(check_text, '')) <> 'true') AS pending FROM control"""))
def check_progress(spark, sf):
    return ctl.check_progress(control(spark, sf), "check_text")


@query("flag_filter", oracle(["control"], """
SELECT row_id, dataset_id, model_name FROM control WHERE lower(required) IN ('true', '1', 'yes', 'y')"""))
def flag_filter(spark, sf):
    rows = control(spark, sf)
    return ctl.flagged(rows, ctl.find_header(rows, ctl.REQUIRED_FLAG)).select("row_id", "dataset_id", "model_name")


def _keys(c):
    return f"list_filter(list_transform(string_split(coalesce({c}, ''), ','), lambda x: trim(x)), lambda x: x <> '')"


@query("standardize_control", oracle(["control"], f"""
SELECT row_id, dataset_id,
  CASE WHEN lower(trim(model_name)) LIKE '%.sql' THEN left(trim(model_name), length(trim(model_name)) - 4) ELSE model_name END AS table_name,
  array_to_string({_keys('key_columns')}, '|') AS key_columns, TRY_CAST(trim(sample_size) AS BIGINT) AS sample_size,
  coalesce(lower(transform) IN ('true', '1', 'yes', 'y', 'enabled'), false) AS transform,
  coalesce(status, 'Pending') AS status, notes, CAST(NULL AS VARCHAR) AS schema FROM control"""))
def standardize_control(spark, sf):
    typed = ctl.standardize(control(spark, sf), ctl.COMPARISON, keep=["row_id"])
    return typed.withColumn("key_columns", F.array_join("key_columns", "|"))


@query("unique_ids", oracle(["control"], "SELECT DISTINCT trim(dataset_id) AS dataset_id FROM control WHERE trim(dataset_id) <> ''"))
def unique_ids(spark, sf):
    return ctl.unique_ids(control(spark, sf), "dataset_id")


@query("exclude_ids", oracle(["ids", "excluded"], """
SELECT * FROM ids WHERE dataset_id NOT IN (SELECT trim(dataset_id) FROM excluded)"""))
def exclude_ids(spark, sf):
    listed = frame(spark, sf, "excluded").withColumnRenamed("dataset_id", "Dataset_ID ")
    return ctl.exclude_ids(frame(spark, sf, "ids"), listed, "dataset_id")


@query("skip_existing", oracle(["ids", "existing"], "SELECT * FROM ids WHERE dataset_id NOT IN (SELECT dataset_id FROM existing)"))
def skip_existing(spark, sf):
    return ctl.skip_existing(frame(spark, sf, "ids"), frame(spark, sf, "existing"), "dataset_id")


@query("select_ids", oracle(["ids", "excluded", "existing"], """
SELECT * FROM (SELECT * FROM ids WHERE dataset_id NOT IN (SELECT trim(dataset_id) FROM excluded) ORDER BY ordinal LIMIT 60)
WHERE dataset_id NOT IN (SELECT dataset_id FROM existing)"""))
def select_ids(spark, sf):
    ids, excluded, existing = (frame(spark, sf, n) for n in ("ids", "excluded", "existing"))
    return ctl.select_ids(ids, excluded, 60, existing, "dataset_id", "ordinal")


@query("first_match_row", oracle(["control"], """
SELECT c.* FROM control c JOIN (SELECT min(row_id) AS row_id FROM control GROUP BY dataset_id) USING (row_id)"""))
def first_match_row(spark, sf):
    return ctl.first_row_per_id(control(spark, sf), "dataset_id", "row_id")


@query("status_update_join", oracle(["control"], """
SELECT c.* REPLACE (CASE WHEN row_id IN (SELECT min(row_id) FROM control WHERE dataset_id IS NOT NULL AND dataset_id IN
  (SELECT 'ds-' || o_custkey FROM orders) GROUP BY dataset_id) THEN 'Migrated' ELSE status END AS status) FROM control c"""))
def status_update_join(spark, sf):
    done = frame(spark, sf, "orders").select(F.concat(F.lit("ds-"), "o_custkey").alias("dataset_id"))
    return ctl.update_status(control(spark, sf), done, "dataset_id", "row_id", "status")


@query("note_append_join", oracle(["control"], """
SELECT c.* REPLACE (CASE WHEN row_id % 2 = 0 THEN concat_ws(chr(10) || chr(10), nullif(trim(notes), ''), 'checked ' || row_id) ELSE notes END AS notes)
FROM control c"""))
def note_append_join(spark, sf):
    rows = control(spark, sf)
    notes = rows.filter("row_id % 2 = 0").select(
        "row_id", F.concat(F.lit("checked "), F.col("row_id").cast("string")).alias("note")
    )
    return ctl.append_notes(rows, notes, "row_id", "notes")


@query("batch_summary", oracle(["results"], """
SELECT count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status <> 'success') AS failed,
  count(error) AS error_count,
  (SELECT string_agg(error, chr(10) ORDER BY ordinal) FROM (SELECT * FROM results WHERE error IS NOT NULL ORDER BY ordinal LIMIT 10))
  || CASE WHEN count(error) > 10 THEN chr(10) || '... and ' || (count(error) - 10) || ' more errors' ELSE '' END AS errors
FROM results"""))
def batch_summary(spark, sf):
    return ctl.batch_summary(frame(spark, sf, "results"), "ordinal")


@query("batch_ids_by_status", oracle(["results"], "SELECT status, dataset_id FROM results"))
def batch_ids_by_status(spark, sf):
    return ctl.ids_by_status(frame(spark, sf, "results"), "dataset_id")


@query("pad_ragged_rows", oracle(["ragged"], """
SELECT p_partkey, coalesce(v[1], '') AS name, coalesce(v[2], '') AS brand, coalesce(v[3], '') AS kind
FROM (SELECT p_partkey, string_split(line, ',') AS v FROM ragged)"""))
def pad_ragged_rows(spark, sf):
    rows = frame(spark, sf, "ragged").withColumn("cells", F.split("line", ","))
    return ctl.pad_ragged(rows, "cells", ["name", "brand", "kind"], keep=["p_partkey"])

"""Control tables: flexible headers, row filters, status and note updates, id selection."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.columns import col
from ferrytally.functions.cells import ENABLED, flag, not_blank
from ferrytally.functions.names import strip
from ferrytally.operators.numbering import first_rows

# Headers under which a control table may name its fields, in order of preference.
MIGRATION_ID = ["Dataset ID", "dataset_id", "DatasetID", "dataset", "Dataset", "ID", "Dataset Id"]
MIGRATION_NAME = ["Model Name", "model_name"]
MIGRATION_STATUS = ["Status", "status", "migration_status", "Migration Status", "state"]
COMPARE_ID = ["Output ID", "output_id", "Dataset ID", "dataset_id", "ID", "id"]
COMPARE_TABLE = ["Model Name", "model_name"]
COMPARE_KEYS = ["Key Columns", "key_columns", "Keys", "keys", "Join Columns", "join_columns"]
COMPARE_SAMPLE = ["Sample Size", "sample_size", "Sample", "sample"]
COMPARE_TRANSFORM = ["Transform Columns", "transform_columns", "Transform", "transform"]
COMPARE_STATUS = ["Status", "status", "comparison_status", "Comparison Status", "state"]
COMPARE_NOTES = ["Notes", "notes", "Note", "note", "Comments", "comments"]
COMPARE_SCHEMA = ["Schema", "schema", "Data Types", "data_types", "Column Types", "column_types"]
INVENTORY_ID = ["Output ID", "output_id", "Dataset ID", "dataset_id"]
INVENTORY_TABLE = ["Model Name", "model_name", "Table Name", "table_name"]
INVENTORY_KEYS = ["Key Columns", "key_columns", "Keys", "keys"]
REQUIRED_FLAG = ["Required", "required", "REQUIRED", "is_required", "Is Required"]
DATAFLOW_ID = ["Dataflow ID", "dataflow", "Dataflow", "DataFlow", "dataflow_id", "Dataflow_ID"]


@dataclass(frozen=True)
class Field:
    """A field of a standardised control table."""

    name: str
    aliases: list[str]
    kind: str = "text"
    required: bool = False
    default: str | None = None
    fill: str | None = field(default=None)


MIGRATION = [
    Field("dataset_id", MIGRATION_ID),
    Field("name", MIGRATION_NAME, default="Unknown"),
    Field("status", MIGRATION_STATUS, default="Pending", fill="Pending"),
]
COMPARISON = [
    Field("dataset_id", COMPARE_ID, required=True),
    Field("table_name", COMPARE_TABLE, "table", required=True),
    Field("key_columns", COMPARE_KEYS, "list", required=True),
    Field("sample_size", COMPARE_SAMPLE, "size"),
    Field("transform", COMPARE_TRANSFORM, "flag"),
    Field("status", COMPARE_STATUS, fill="Pending"),
    Field("notes", COMPARE_NOTES),
    Field("schema", COMPARE_SCHEMA),
]
INVENTORY = [
    Field("dataset_id", INVENTORY_ID, required=True),
    Field("table_name", INVENTORY_TABLE, "table", required=True),
    Field("key_columns", INVENTORY_KEYS, "list", required=True),
]


def find_header(df: DataFrame, aliases: list[str]) -> str | None:
    """First alias the table has; exact spelling, as in the control sheet."""
    return next((a for a in aliases if a in df.columns), None)


def without_sql_suffix(c: Column) -> Column:
    """Table name without a trailing ``.sql``."""
    text = strip(c.cast("string"))
    return F.when(F.lower(text).endswith(".sql"), F.left(text, F.length(text) - 4)).otherwise(c.cast("string"))


def split_keys(c: Column) -> Column:
    """Comma-separated key list as an array, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(F.coalesce(c.cast("string"), F.lit("")), ","), strip), lambda x: x != "")


def sample_size_value(c: Column) -> Column:
    text = strip(c.cast("string"))
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("bigint"))


_KINDS = {
    "text": lambda c: c.cast("string"),
    "table": without_sql_suffix,
    "list": split_keys,
    "size": sample_size_value,
    "flag": lambda c: flag(c, ENABLED),
}


def standardize(control: DataFrame, fields: list[Field], keep: list[str] | None = None) -> DataFrame:
    """Typed control table from one with flexible headers.

    The first alias present names a field; a missing optional field gets its default, a
    missing required one is an error. ``keep`` passes columns through unchanged.
    """
    out = [col(c) for c in keep or []]
    for f in fields:
        header = find_header(control, f.aliases)
        if header is None and f.required:
            raise ValueError(f"required column {f.aliases[0]!r} not found")
        value = F.lit(f.default).cast("string") if header is None else col(header)
        if f.fill is not None and header is not None:
            value = F.coalesce(value.cast("string"), F.lit(f.fill))
        out.append(_KINDS[f.kind](value).alias(f.name))
    return control.select(*out)


def pending(control: DataFrame, status: str = "status") -> DataFrame:
    """Rows not migrated yet; a missing status is ``Pending``."""
    filled = control.withColumn(status, F.coalesce(col(status).cast("string"), F.lit("Pending")))
    return filled.filter(~F.lower(col(status)).contains("migrated"))


def testing(control: DataFrame, status: str = "status") -> DataFrame:
    """Rows under test; all rows when the table has no status."""
    if status not in control.columns:
        return control
    return control.filter(F.lower(F.coalesce(col(status).cast("string"), F.lit("Pending"))).contains("testing"))


def valid(control: DataFrame, required: list[str]) -> DataFrame:
    """Rows whose required fields are all non-NULL and non-blank."""
    for name in required:
        control = control.filter(not_blank(col(name)))
    return control


def unchecked(control: DataFrame, check: str = "Check") -> DataFrame:
    """Rows not marked done; a missing mark counts as not done."""
    return control.filter(F.lower(F.coalesce(col(check).cast("string"), F.lit(""))) != "true")


def check_progress(control: DataFrame, check: str = "Check") -> DataFrame:
    done = F.lower(F.coalesce(col(check).cast("string"), F.lit(""))) == "true"
    return control.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(done).alias("done"), F.count_if(~done).alias("pending")
    )


def flagged(df: DataFrame, name: str) -> DataFrame:
    """Rows whose flag text is true."""
    return df.filter(flag(col(name)))


def unique_ids(df: DataFrame, name: str) -> DataFrame:
    """Distinct trimmed non-blank ids of a column, as text."""
    text = strip(col(name).cast("string"))
    return df.select(text.alias(name)).filter(F.col(name) != "").distinct()


def exclude_ids(ids: DataFrame, excluded: DataFrame, name: str) -> DataFrame:
    """Drop ids listed in ``excluded``, whose id header may be spelled in any case.

    Without such a header nothing is excluded.
    """
    header = next((c for c in excluded.columns if c.strip().lower() == name.strip().lower()), None)
    if header is None:
        return ids
    listed = unique_ids(excluded, header).select(col(header).alias("__excluded"))
    return ids.join(listed, strip(col(name).cast("string")) == F.col("__excluded"), "left_anti")


def skip_existing(ids: DataFrame, existing: DataFrame, name: str) -> DataFrame:
    """Drop ids already present in the output."""
    present = existing.select(strip(col(name).cast("string")).alias("__existing")).na.drop().distinct()
    return ids.join(present, col(name).cast("string") == F.col("__existing"), "left_anti")


def select_ids(
    ids: DataFrame, excluded: DataFrame, max_n: int | None, existing: DataFrame, name: str, ordinal: str
) -> DataFrame:
    """Exclude, then keep the first ``max_n``, then drop existing ids -- in this order."""
    chosen = exclude_ids(ids, excluded, name)
    if max_n is not None:
        chosen = first_rows(chosen, [col(ordinal)], max_n)
    return skip_existing(chosen, existing, name)


def first_row_per_id(control: DataFrame, id_column: str, ordinal: str) -> DataFrame:
    """First row of each id (ids compared as text)."""
    firsts = control.groupBy(col(id_column).cast("string").alias("__id")).agg(F.min(col(ordinal)).alias("__first"))
    return control.join(firsts.select("__first"), col(ordinal) == F.col("__first"), "left_semi")


def update_status(
    control: DataFrame, done: DataFrame, id_column: str, ordinal: str, status_column: str, status: str = "Migrated"
) -> DataFrame:
    """Set the status on the first row of each id in ``done``.

    The rows to change are found by an aggregate over the listed ids and joined back on the
    unique ordinal, so an id on many rows causes no skew.
    """
    ids = done.select(col(id_column).cast("string").alias("__done")).na.drop().distinct()
    listed = control.select(col(id_column).cast("string").alias("__id"), col(ordinal).alias("__ordinal"))
    firsts = (
        listed.groupBy("__id").agg(F.min("__ordinal").alias("__first"))
        .join(ids, F.col("__id") == F.col("__done"), "left_semi")
    )
    joined = control.join(firsts.select("__first"), col(ordinal) == F.col("__first"), "left")
    changed = F.when(F.col("__first").isNotNull(), F.lit(status)).otherwise(col(status_column))
    return joined.withColumn(status_column, changed).drop("__first")


def append_notes(control: DataFrame, notes: DataFrame, ordinal: str, notes_column: str) -> DataFrame:
    """Append ``notes(ordinal, note)`` to the existing notes after a blank line."""
    new = notes.select(col(ordinal).alias("__ordinal"), F.col("note").alias("__note"))
    joined = control.join(new, col(ordinal) == F.col("__ordinal"), "left")
    old = strip(col(notes_column).cast("string"))
    merged = F.concat_ws("\n\n", F.nullif(old, F.lit("")), F.col("__note"))
    updated = F.when(F.col("__note").isNotNull(), merged).otherwise(col(notes_column))
    return joined.withColumn(notes_column, updated).drop("__ordinal", "__note")


ERROR_LISTING = 10


def batch_summary(results: DataFrame, ordinal: str) -> DataFrame:
    """Totals of ``results(status, error)`` and its first ten errors as text."""
    totals = results.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("status") == "success").alias("success"),
        F.count_if(F.col("status") != "success").alias("failed"), F.count("error").alias("error_count"),
    )
    first = first_rows(
        results.filter(F.col("error").isNotNull()).select(col(ordinal).alias("o"), "error"), [F.col("o")], ERROR_LISTING
    )
    listing = first.agg(F.array_sort(F.collect_list(F.struct("o", "error"))).alias("errors"))
    both = totals.unionByName(listing, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in totals.columns], F.max_by("errors", F.size("errors")).alias("errors")
    )
    more = F.when(
        F.col("error_count") > ERROR_LISTING,
        F.format_string("... and %d more errors", F.col("error_count") - ERROR_LISTING),
    )
    return both.select(*totals.columns, F.concat_ws("\n", F.col("errors.error"), more).alias("errors"))


def ids_by_status(results: DataFrame, id_column: str) -> DataFrame:
    """Ids with their outcome, one row each, so that no list has to fit one cell."""
    return results.select("status", col(id_column))


def pad_ragged(df: DataFrame, values: str, headers: list[str], keep: list[str] | None = None) -> DataFrame:
    """Array rows as a table: short rows padded with empty text, long ones cut to the header."""
    out = [F.coalesce(F.try_element_at(col(values), F.lit(i)), F.lit("")).alias(h) for i, h in enumerate(headers, 1)]
    return df.select(*[col(k) for k in keep or []], *out)

"""Many comparisons from a control table."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ferrytally.operators.control import COMPARISON, INVENTORY, append_notes, find_header, standardize, testing, valid
from ferrytally.plans.report import compare_tables, executive_summary, summary_text

Resolve = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Comparison:
    ordinal: int
    dataset_id: str
    table_name: str
    status: str
    overall_match: bool | None
    note: str
    error: str | None = None


COMPARISON_SCHEMA = (
    "ordinal bigint, dataset_id string, table_name string, status string, overall_match boolean, "
    "note string, error string"
)


@dataclass(frozen=True)
class CompareRun:
    """One outcome per comparison and, where it has notes, the control table with them appended."""

    outcomes: DataFrame
    control: DataFrame


def _compare(row: Row, ordinal: str, left_of: Resolve, right_of: Resolve, options: dict) -> Comparison:
    where = (row[ordinal], row["dataset_id"], row["table_name"])
    try:
        report = compare_tables(
            left_of(row["dataset_id"]), right_of(row["table_name"]), row["key_columns"], **options
        ).settled()
        verdict = report.summary.first()
        title = f"{verdict['status']}: {row['dataset_id']} -> {row['table_name']}"
        if report.errors:
            raise ValueError("; ".join(text for _, text in report.errors))
        note = summary_text(executive_summary(report, title)).first()["summary"]
        return Comparison(*where, "success", verdict["overall_match"], note)
    except Exception as e:  # one failure must not stop the others
        error = str(e).split("\n")[0]
        note = f"COMPARISON FAILED\nDataset: {row['dataset_id']} -> {row['table_name']}\n  {error}"
        return Comparison(*where, "failed", None, note, f"Dataset {row['dataset_id']}: {error}")


def _run(control, chosen, ordinal, left_of, right_of, options_of, concurrent) -> CompareRun:
    spark = control.sparkSession
    with ThreadPoolExecutor(concurrent) as pool:
        rows = chosen.orderBy(ordinal).toLocalIterator()
        done = list(pool.map(lambda r: _compare(r, ordinal, left_of, right_of, options_of(r)), rows))
    outcomes = spark.createDataFrame([astuple(c) for c in done], COMPARISON_SCHEMA)
    notes_header = find_header(control, COMPARISON[6].aliases)
    if notes_header is None:
        return CompareRun(outcomes, control)
    notes = outcomes.select(F.col("ordinal").alias(ordinal), "note")
    return CompareRun(outcomes, append_notes(control, notes, ordinal, notes_header))


def compare_many(
    control: DataFrame, left_of: Resolve, right_of: Resolve, ordinal: str, method: str = "random",
    use_schema: bool = False, sampled: bool = False, concurrent: int = 4,
) -> CompareRun:
    """Run the comparisons a control table marks as ``testing``.

    Incomplete rows are skipped; a failing comparison becomes a failed outcome. Whole tables are
    compared unless ``sampled``, which uses each row's sample size (computed when blank).
    """
    typed = standardize(control, COMPARISON, keep=[ordinal])
    if find_header(control, COMPARISON[5].aliases) is None:
        typed = typed.drop("status")
    ready = valid(testing(typed), ["dataset_id", "table_name"]).filter(F.size("key_columns") > 0)

    def options(row: Row) -> dict:
        out = {"transform": row["transform"], "method": method}
        if sampled:
            out["sample"] = row["sample_size"] or "auto"
        if use_schema and row["schema"] and row["schema"].strip():
            out["schema"] = row["schema"]
        return out

    return _run(control, ready, ordinal, left_of, right_of, options, concurrent)


def compare_inventory(
    control: DataFrame, left_of: Resolve, right_of: Resolve, ordinal: str, method: str = "random",
    sampled: bool = False, concurrent: int = 4,
) -> CompareRun:
    """Run the comparisons of an inventory: names as they are, sample size computed."""
    typed = standardize(control, INVENTORY, keep=[ordinal])
    ready = valid(typed, ["dataset_id", "table_name"]).filter(F.size("key_columns") > 0)
    options = {"method": method, **({"sample": "auto"} if sampled else {})}
    return _run(control, ready, ordinal, left_of, right_of, lambda row: options, concurrent)

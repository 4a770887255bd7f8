"""Migrations: extract, clean, load, verify -- one table or many from a control table.

A checksum of the rows is observed while they are written, so a source is read once. The verification
takes that of the target: a load that loses, repeats or changes a value has failed, whatever its number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.functions.names import identifier, rename_columns, table_name, warehouse_name
from ferrytally.operators.checksum import Checksum, checksum
from ferrytally.operators.cleaning import drop_empty_rows, trim_headers
from ferrytally.operators.control import MIGRATION, find_header, pending, standardize, update_status
from ferrytally.sources.readers import list_stage, read_dataset
from ferrytally.sources.sinks import load_stage, read_stage, verify_content, write_stage, write_table

Resolve = Callable[[str], DataFrame]
TargetOf = Callable[[str], str]


@dataclass(frozen=True)
class Outcome:
    """What became of one dataset."""

    ordinal: int
    dataset_id: str | None
    target_table: str | None
    status: str
    error: str | None = None
    expected: int | None = None
    actual: int | None = None
    row_limit: int | None = None  # of the extract; none: the whole table


OUTCOME_SCHEMA = (
    "ordinal bigint, dataset_id string, target_table string, status string, error string, "
    "expected bigint, actual bigint, row_limit bigint"
)


def outcomes_frame(spark: SparkSession, outcomes: Iterable[Outcome]) -> DataFrame:
    return spark.createDataFrame([astuple(o) for o in outcomes], OUTCOME_SCHEMA)


def _extract(source: DataFrame, limit: int | None, order: list[str] | None) -> DataFrame:
    extracted = trim_headers(drop_empty_rows(read_dataset(source, limit=limit, order=order)))
    if extracted.isEmpty():
        raise ValueError("no data extracted")
    return extracted


def migrate(
    source: DataFrame, target: str, limit: int | None = None, order: list[str] | None = None,
    if_exists: str = "replace",
) -> DataFrame:
    """Extract, clean, load and verify one dataset: the whole table, or its first ``limit`` rows.

    An empty extract is an error and leaves the target alone. Returns ``(expected, actual, ok)``.
    """
    named = rename_columns(_extract(source, limit, order), warehouse_name)
    return verify_content(source.sparkSession, target, write_table(named, target, if_exists, checked=True))


def _attempt(
    ordinal: int, dataset_id: str, target: str, work: Callable[[], DataFrame], limit: int | None = None
) -> Outcome:
    try:
        check = work().first()
    except Exception as e:  # one failure must not stop the others
        return Outcome(ordinal, dataset_id, target, "error", str(e).split("\n")[0], row_limit=limit)
    status = "success" if check["ok"] else "failed"
    error = None if check["ok"] else f"Dataset {dataset_id}: Migration failed"
    return Outcome(ordinal, dataset_id, target, status, error, check["expected"], check["actual"], limit)


class _Targets:
    """The targets given out so far: two datasets must not overwrite each other."""

    def __init__(self):
        self.seen: dict[str, int] = {}

    def taken(self, target: str, ordinal: int) -> str | None:
        first = self.seen.setdefault(target.lower(), ordinal)
        return None if first == ordinal else f"Target {target} is that of row {first} already"


def _run(jobs: list[Callable[[], Outcome]], concurrent: int) -> list[Outcome]:
    """Run per-dataset Spark jobs, a few at a time so that small tables share the cluster."""
    with ThreadPoolExecutor(concurrent) as pool:
        return list(pool.map(lambda job: job(), jobs))


def migrate_many(
    spark: SparkSession, mapping: dict[str, str], resolve: Resolve, target_of: TargetOf = str,
    limit: int | None = None, order: list[str] | None = None, concurrent: int = 4,
) -> DataFrame:
    """Migrate ``{dataset_id: target_table}``; one outcome row per dataset. A repeated target is an error."""
    targets = _Targets()

    def job(ordinal: int, dataset_id: str, target: str) -> Callable[[], Outcome]:
        taken = targets.taken(target, ordinal)
        if taken:
            return lambda: Outcome(ordinal, dataset_id, target, "error", taken, row_limit=limit)
        return lambda: _attempt(
            ordinal, dataset_id, target, lambda: migrate(resolve(dataset_id), target_of(target), limit, order), limit
        )

    jobs = [job(i, d, t) for i, (d, t) in enumerate(mapping.items(), 1)]
    return outcomes_frame(spark, _run(jobs, concurrent))


@dataclass(frozen=True)
class ControlRun:
    """Outcome rows and the control table with its status updated."""

    outcomes: DataFrame
    control: DataFrame


def pending_rows(control: DataFrame, ordinal: str) -> DataFrame:
    """Pending rows of a control table with the table name each will get."""
    typed = pending(standardize(control, MIGRATION, keep=[ordinal]))
    return typed.withColumn("target_table", table_name(F.col("dataset_id"), F.col("name")))


def _control_run(
    control: DataFrame, ordinal: str, work: Callable[[str, str], DataFrame], concurrent: int, limit: int | None = None
) -> ControlRun:
    spark = control.sparkSession
    jobs, targets = [], _Targets()
    # One entry per dataset to migrate, streamed from the control table in order.
    for row in pending_rows(control, ordinal).orderBy(ordinal).toLocalIterator():
        position, dataset_id, target = row[ordinal], row["dataset_id"], row["target_table"]
        if dataset_id is None or not dataset_id.strip():
            blank = Outcome(position, dataset_id, None, "error", f"Row {position}: Empty or invalid Dataset ID", row_limit=limit)
            jobs.append(lambda blank=blank: blank)
        elif taken := targets.taken(target, position):
            repeat = Outcome(position, dataset_id, target, "error", f"Row {position}: {taken}", row_limit=limit)
            jobs.append(lambda repeat=repeat: repeat)
        else:
            jobs.append(
                lambda p=position, d=dataset_id, t=target: _attempt(p, d, t, lambda: work(d, t), limit)
            )
    outcomes = outcomes_frame(spark, _run(jobs, concurrent))
    id_header = find_header(control, MIGRATION[0].aliases)
    status_header = find_header(control, MIGRATION[2].aliases)
    if id_header is None or status_header is None:
        return ControlRun(outcomes, control)
    done = outcomes.filter(F.col("status") == "success").select(F.col("dataset_id").alias(id_header))
    return ControlRun(outcomes, update_status(control, done, id_header, ordinal, status_header))


def migrate_control(
    control: DataFrame, resolve: Resolve, target_of: TargetOf, ordinal: str, limit: int | None = None,
    order: list[str] | None = None, concurrent: int = 4,
) -> ControlRun:
    """Migrate the pending rows of a control table, whole tables by default, and mark the migrated ones.

    Rows without an id, and rows whose target another row has already, become error outcomes.
    """
    return _control_run(
        control, ordinal, lambda d, t: migrate(resolve(d), target_of(t), limit, order), concurrent, limit
    )


def to_stage(
    source: DataFrame, stage: str, name: str, limit: int | None = None, order: list[str] | None = None
) -> DataFrame:
    """Extract to gzip CSV files of a stage; fails when none was written. Returns the listing."""
    folder, _ = _staged(source, stage, name, limit, order)
    return list_stage(source.sparkSession, folder)


def _staged(
    source: DataFrame, stage: str, name: str, limit: int | None = None, order: list[str] | None = None
) -> tuple[str, Checksum]:
    """The folder of the staged files and the checksum of the rows written to them."""
    written = Observation()
    folder = write_stage(_extract(source, limit, order), stage, name, written=written)
    if list_stage(source.sparkSession, folder).isEmpty():
        raise ValueError(f"no file staged in {folder}")
    return folder, Checksum.of(written.get)


def staged_schema(source: DataFrame) -> T.StructType:
    """Schema of a dataset's staged files: normalised names, the dataset's own types."""
    return rename_columns(trim_headers(source), warehouse_name).schema


def via_stage(
    source: DataFrame, stage: str, name: str, target: str, if_exists: str = "replace",
    limit: int | None = None, order: list[str] | None = None,
) -> DataFrame:
    """Stage a dataset, load the target from the staged files, and verify.

    One row ``(expected, actual, rejected, ok)``: rows staged, rows that the load put into the target, and
    staged records that do not fit the schema. It is right if the rows that were loaded are those that were staged, value by value,
    and the target holds them beside what it held before. The files are parsed once.
    """
    spark = source.sparkSession
    folder, expected = _staged(source, stage, name, limit, order)
    load = load_stage(spark, folder, target, staged_schema(source), if_exists=if_exists)
    before = load.total.rows - load.added.rows
    return verify_content(spark, target, load.total).select(
        F.lit(expected.rows).cast("bigint").alias("expected"), (F.col("actual") - before).alias("actual"),
        F.lit(load.rejected).cast("bigint").alias("rejected"), (F.col("ok") & F.lit(load.added == expected)).alias("ok"),
    )


def control_to_stage(
    control: DataFrame, resolve: Resolve, stage: str, ordinal: str, limit: int | None = None, concurrent: int = 4
) -> ControlRun:
    """Stage the pending rows of a control table, one folder of files per dataset.

    What was written is compared, value by value, with what the files hold when read back.
    """
    spark = control.sparkSession

    def work(dataset_id: str, target: str) -> DataFrame:
        name = spark.range(1).select(identifier(F.lit(target))).first()[0]
        source = resolve(dataset_id)
        folder, expected = _staged(source, stage, name, limit)
        found = checksum(read_stage(spark, folder, staged_schema(source)))
        return spark.createDataFrame([(expected.rows, found.rows, found == expected)], "expected bigint, actual bigint, ok boolean")

    return _control_run(control, ordinal, work, concurrent, limit)

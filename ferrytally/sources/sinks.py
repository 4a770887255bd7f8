"""Sinks: typed tables, staged CSV files, loads from a stage, verification."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols
from ferrytally.functions.names import rename_columns, warehouse_name
from ferrytally.operators.checksum import Checksum, checksum, checksum_columns
from ferrytally.operators.cleaning import blank_to_null
from ferrytally.session import materialise
from ferrytally.sources.readers import CORRUPT, is_path, read_ref
from ferrytally.sources.replace import recover, replace_table

# A gzip file is read by one task, so staged files are kept to this many rows.
STAGE_FILE_ROWS = 1_000_000
SAVE_MODES = {"append": "append", "fail": "errorifexists"}


def write_table(
    df: DataFrame, ref: str, if_exists: str = "replace", file_rows: int = 0, checked: bool = False,
    accept: Callable[[], None] | None = None,
) -> Checksum | None:
    """Write a typed table; an existing one is replaced, appended to, or an error.

    A table is replaced by a new version written beside it, so that a write that fails leaves it as it was; ``accept``
    is called before the versions change places and may raise to keep the old one.

    Appended rows take the types of the table. If a value does not fit, the column becomes text, as
    the whole table would be unreadable otherwise; the table is then written anew.

    With ``checked``, returns the checksum that the table must have now. It is taken from the rows while they are written.
    """
    spark, before, written = df.sparkSession, Checksum(), Observation()
    recover(spark, ref)
    if if_exists == "append" and exists(spark, ref):
        there = read_ref(spark, ref)
        df, misfits = fitted(df, there)
        if misfits:
            df = as_text(there, misfits).unionByName(as_text(df, misfits), allowMissingColumns=True)
            if_exists = "replace"
        elif checked:
            before = checksum(there)
    if checked:
        df = df.observe(written, *checksum_columns(df))
    if if_exists == "replace":
        replace_table(df, ref, file_rows, accept)
    else:
        writer = df.write.mode(SAVE_MODES[if_exists]).option("maxRecordsPerFile", file_rows)
        writer.parquet(ref) if is_path(ref) else writer.saveAsTable(ref)
    return before + Checksum.of(written.get) if checked else None


def exists(spark: SparkSession, ref: str) -> bool:
    if not is_path(ref):
        return spark.catalog.tableExists(ref)
    recover(spark, ref)
    try:
        return len(spark.read.parquet(ref).columns) > 0
    except AnalysisException:
        return False


def as_text(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: col(n).cast("string") for n in names if n in df.columns})


def fitted(df: DataFrame, there: DataFrame) -> tuple[DataFrame, list[str]]:
    """The rows with a table's types, and the columns that have values which do not fit theirs."""
    types = {f.name: f.dataType for f in there.schema}
    differing = [f.name for f in df.schema if f.name in types and types[f.name] != f.dataType]
    if not differing:
        return df, []
    cast = {n: col(n).try_cast(types[n]) for n in differing}
    lost = [F.count_if(col(n).isNotNull() & ~cast[n].try_cast(df.schema[n].dataType).eqNullSafe(col(n))) for n in differing]
    row = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(lost)]).first()
    misfits = [n for i, n in enumerate(differing) if row[f"n{i}"]]
    return df.withColumns({n: c for n, c in cast.items() if n not in misfits}), misfits


def verify_count(spark: SparkSession, ref: str, expected: int) -> DataFrame:
    """``(expected, actual, ok)`` of a loaded table."""
    actual = F.count(F.lit(1))
    return read_ref(spark, ref).agg(
        F.lit(expected).cast("bigint").alias("expected"), actual.alias("actual"), (actual == expected).alias("ok")
    )


def verify_content(spark: SparkSession, ref: str, expected: Checksum) -> DataFrame:
    """``(expected, actual, ok)`` of a loaded table: it is right if it holds the very rows, in any order."""
    table = read_ref(spark, ref)
    rows, first, second = (c for c in checksum_columns(table))
    found = table.agg(rows, first, second)
    same = (F.col("rows") == expected.rows) & (F.col("first") == F.lit(Decimal(expected.first))) & (F.col("second") == F.lit(Decimal(expected.second)))
    return found.select(F.lit(expected.rows).cast("bigint").alias("expected"), F.col("rows").alias("actual"), same.alias("ok"))


def save_csv(df: DataFrame, path: str, compression: str = "none", file_rows: int = 0) -> None:
    """CSV with a header; NULL is an empty field, quotes are doubled."""
    (
        df.write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", '""')
        .option("quote", '"').option("escape", '"').option("compression", compression)
        .option("maxRecordsPerFile", file_rows).option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )


def write_stage(
    df: DataFrame, directory: str, name: str, file_rows: int = STAGE_FILE_ROWS, written: Observation | None = None
) -> str:
    """Stage a table as gzip CSV: normalised names, blanks as NULL. Returns its folder.

    ``written`` observes the checksum of the staged rows.
    """
    staged = blank_to_null(rename_columns(df, warehouse_name))
    if written is not None:
        staged = staged.observe(written, *checksum_columns(staged))
    target = f"{directory.rstrip('/')}/{name}"
    save_csv(staged, target, "gzip", file_rows)
    return target


def stage_options(quoted: bool) -> dict[str, object]:
    """Reader options of staged CSV. Gzip files are read whole, so multi-line values cost nothing."""
    return {
        "header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "recursiveFileLookup": True,
        "columnPruning": False, "quote": '"' if quoted else "", "escape": '"', "multiLine": quoted,
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    }


def with_record(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def all_parsed(schema: T.StructType) -> Column:
    """A condition that always holds but reads every column.

    Spark converts only the columns a query uses, so a row's bad field would go unnoticed when its
    column is not selected. With this, whether a row fits does not depend on the selection.
    """
    return F.pmod(F.hash(*cols(schema.fieldNames())), F.lit(2)) < 2


def _stage_rows(spark: SparkSession, directory: str, schema: T.StructType, pattern: str, quoted: bool) -> DataFrame:
    reader = spark.read.schema(with_record(schema)).options(**stage_options(quoted)).option("pathGlobFilter", pattern)
    return reader.csv(directory).filter(all_parsed(schema))


def read_stage(
    spark: SparkSession, directory: str, schema: T.StructType, pattern: str = "*.csv*", quoted: bool = True
) -> DataFrame:
    """Rows of staged files that fit the schema."""
    return _stage_rows(spark, directory, schema, pattern, quoted).filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def load_rejects(
    spark: SparkSession, directory: str, schema: T.StructType, pattern: str = "*.csv*", quoted: bool = True
) -> DataFrame:
    """Staged records that do not fit the schema, as read, with the file they came from."""
    rows = _stage_rows(spark, directory, schema, pattern, quoted)
    file_name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1)
    return rows.withColumn("file_name", file_name).filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("record"), "file_name"
    )


@dataclass(frozen=True)
class Load:
    """What a load did: records that did not fit, the rows it added, and what the table must hold now."""

    rejected: int
    added: Checksum
    total: Checksum


def load_stage(
    spark: SparkSession, directory: str, target: str, schema: T.StructType | None = None, pattern: str = "*.csv*",
    if_exists: str = "replace", on_error: str = "continue", quoted: bool = True,
) -> Load:
    """Load staged files into a table.

    Without a schema every column is text, named by the files' header. ``on_error="continue"``
    skips rows that do not fit; ``"abort"`` fails when there are any. The files are parsed once: records that do not fit are counted as
    the others are written, and a load that is aborted is not committed.
    """
    if schema is None:
        sample = spark.read.option("header", True).option("pathGlobFilter", pattern).option(
            "recursiveFileLookup", True
        ).csv(directory)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in sample.columns])
    parsed = Observation()
    rows = _stage_rows(spark, directory, schema, pattern, quoted).observe(
        parsed, F.count_if(F.col(CORRUPT).isNotNull()).alias("rejected")
    )
    added = Observation()
    rows = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    rows = rows.observe(added, *checksum_columns(rows))

    def all_fit() -> None:
        if parsed.get["rejected"]:
            raise ValueError(f"records in {directory} do not fit the schema")

    accept = all_fit if on_error == "abort" else None
    there = exists(spark, target)
    if accept is not None and not there:
        if_exists = "replace"
    if accept is not None and if_exists == "append":
        # Appended files cannot be withheld, so they wait elsewhere.
        rows = materialise(rows)
        all_fit()
    total = write_table(rows, target, if_exists, checked=True, accept=accept)
    return Load(parsed.get["rejected"], Checksum.of(added.get), total)


def write_report(frames: dict[str, DataFrame], directory: str) -> None:
    """Persist report tables, one folder each."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{directory.rstrip('/')}/{name}")


def write_text(lines: DataFrame, path: str) -> None:
    """Write ``lines(ordinal, text)`` of a summary as one text file (a few dozen lines)."""
    lines.orderBy("ordinal").select(col("text")).coalesce(1).write.mode("overwrite").text(path)

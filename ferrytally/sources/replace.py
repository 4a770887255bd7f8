"""Replacing a table as a whole: the new version is written beside the old one, and takes its place by renames.

A write that fails leaves the old table as it was. A process that dies between the two renames leaves the old version under
another name, and the next reader or writer of the table puts things right (``recover``): the new version is completed if it had
been written to the end, otherwise the old one comes back.

Renames of folders are atomic on HDFS and local disks. Object stores copy instead, and need a table format of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

NEXT, PREVIOUS = "next", "previous"


class _Folder:
    """The versions of a table in a folder; the other two are hidden siblings."""

    def __init__(self, spark: SparkSession, path: str):
        hadoop = spark._jvm.org.apache.hadoop.fs
        current = hadoop.Path(path.rstrip("/"))
        self.files = current.getFileSystem(spark._jsc.hadoopConfiguration())
        self.paths = {"": current, **{v: hadoop.Path(current.getParent(), f".{current.getName()}.{v}") for v in (NEXT, PREVIOUS)}}
        self.done = hadoop.Path(self.paths[NEXT], "_SUCCESS")

    def has(self, version: str) -> bool:
        return self.files.exists(self.paths[version])

    def complete(self) -> bool:
        return self.files.exists(self.done)

    def write(self, df: DataFrame, file_rows: int) -> None:
        df.write.option("maxRecordsPerFile", file_rows).parquet(self.paths[NEXT].toString())

    def drop(self, version: str) -> None:
        self.files.delete(self.paths[version], True)

    def move(self, old: str, new: str) -> None:
        if not self.files.rename(self.paths[old], self.paths[new]):
            raise OSError(f"{self.paths[old].toString()} could not be renamed to {self.paths[new].toString()}")


class _Table:
    """The versions of a catalog table."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name

    def _named(self, version: str) -> str:
        return f"{self.name}__{version}" if version else self.name

    def has(self, version: str) -> bool:
        return self.spark.catalog.tableExists(self._named(version))

    def complete(self) -> bool:
        # A table is in the catalog once it has been written.
        return self.has(NEXT)

    def write(self, df: DataFrame, file_rows: int) -> None:
        df.write.option("maxRecordsPerFile", file_rows).saveAsTable(self._named(NEXT))

    def drop(self, version: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._named(version)}")

    def move(self, old: str, new: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._named(old)} RENAME TO {self._named(new)}")


def _versions(spark: SparkSession, ref: str) -> _Folder | _Table:
    return _Folder(spark, ref) if "/" in ref else _Table(spark, ref)


def recover(spark: SparkSession, ref: str) -> None:
    """Undo or finish a replacement that was cut off between its renames."""
    _settle(_versions(spark, ref))


def _settle(table: _Folder | _Table) -> None:
    if not table.has(PREVIOUS):
        return
    if not table.has(""):
        table.move(NEXT if table.complete() else PREVIOUS, "")
    if table.has(PREVIOUS):
        table.drop(PREVIOUS)


def replace_table(df: DataFrame, ref: str, file_rows: int = 0, accept: Callable[[], None] | None = None) -> None:
    """Write ``df`` in place of the table, which it may read itself. ``accept`` may raise to keep the old one."""
    spark = df.sparkSession
    table = _versions(spark, ref)
    _settle(table)
    if table.has(NEXT):  # of a write that failed
        table.drop(NEXT)
    try:
        table.write(df, file_rows)
        if accept is not None:
            accept()
    except Exception:
        if table.has(NEXT):
            table.drop(NEXT)
        raise
    if table.has(""):
        table.move("", PREVIOUS)
    table.move(NEXT, "")
    if table.has(PREVIOUS):
        table.drop(PREVIOUS)
    if isinstance(table, _Folder):
        spark.catalog.refreshByPath(ref)
    else:
        spark.catalog.refreshTable(ref)

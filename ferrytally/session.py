"""Where intermediate tables go."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_TRIED: set[tuple[str, str]] = set()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` or, without one, a folder of its own in the warehouse.

    A path of the file system may be a mount that all machines have, or a folder of one: rows are written there and
    read back before it is first used. A machine-local folder is used only by a local session that names none (tests).
    """
    sc = spark.sparkContext
    one_machine = re.match(r"local(\[|$)", sc.master) is not None
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current is None and one_machine:
        current = tempfile.mkdtemp(prefix="ferrytally-")
    elif current is None:
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/ferrytally-{uuid.uuid4().hex[:12]}"
    if not one_machine and current.startswith(("file:", "/")):
        _try_out(spark, current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def _try_out(spark: SparkSession, folder: str) -> None:
    """Raise if what tasks write to a folder of the file system is not there for the driver and for other tasks."""
    tried = (spark.sparkContext.applicationId, folder)
    if tried in _TRIED:
        return
    rows = max(2, spark.sparkContext.defaultParallelism)
    path = f"{folder.rstrip('/')}/tried-{uuid.uuid4().hex[:12]}"
    try:
        spark.range(0, rows, 1, rows).write.parquet(path)
        found = spark.read.schema("id bigint").parquet(path).count()
    except Exception as e:
        raise RuntimeError(f"{folder} cannot be used by all executors; set spark.checkpoint.dir to a shared folder") from e
    if found != rows:
        raise RuntimeError(f"{folder} is a folder of one machine; set spark.checkpoint.dir to a shared one")
    _TRIED.add(tried)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


#: Makes Spark drop the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_DROPS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """For queries whose rows are written away: what they shuffled is of no more use."""
    before = spark.conf.get(_DROPS, None)
    spark.conf.set(_DROPS, "true")
    try:
        yield
    finally:
        spark.conf.unset(_DROPS) if before is None else spark.conf.set(_DROPS, before)


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: it cuts the lineage like a checkpoint and takes less room."""
    path = scratch_path(df.sparkSession, "stored")
    with dropping_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# Range partitions at most: their sizes are collected, one number each.
MAX_WIDTH = 20_000


def shuffle_width(df: DataFrame, rows: int, rows_per_partition: int) -> int:
    """Number of range partitions that keeps each near ``rows_per_partition`` rows, within a ceiling."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, min(MAX_WIDTH, -(-rows // rows_per_partition)))

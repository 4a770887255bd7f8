"""Incremental loading of a stage.

A bulk load remembers which staged files it has taken. Structured Streaming's file source does
the same with its checkpoint: each call loads the files that arrived since the last one, once.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.sources.readers import CORRUPT
from ferrytally.sources.sinks import all_parsed, stage_options, with_record


def ingest_stage(
    spark: SparkSession, directory: str, target: str, schema: T.StructType, checkpoint: str,
    pattern: str = "*.csv*", files_per_batch: int = 1000,
) -> None:
    """Append the files staged since the last call to a parquet target.

    ``checkpoint`` is a folder in shared storage that belongs to this target. Rows that do not fit
    the schema are skipped.
    """
    stream = (
        spark.readStream.schema(with_record(schema)).options(**stage_options(quoted=True))
        .option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).csv(directory)
    )
    query = (
        stream.filter(all_parsed(schema) & F.col(CORRUPT).isNull()).drop(CORRUPT)
        .writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(target)
    )
    query.awaitTermination()

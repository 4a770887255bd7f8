"""Helpers of the corpus operators."""

import pyarrow as pa
from pyspark.sql import functions as F

from ferrytally.llm.common import join_counted


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_rows_that_a_function_multiplied_are_not_broadcast(spark, tmp_path):
    """Their size is that of the few rows which went in, as far as Spark knows."""
    def many(batches):
        for batch in batches:
            for i in range(300):
                yield pa.RecordBatch.from_arrays([pa.array([x * 300 + i for x in batch.column("id").to_pylist()], pa.int64())], names=["k"])

    spark.range(200).write.parquet(f"{tmp_path}/few")
    few = spark.read.parquet(f"{tmp_path}/few")
    counted = spark.range(60_000).select(F.col("id").alias("k"), F.lit(1).cast("bigint").alias("times"), F.md5(F.col("id").cast("string")).alias("more"))
    for rows in (few.mapInArrow(many, "k bigint"), few.select(F.explode(F.sequence(F.col("id") * 300, F.col("id") * 300 + 299)).alias("k"))):
        joined = join_counted(rows, counted, ["k"])
        assert "BroadcastHashJoin" not in _final_plan(joined)
        assert joined.count() == joined.select("k").distinct().count() == 60_000

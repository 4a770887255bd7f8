"""Effort scores of dataflow steps, rolled up per dataflow."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SELECT_VALUES = "SelectValues"

# Minutes per action type.
BASE_MINUTES = {
    "LoadFromVault": 1,
    "PublishToVault": 1,
    "Metadata": 1,
    "Order": 2,
    "Unique": 3,
    "Constant": 1,
    "Filter": 6,
    "ReplaceString": 2,
    "TextFormatting": 2,
    "ValueMapper": 2,
    "SetValueField": 2,
    "ConcatFields": 2,
    "SplitColumnAction": 3,
    "GroupBy": 5,
    "UnionAll": 5,
    "MergeJoin": 5,
    "Normalizer": 10,
    "NormalizeAll": 10,
    "Denormaliser": 10,
    "WindowAction": 5,
    "GenerateTableAction": 10,
    "ExpressionEvaluator": 10,
    "NumericCalculator": 7,
    "StringCalculator": 7,
    "DateCalculator": 5,
    "SqlAction": 30,
    "SQL": 30,
    "PythonEngineAction": 30,
}


# Minutes of an unknown type and the length add-on's buckets and caps.
@dataclass(frozen=True)
class LengthRule:
    unknown_type_minutes: float = 20
    bucket_chars: int = 500
    minutes_per_bucket: float = 0.75
    length_cap: float = 15
    fallback_bucket_chars: int = 800
    fallback_minutes_per_bucket: float = 0.5
    fallback_length_cap: float = 12


def weights(spark: SparkSession, minutes: dict[str, float] = BASE_MINUTES) -> DataFrame:
    """Weights as a dimension table."""
    rows = [(k, float(v)) for k, v in minutes.items()]
    return spark.createDataFrame(rows, "weight_type string, weight double")


def with_base_minutes(steps: DataFrame, weight_table: DataFrame, rule: LengthRule = LengthRule()) -> DataFrame:
    """Add ``base_minutes`` by action type.

    The weight table holds one row per action type, a few dozen; Spark broadcasts it on its size.
    """
    joined = steps.join(weight_table, F.col("action_type") == F.col("weight_type"), "left")
    base = F.when(F.col("action_type") == SELECT_VALUES, F.lit(1.0)).otherwise(
        F.coalesce("weight", F.lit(float(rule.unknown_type_minutes)))
    )
    return joined.withColumn("base_minutes", base).drop("weight_type", "weight")


def length_minutes(action_type: Column, chars: Column, fallback: Column, rule: LengthRule = LengthRule()) -> Column:
    """Minutes for long SQL; the size of the action itself stands in when there is no SQL."""
    def capped(size: Column, bucket: int, minutes: float, cap: float) -> Column:
        return F.least(F.floor(size / bucket) * F.lit(float(minutes)), F.lit(float(cap)))

    by_sql = capped(chars, rule.bucket_chars, rule.minutes_per_bucket, rule.length_cap)
    by_size = capped(
        fallback, rule.fallback_bucket_chars, rule.fallback_minutes_per_bucket, rule.fallback_length_cap
    )
    return (
        F.when(action_type == SELECT_VALUES, F.lit(0.0))
        .when((chars <= 0) & (fallback > 0), by_size).otherwise(by_sql)
    )


def score_steps(steps: DataFrame, weight_table: DataFrame, rule: LengthRule = LengthRule()) -> DataFrame:
    """Base, length and total minutes of every step."""
    length = length_minutes(F.col("action_type"), F.col("sql_chars"), F.col("fallback_chars"), rule)
    return with_base_minutes(steps, weight_table, rule).withColumn("length_minutes", length).withColumn(
        "total_minutes", F.col("base_minutes") + F.col("length_minutes")
    )


def pair_by_position(actions: DataFrame, results: DataFrame, flow: str, position: str) -> DataFrame:
    """Actions with the result at the same position; positions only one side has are dropped."""
    return actions.join(results, [flow, position])


def position_mismatch(actions: DataFrame, results: DataFrame, flow: str) -> DataFrame:
    """Flows whose number of actions and results differ."""
    counts = actions.select(flow, F.lit(1).alias("a"), F.lit(0).alias("r")).unionByName(
        results.select(flow, F.lit(0).alias("a"), F.lit(1).alias("r"))
    ).groupBy(flow).agg(F.sum("a").alias("actions"), F.sum("r").alias("results"))
    return counts.filter(F.col("actions") != F.col("results"))


def step_points(scored: DataFrame, flow: str = "dataflow_id", tiles: DataFrame | None = None) -> DataFrame:
    """Points per flow, rounded half to even: step minutes, tiles, and their sum.

    ``tiles(flow, total_tiles)`` overrides the tile count where steps were dropped by pairing.
    """
    sums = scored.groupBy(flow).agg(
        F.sum("total_minutes").alias("minutes"), F.count(F.lit(1)).alias("total_tiles")
    )
    if tiles is not None:
        sums = sums.drop("total_tiles").join(tiles, flow)
    return sums.select(
        flow, F.bround("minutes", 0).cast("bigint").alias("step_points"), "total_tiles",
        F.bround(F.col("minutes") + F.col("total_tiles"), 0).cast("bigint").alias("subtotal_points"),
    )


def flow_scores(requested: DataFrame, scored: DataFrame, errors: DataFrame, flow: str = "dataflow_id") -> DataFrame:
    """One row per requested flow; flows that failed keep their row with blank numbers.

    ``errors(flow, error)`` lists the failures; their text is cut to 500 characters.
    """
    points = step_points(scored, flow)
    failed = errors.select(F.col(flow).alias("__failed"), F.left("error", F.lit(500)).alias("error"))
    joined = requested.select(flow).join(points, flow, "left").join(failed, F.col(flow) == F.col("__failed"), "left")

    def shown(name: str) -> Column:
        return F.when(F.col("__failed").isNull(), F.coalesce(F.col(name), F.lit(0)).cast("string")).otherwise("")

    return joined.select(
        F.concat(F.col(flow).cast("string"), F.lit(".sql")).alias("filename"), F.col(flow),
        shown("step_points").alias("step_points"), shown("total_tiles").alias("total_tiles"),
        shown("subtotal_points").alias("subtotal_points"), F.lit("").alias("total_points"),
        F.col("__failed").isNull().alias("translation_ok"), F.coalesce("error", F.lit("")).alias("error"),
    )

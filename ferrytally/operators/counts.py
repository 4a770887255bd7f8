"""Row counts and their tolerance bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytally.functions.bands import count_bands, percentage


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def both_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row with ``left_rows`` and ``right_rows``; only two numbers meet."""
    counts = row_count(left).select("row_count", F.lit(True).alias("is_left")).unionByName(
        row_count(right).select("row_count", F.lit(False).alias("is_left"))
    )
    return counts.agg(
        F.sum(F.when(F.col("is_left"), F.col("row_count"))).alias("left_rows"),
        F.sum(F.when(~F.col("is_left"), F.col("row_count"))).alias("right_rows"),
    )


def row_count_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Counts, difference and whether the difference is negligible, with the reason."""
    left_rows, right_rows = F.col("left_rows"), F.col("right_rows")
    return both_counts(left, right).select(
        "left_rows", "right_rows", (right_rows - left_rows).alias("difference"),
        (left_rows == right_rows).alias("match"), *count_bands(left_rows, right_rows),
    )


def sample_count_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Absolute difference, negligible below one percent."""
    left_rows, right_rows = F.col("left_rows"), F.col("right_rows")
    pct = percentage(left_rows, right_rows)
    return both_counts(left, right).select(
        "left_rows", "right_rows", F.abs(right_rows - left_rows).alias("difference"),
        (left_rows == right_rows).alias("match"), pct.alias("percentage"), (pct < 1.0).alias("is_negligible"),
    )

"""Tolerance bands, sample sizes and effort formulas as Column expressions."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Confidence levels with their customary z score, and the largest table that
# is taken whole.
Z_SCORES = {0.90: 1.645, 0.95: 1.96, 0.99: 2.576}
WHOLE_TABLE_ROWS = 1000


def z_score(confidence: float) -> float:
    return Z_SCORES.get(confidence) or NormalDist().inv_cdf((1 + confidence) / 2)


def _infinite_size(confidence: float, margin: float) -> float:
    return z_score(confidence) ** 2 * 0.25 / margin**2


def sample_size(rows: Column, confidence: float = 0.95, margin: float = 0.05) -> Column:
    """Finite-population sample size; whole table up to 1,000 rows."""
    n0 = F.lit(_infinite_size(confidence, margin))
    need = F.ceil(n0 / (1 + (n0 - 1) / rows.cast("double")))
    return F.when(rows <= WHOLE_TABLE_ROWS, rows).otherwise(F.least(need, rows)).cast("bigint")


def sample_size_of(rows: int, confidence: float = 0.95, margin: float = 0.05) -> int:
    """The same for a count already on the driver."""
    if rows <= WHOLE_TABLE_ROWS:
        return rows
    n0 = _infinite_size(confidence, margin)
    return min(math.ceil(n0 / (1 + (n0 - 1) / rows)), rows)


def percentage(left: Column, right: Column) -> Column:
    """Absolute difference in percent of the larger count; 0 for two empty tables."""
    larger = F.greatest(left, right)
    return F.when(larger == 0, F.lit(0.0)).otherwise(F.abs(right - left) / F.nullif(larger, F.lit(0)) * 100)


def count_bands(left: Column, right: Column) -> list[Column]:
    """``percentage``, ``is_negligible`` and ``reason`` of a row-count difference."""
    diff = F.abs(right - left)
    pct = percentage(left, right)
    small_share = (pct <= 1.0) & (F.greatest(left, right) >= 10000)
    band = (
        F.when((left == 0) & (right == 0), 0)
        .when((left == 0) | (right == 0), 1)
        .when(diff <= 10, 2)
        .when(pct <= 0.1, 3)
        .when(small_share, 4)
        .otherwise(5)
    )
    pct_text = F.format_string("%.3f%%", pct)
    reason = (
        F.when(band == 0, F.lit("Both datasets are empty"))
        .when(band == 1, F.lit("One dataset is empty"))
        .when(band == 2, F.concat(F.lit("Very small absolute difference ("), diff.cast("string"), F.lit(" rows)")))
        .when(band == 3, F.concat(F.lit("Very small percentage difference ("), pct_text, F.lit(")")))
        .when(band == 4, F.concat(F.lit("Small percentage difference for large dataset ("), pct_text, F.lit(")")))
        .otherwise(
            F.concat(F.lit("Significant difference: "), diff.cast("string"), F.lit(" rows ("), pct_text, F.lit(")"))
        )
    )
    negligible = ~band.isin(1, 5)
    return [pct.alias("percentage"), negligible.alias("is_negligible"), reason.alias("reason")]

"""Bounded samples of labelled rows, to fit models on."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 1 << 52


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document is kept from learning; null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def per_class(rows: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """All rows of a class of at most ``most``; of a larger one those whose hash of ``key`` is small enough.

    The share is three standard deviations below ``most``, so that many rows are the bound but for one class
    in a thousand, and nothing has to be ranked in one task. The classes are few and their sizes are broadcast.
    """
    sizes = rows.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    share = (most - 3 * math.sqrt(most)) / F.col("__n")
    drawn = F.pmod(F.xxhash64(key), F.lit(UNIT)) / F.lit(float(UNIT))
    return rows.join(F.broadcast(sizes), label).filter((F.col("__n") <= most) | (drawn < share)).drop("__n")

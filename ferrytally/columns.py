"""Column references that survive any column name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column by exact name, dots and spaces included."""
    return F.col(quoted(name))


def cols(names: list[str]) -> list[Column]:
    return [col(n) for n in names]


def partner_keys(df: DataFrame, keys: list[str], prefix: str = "__k") -> DataFrame:
    """Rename the key columns so that the frame can be joined to one sharing its lineage."""
    renamed = [col(k).alias(f"{prefix}{i}") for i, k in enumerate(keys)]
    return df.select(*renamed, *cols([c for c in df.columns if c not in keys]))


def same_key(keys: list[str], prefix: str = "__k") -> Column:
    """Null-safe equality of key columns with their renamed partners."""
    return reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(keys)])

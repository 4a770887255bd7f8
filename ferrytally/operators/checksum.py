"""Checksums of tables that do not depend on the order of rows or columns.

A row is hashed twice, each value together with its column's name, and the hashes are summed. Sums of parts add up to the sum of the whole, so a checksum is
taken while a table is written, without another read, and can be compared with that of the table that was loaded. One changed, moved
or lost value changes it, with a chance of 2^-128 that it does not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col


@dataclass(frozen=True)
class Checksum:
    """Rows and two sums of row hashes; that of no rows is zero."""

    rows: int = 0
    first: int = 0
    second: int = 0

    @staticmethod
    def of(row) -> Checksum:
        """From what ``checksum_columns`` gives: a row, or the values an observation collected."""
        return Checksum(*[int(row[name]) for name in ("rows", "first", "second")])

    def __add__(self, other: Checksum) -> Checksum:
        return Checksum(self.rows + other.rows, self.first + other.first, self.second + other.second)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType)


def row_hash(df: DataFrame, salt: int) -> Column:
    """A hash of a row's values and their columns. NULLs count for nothing, like columns that are not there."""
    parts = []
    for f in sorted(df.schema, key=lambda f: f.name.lower()):
        value = col(f.name).cast("string") if _has_map(f.dataType) else col(f.name)
        parts += [F.when(value.isNotNull(), F.lit(f.name.lower())), value]
    return F.xxhash64(F.lit(salt), *parts)


def checksum_columns(df: DataFrame) -> list[Column]:
    """Aggregates for ``agg`` or ``observe``. Decimals keep sums of 64-bit hashes exact for 10^11 rows."""
    sums = [F.sum(row_hash(df, salt).cast("decimal(20,0)")) for salt in (1, 2)]
    return [F.count(F.lit(1)).alias("rows"), *[F.coalesce(s, F.lit(0)).alias(n) for s, n in zip(sums, ("first", "second"))]]


def checksum(df: DataFrame) -> Checksum:
    return Checksum.of(df.agg(*checksum_columns(df)).first())

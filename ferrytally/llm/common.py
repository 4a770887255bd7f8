"""Expressions and helpers that several corpus operators use."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.session import dropping_shuffles, stored  # noqa: F401  (used by the operators)

#: Fixed value: what separates words (space and the control characters 9 to 13).
BLANK = "[\\x20\\x09-\\x0D]+"

#: Rows handed to Python at once; texts are long, so few.
ARROW_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), BLANK, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the optimizer merges."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def upto(n: Column) -> Column:
    """0, 1, ... n-1; empty when n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def windows(items: Column, size: int, make: Callable[[list[Column]], Column]) -> Column:
    """``make`` over each run of ``size`` consecutive items; empty when there are fewer."""
    return let(items, lambda a: F.transform(
        upto(F.size(a) - (size - 1)), lambda i: make([F.get(a, i + k) for k in range(size)])
    ))


def row_key(df: DataFrame) -> Column:
    """A 64-bit hash of a whole row: with the id it tells rows apart that share the id."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if not _has_map(f.dataType)])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(_has_map(f.dataType) for f in kind)


def with_columns(df: DataFrame, row: str, new: dict[str, Column], schema: T.StructType) -> DataFrame:
    """The packed columns ``row.*`` and the new ones; a new column replaces one of its name in any case."""
    taken = {n.lower() for n in new}
    kept = [F.col(row)[f.name].alias(f.name) for f in schema if f.name.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in new.items()])


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over small batches, so that long texts do not pile up in a Python worker."""
    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ARROW_ROWS):
                yield from fn(iter([batch.slice(at, ARROW_ROWS)]))

    return df.mapInArrow(small, schema)


#: A key is hot from so many rows, or a thousandth of all; so at most a thousand keys are.
HOT_ROWS = 1000
HOT_SHARE = 1000
SALTS = 64


def join_counted(rows: DataFrame, counted: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` with what was counted per key: ``counted`` has one row per key and its ``times``.

    The rows of hot keys are dealt into parts, and what was counted for those few keys is sent to every part.
    Keys are not null. Neither side is broadcast: Spark takes rows that an explosion or a Python function made for as few as
    went in, and would send many times what it expects through the driver.
    """
    counted = stored(counted)
    total = counted.agg(F.sum("times")).first()[0] or 0
    # Bounded: at most HOT_SHARE keys.
    hot = F.broadcast(counted.filter(F.col("times") > max(HOT_ROWS, total // HOT_SHARE)).select(*keys, F.lit(True).alias("__hot")))
    dealt = rows.join(hot, keys, "left").withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(F.lit(0).cast("bigint"))
    ).drop("__hot")
    every = F.when(F.col("__hot"), F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    spread = counted.join(hot, keys, "left").withColumn(
        "__salt", F.explode(F.coalesce(every, F.array(F.lit(0).cast("bigint"))))
    ).drop("__hot")
    return dealt.join(spread.hint("merge"), [*keys, "__salt"], how).drop("__salt")

"""Row numbers within a key and first-n selection, safe for keys of any size.

A plain ``row_number() over (partition by key ...)`` sends all rows of a key to one task.
Here the rows per key are counted first (map-side combined, key columns only):

* every key unique      -> the number is the literal 1, no window at all;
* no key above the limit -> one ordinary window;
* keys above the limit   -> their rows are collapsed to distinct rows with a count,
  range-partitioned by key *and* order so that one key spreads over many tasks, numbered
  inside each partition, and shifted by the number of rows in earlier partitions.

All three give the same numbers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols, partner_keys, same_key
from ferrytally.session import materialise, shuffle_width

HOT_ROWS = 1_000_000
BROADCAST_KEYS = 100_000
DIRECT_LIMIT = 100_000
# A top-n of every partition is gathered in one task, so only very small ones are taken directly.
TOP_ROWS = 100

_N, _PART, _START, _CHUNK = "__n", "__part", "__start", "__chunk"


@dataclass(frozen=True)
class KeyProfile:
    """How often the keys of one or two frames repeat."""

    largest: int  # rows of the most frequent key, on one side
    hot_keys: int  # keys with more rows than the limit, all sides together
    hot_rows: int  # rows of those keys
    has_null: bool


def profile_keys(frames: list[DataFrame], keys: list[str], hot_rows: int = HOT_ROWS) -> KeyProfile:
    """Profile the keys of the frames in one job.

    Only an eight-byte hash of the key and partial counts are shuffled, whatever the keys look
    like. Two keys with one hash count as one key, which can only choose a more careful plan.
    """
    tagged = [
        df.select(
            _key_hash(df, keys).alias("__hash"), F.lit(i).alias("__side"),
            reduce(lambda a, b: a | b, [col(k).isNull() for k in keys], F.lit(False)).alias("__null"),
        )
        for i, df in enumerate(frames)
    ]
    sides = [F.count_if(F.col("__side") == i).alias(f"{_N}{i}") for i in range(len(frames))]
    counts = reduce(DataFrame.union, tagged).groupBy("__hash").agg(
        F.count(F.lit(1)).alias(_N), F.bool_or("__null").alias("__null"), *sides
    )
    hot = F.col(_N) > hot_rows
    row = counts.agg(
        F.coalesce(F.max(F.greatest(*[F.col(f"{_N}{i}") for i in range(len(frames))], F.lit(0))), F.lit(0)).alias("largest"),
        F.count_if(hot).alias("hot"),
        F.coalesce(F.sum(F.when(hot, F.col(_N))), F.lit(0)).alias("hot_rows"),
        F.coalesce(F.bool_or("__null"), F.lit(False)).alias("has_null"),
    ).first()
    return KeyProfile(row["largest"], row["hot"], row["hot_rows"], row["has_null"])


def _key_hash(df: DataFrame, keys: list[str]) -> Column:
    if not keys:
        return F.lit(0).cast("bigint")
    # Adding zero makes -0.0 hash like 0.0, which it equals.
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    # The hash passes over NULLs: their places tell (NULL, 1) from (1, NULL).
    values = [col(k) + F.lit(0.0) if k in floats else col(k) for k in keys]
    return F.xxhash64(*values, *[col(k).isNull() for k in keys])


def hot_keys(frames: list[DataFrame], keys: list[str], hot_rows: int) -> DataFrame:
    """Keys (as ``__k<i>``) with more than ``hot_rows`` rows in all frames together."""
    names = [f"__k{i}" for i in range(len(keys))]
    chosen = [df.select(*[col(k).alias(n) for k, n in zip(keys, names, strict=True)]) for df in frames]
    counts = reduce(DataFrame.union, chosen).groupBy(*names).agg(F.count(F.lit(1)).alias(_N))
    return materialise(counts.filter(F.col(_N) > hot_rows))


def split_hot(df: DataFrame, hot: DataFrame, keys: list[str], hot_count: int) -> tuple[DataFrame, DataFrame]:
    """Rows without and with a hot key. The key list is broadcast only below a checked size."""
    side = hot.select(*[f"__k{i}" for i in range(len(keys))])
    side = F.broadcast(side) if hot_count <= BROADCAST_KEYS else side
    return df.join(side, same_key(keys), "left_anti"), df.join(side, same_key(keys), "left_semi")


def number_within(
    df: DataFrame, by: list[str], order: list[str], name: str, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``name``: the 1-based position of each row among the rows with the same ``by``.

    Rows are ordered by ``order`` (NULLs first). Columns outside ``by`` and ``order`` break
    ties, so the result does not depend on partitioning.
    """
    profile = profile_keys([df], by, hot_rows)
    ties = [c for c in df.columns if c not in by and c not in order]
    ordering = [*order, *ties]
    if profile.largest <= 1:
        return df.withColumn(name, F.lit(1).cast("bigint"))
    if profile.hot_keys == 0:
        return _number_by_window(df, by, ordering, name)
    hot = hot_keys([df], by, hot_rows)
    cold_rows, hot_part = split_hot(df, hot, by, profile.hot_keys)
    numbered = number_hot(hot_part, by, ordering, name, hot_rows, profile.hot_rows)
    return _number_by_window(cold_rows, by, ordering, name).unionByName(numbered)


def sortable(df: DataFrame, name: str) -> Column:
    """A column in a form that can be ordered and compared: a map as its sorted entries."""
    if isinstance(df.schema[name].dataType, T.MapType):
        return F.array_sort(F.map_entries(col(name)))
    return col(name)


def _ascending(df: DataFrame, names: list[str]) -> list[Column]:
    return [sortable(df, c).asc_nulls_first() for c in names] or [F.lit(1).asc()]


def _number_by_window(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    window = Window.partitionBy(*cols(by)).orderBy(*_ascending(df, order))
    return df.withColumn(name, F.row_number().over(window).cast("bigint"))


def number_hot(df: DataFrame, by: list[str], order: list[str], name: str, hot_rows: int, total: int) -> DataFrame:
    """Number rows whose keys are all hot; ``total`` is (about) their number."""
    columns = df.columns
    ordering = _ascending(df, order)
    distinct = df.groupBy(*cols(columns)).agg(F.count(F.lit(1)).alias(_N))
    width = shuffle_width(df, total, hot_rows)
    by_order = [col(c).asc_nulls_first() for c in by]
    ranged = materialise(
        distinct.repartitionByRange(width, *by_order, *ordering).withColumn(_PART, F.spark_partition_id())
    )
    earlier = Window.partitionBy(*cols(by)).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*cols(by), _PART).agg(F.sum(_N).alias("__rows"))
        .withColumn("__offset", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
        .drop("__rows")
    )
    inside = (
        Window.partitionBy(*cols(by), _PART).orderBy(*ordering)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumn(_START, F.coalesce(F.sum(_N).over(inside), F.lit(0)))
    placed = local.join(partner_keys(offsets, [*by, _PART]), same_key([*by, _PART]), "inner").select(
        *cols(columns), _N, (F.col(_START) + F.col("__offset")).alias(_START)
    )
    # Identical rows were collapsed; expand them in bounded chunks, each its own task's work.
    chunk = F.lit(hot_rows).cast("bigint")
    chunked = placed.withColumn(
        _CHUNK, F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(_N) - 1) / chunk)))
    )
    if (ranged.agg(F.max(_N)).first()[0] or 0) > hot_rows:
        chunked = chunked.repartition(width, *cols(columns), _CHUNK)
    first = F.col(_CHUNK) * chunk
    last = F.least(F.col(_N), first + chunk) - 1
    return chunked.withColumn("__i", F.explode(F.sequence(first, last))).select(
        *cols(columns), (F.col(_START) + F.col("__i") + 1).cast("bigint").alias(name)
    )


def _sort_keys(order: list[Column], nulls_last: bool) -> list[Column]:
    return [k for c in order for k in ((c.isNull(), c) if nulls_last else (c,))]


def first_rows(
    df: DataFrame, order: list[Column], n: int, nulls_last: bool = False, direct_limit: int = DIRECT_LIMIT
) -> DataFrame:
    """The first ``n`` rows in ascending ``order``, ties broken by the other columns.

    A very small ``n`` is a top-n. A larger one would gather ``n`` rows of every partition in one task:
    then rows that cannot be among the first are filtered out by a sampled upper bound. If a few
    are left, those are sorted; otherwise they are range-partitioned, whole partitions before the cut
    are kept as they are and only the partition holding the cut is sorted for its remainder.
    """
    ties = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    keys = _sort_keys([*order, *cols(ties)], nulls_last)
    if n <= min(TOP_ROWS, direct_limit):
        return df.orderBy(*keys).limit(n)
    near, rows = _below_bound(df, keys, n)
    if rows <= direct_limit:
        return near.orderBy(*keys).limit(n)
    width = shuffle_width(df, rows, direct_limit)
    ranged = materialise(near.repartitionByRange(width, *keys).withColumn(_PART, F.spark_partition_id()))
    sizes = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N)).orderBy(_PART).collect()
    kept, taken, cut = -1, 0, None
    for size in sizes:
        if taken + size[_N] > n:
            cut = size[_PART]
            break
        kept, taken = size[_PART], taken + size[_N]
    chosen = ranged.filter(F.col(_PART) <= kept)
    if cut is not None and taken < n:
        chosen = chosen.unionByName(ranged.filter(F.col(_PART) == cut).orderBy(*keys).limit(n - taken))
    return chosen.drop(_PART)


SAMPLE_ROWS = 20_000


def _below_bound(df: DataFrame, keys: list[Column], n: int) -> tuple[DataFrame, int]:
    """Rows up to a sampled bound and their number, checked to be at least ``n``.

    All rows when a large share of them is wanted anyway.
    """
    total = df.count()
    if n * 4 >= total:
        return df, total
    fraction = min(1.0, SAMPLE_ROWS / total)
    named = [k.alias(f"__s{i}") for i, k in enumerate(keys)]
    sample = df.sample(fraction, seed=0).select(*named)
    types = [f.dataType for f in sample.schema]
    if any(isinstance(t, (T.StructType, T.ArrayType, T.BinaryType)) for t in types):
        return df, total  # such a bound cannot be carried as text
    rank = int(fraction * n * 1.2) + 100
    while rank < SAMPLE_ROWS:
        # Text carries the bound unharmed whatever the session's time zone.
        last = sample.orderBy(*sample.columns).limit(rank).agg(F.max(F.struct(*sample.columns)).alias("b"))
        bound = last.select(*[F.col(f"b.{c}").cast("string").alias(c) for c in sample.columns]).first()
        limit = F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(bound, types, sample.columns, strict=True)])
        near = df.filter(F.struct(*named) <= limit)
        rows = near.count()
        if rows >= n:
            return near, rows
        rank *= 2
    return df, total

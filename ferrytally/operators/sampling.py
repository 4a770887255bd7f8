"""Reproducible samples, synchronised on keys.

A key's place in a random sample is the md5 of the seed and the key, so the same keys are
drawn whatever the partitioning, and both tables agree without exchanging anything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.columns import col, cols, partner_keys, same_key
from ferrytally.functions.bands import sample_size_of
from ferrytally.operators.compare import distinct_keys
from ferrytally.operators.numbering import (
    BROADCAST_KEYS, DIRECT_LIMIT, HOT_ROWS, first_rows, hot_keys, profile_keys, split_hot,
)
from ferrytally.session import materialise

SEED = 42


def sample_rank(keys: list[str], seed: int = SEED) -> Column:
    """Pseudo-random but fixed rank of a key."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("~null~")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


# Keys of a table that Spark expects to be no larger are all ranked; from a larger one those are that can be among the first.
SMALL_BYTES = 1 << 30


def sample_keys(df: DataFrame, keys: list[str], n: int, seed: int = SEED, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """``n`` distinct keys drawn uniformly; all of them when there are no more than ``n``.

    The ranks of distinct keys are uniform, so the ``n`` smallest lie below a bound that the number of distinct keys tells. It is
    estimated by a sketch, one small state per task that merges, and only rows below the bound are made distinct: neither the
    keys of the table nor ``n`` rows of every task are ever shuffled. A bound that turns out too low is raised.
    """
    rank = sample_rank(keys, seed)
    if n > DIRECT_LIMIT:
        return first_rows(distinct_keys(df, keys).withColumn("__rank", rank), [F.col("__rank"), *cols(keys)], n).drop("__rank")
    share = 1.0
    if _expected_bytes(df) > small_bytes:
        known = df.agg(F.approx_count_distinct(rank, 0.02)).first()[0]
        # Six standard deviations of the draw, five of the sketch.
        share = (n + 6 * n**0.5 + 20) / (0.9 * known + 1)
    while True:
        below = df if share >= 1 else df.filter(rank < F.lit(format(int(share * (1 << 64)), "016x")))
        drawn = distinct_keys(below, keys).withColumn("__rank", rank).orderBy("__rank", *cols(keys)).limit(n).drop("__rank")
        if share >= 1:
            return drawn
        drawn = materialise(drawn)
        if drawn.count() >= n:
            return drawn
        share *= 4


def _expected_bytes(df: DataFrame) -> int:
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def first_keys(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` distinct non-NULL keys in the order of ``order``."""
    seen = df.na.drop("any", subset=keys).groupBy(*cols(keys)).agg(F.min(F.struct(*cols(order))).alias("__first"))
    flat = seen.select(*cols(keys), *[F.col("__first")[c].alias(f"__o{i}") for i, c in enumerate(order)])
    return first_rows(flat, [*[F.col(f"__o{i}") for i in range(len(order))], *cols(keys)], n).select(*cols(keys))


BROADCAST_BYTES = 64 << 20


def restrict(
    df: DataFrame, sampled: DataFrame, keys: list[str], sampled_rows: int | None = None, hot_rows: int = HOT_ROWS,
    most: int = BROADCAST_KEYS,
) -> DataFrame:
    """All rows whose key is in ``sampled`` (NULL matches NULL), duplicates kept.

    A list of at most ``most`` keys counts as small. One of a size that is not known is counted first. A small one is broadcast; beside a large one
    rows of hot keys are split off, so that they do not meet in one task.
    """
    listed = sampled.select(*cols(keys))
    side = partner_keys(listed, keys)
    if sampled_rows is None or sampled_rows > most:
        sampled_rows = side.limit(most + 1).count()
    if sampled_rows <= most and (_fixed_width(side) or _bytes(side) <= BROADCAST_BYTES):
        return df.join(F.broadcast(side), same_key(keys), "left_semi")
    profile = profile_keys([df], keys, hot_rows)
    if profile.hot_keys == 0 or profile.hot_keys > BROADCAST_KEYS:
        return df.join(side, same_key(keys), "left_semi")
    hot = hot_keys([df], keys, hot_rows)
    cold_part, hot_part = split_hot(df, hot, keys, profile.hot_keys)
    few = hot.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)]).join(side, same_key(keys), "left_semi")
    kept = hot_part.join(F.broadcast(partner_keys(few, keys)), same_key(keys), "left_semi")
    return cold_part.join(side, same_key(keys), "left_semi").unionByName(kept)


def _fixed_width(side: DataFrame) -> bool:
    """Whether the number of keys bounds their size."""
    return all(isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.TimestampNTZType, T.BooleanType)) for f in side.schema)


def _bytes(side: DataFrame) -> int:
    """The size of a short key list as text."""
    length = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint") for c in side.columns]
    return side.agg(F.coalesce(F.sum(sum(length, F.lit(0))), F.lit(0))).first()[0]


def rows_for_keys(df: DataFrame, sampled: DataFrame, keys: list[str], sampled_rows: int | None = None) -> DataFrame:
    """Rows for listed keys, with the lookup rules of a key list.

    One key column: NULL keys are dropped from the list. Several: NULL finds NULL, and a blank
    text finds the empty string or NULL. A blank becomes both variants on the list side, so the
    join stays an equality join.
    """
    listed = sampled.select(*cols(keys))
    if len(keys) == 1:
        return restrict(df, listed.na.drop("any"), keys, sampled_rows)
    types = {f.name: f.dataType.simpleString() for f in listed.schema}
    for k in [k for k in keys if types[k] == "string"]:
        blank = F.btrim(col(k), F.lit(" \t\n\r")) == ""
        variants = F.when(blank, F.array(F.lit(""), F.lit(None).cast("string"))).otherwise(F.array(col(k)))
        listed = listed.withColumn(k, F.explode(variants))
    bound = None if sampled_rows is None else sampled_rows * 2 ** len(keys)
    return restrict(df, listed.distinct(), keys, bound)


def _size(df: DataFrame, n: int | None) -> int:
    return n if n is not None else sample_size_of(df.count())


def sync_sample(left: DataFrame, right: DataFrame, keys: list[str], n: int | None = None, seed: int = SEED):
    """The same randomly drawn keys on both sides, with all their rows."""
    size = _size(left, n)
    drawn = materialise(sample_keys(left, keys, size, seed))
    return restrict(left, drawn, keys, size), restrict(right, drawn, keys, size)


def sync_first(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], n: int | None = None):
    """The first ``n`` keys of the left side in ``order``, applied to both sides."""
    size = _size(left, n)
    drawn = materialise(first_keys(left, keys, order, size))
    return restrict(left, drawn, keys, size), restrict(right, drawn, keys, size)


def ordered_sample(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """First ``n`` rows by key, NULL keys last."""
    return first_rows(df, cols(keys), n, nulls_last=True)


def random_rows(df: DataFrame, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows at random, not synchronised with anything.

    The rows with the smallest random numbers are taken. A large draw first keeps the rows below a
    threshold that leaves a little more than ``n`` of them, and only those are ordered.
    """
    drawn = df.withColumn("__rand", F.rand(seed))
    if n > DIRECT_LIMIT:
        share = n / max(df.count(), 1) * 1.1
        while True:
            near = materialise(drawn.filter(F.col("__rand") < share))
            if share >= 1 or near.count() >= n:
                break
            share *= 2
        drawn = near
    return first_rows(drawn, [F.col("__rand")], n).drop("__rand")


def coverage(frames: dict[str, DataFrame], sampled: DataFrame) -> DataFrame:
    """Sampled keys against rows returned per side; warns below 80 percent."""
    counts = sampled.select(F.lit("").alias("side"), F.lit(1).alias("key"), F.lit(0).alias("row"))
    for side, df in frames.items():
        counts = counts.unionByName(df.select(F.lit(side).alias("side"), F.lit(0).alias("key"), F.lit(1).alias("row")))
    totals = counts.groupBy("side").agg(F.sum("key").alias("keys"), F.sum("row").alias("rows"))
    one = totals.agg(
        F.sum("keys").alias("expected"),
        *[F.coalesce(F.sum(F.when(F.col("side") == s, F.col("rows"))), F.lit(0)).alias(f"r_{s}") for s in frames],
    )
    entries = [F.struct(F.lit(s).alias("side"), F.col(f"r_{s}").alias("actual")) for s in frames]
    return one.select("expected", F.inline(F.array(*entries))).select(
        "side", "expected", "actual", (F.col("actual") < F.col("expected") * 0.8).alias("warn")
    )

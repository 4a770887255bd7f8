"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows of each source partition go to each shard is drawn first: row by row from the
multivariate hypergeometric distribution of what the shards can still take. Every partition then
permutes its rows and deals them out by its counts, the rows are exchanged, and each shard permutes
what it got. The law is ``rows``: shard sizes differ by one at most.

The driver holds one number per partition and shard, never rows. Partitions are those of a reliable
checkpoint; their rows are ordered by a hash of their position, so no exchange is needed before the one that
moves them. A shard's rows are numbered in ``pieces`` of its hash range, each a window of its own,
so no task sorts a whole shard.

``dealt`` takes a frame whose partitions stay as they are, such as a checkpoint; a scan's may change between the
jobs that count and deal rows. ``sharded`` makes a checkpoint of its whole input. Rows that were not counted, and shards
that do not get the size they were given, are an error.

Defined results: a null text counts no bytes and has the checksum of an empty one. Null ids and repeated
rows are rows like any other; every row gets a slot of its own. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.llm.common import table, with_columns
from ferrytally.session import materialise

SHARDS = 16
SEED = 5
PIECE_ROWS = 50_000


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` taken without replacement are good; exact at any size.

    Inverts the distribution outwards from its mode over 40 standard deviations, beyond which
    a double holds nothing.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    spread = math.sqrt(draws * (good / total) * (bad / total) * max(total - draws, 1) / (total - 1))
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    first, last = max(low, mode - int(40 * spread) - 20), min(high, mode + int(40 * spread) + 20)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) / (k + 1)) + np.log((draws - k) / (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.exp(logs - logs.max())
    cdf = np.cumsum(mass)
    return first + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right"))


def communication_matrix(counts: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows that each partition sends to each shard; all columns sum to the exact shard sizes."""
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    rng = np.random.default_rng(seed)
    matrix = []
    for count in counts:
        row, left, others = [], count, sum(room)
        for s in range(shards):
            others -= room[s]
            taken = hypergeometric(rng, room[s], others, left)
            row.append(taken)
            left -= taken
        room = [r - t for r, t in zip(room, row)]
        matrix.append(row)
    return matrix


def _local_rank() -> Column:
    """The position of a row in its partition."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def dealt(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every row packed as ``__row``, with ``shard`` and ``slot``. ``docs`` keeps its partitions."""
    spark = docs.sparkSession
    counts = {
        r["p"]: r["n"] for r in
        docs.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    order = sorted(counts)
    matrix = communication_matrix([counts[p] for p in order], shards, seed)
    bounds = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(row)]) for p, row in zip(order, matrix)],
        T.StructType([T.StructField("__p", T.IntegerType()), T.StructField("__bounds", T.ArrayType(T.LongType()))]),
    )
    # The rows of a partition in the order of a hash of where they are: the local permutation.
    here = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.spark_partition_id().alias("__p"),
        F.monotonically_increasing_id().alias("__at"),
    ).withColumn("__h", F.xxhash64(F.lit(seed), "__at"))
    ranked = here.sortWithinPartitions("__h", "__at").withColumn("__rank", _local_rank())
    # Bounded: a number per partition and shard.
    moved = F.raise_error(F.lit("partitions changed after their rows were counted")).cast("int")
    known = F.coalesce(F.col("__rank") < F.element_at("__bounds", -1), F.lit(False))
    sent = ranked.join(F.broadcast(bounds), "__p", "left").select(
        "__row", "__at", F.when(known, F.size(F.filter("__bounds", lambda b: b <= F.col("__rank")))).otherwise(moved).alias("shard")
    )
    total = sum(counts.values())
    pieces = max(1, math.ceil(total / shards / PIECE_ROWS))
    again = sent.withColumn("__h", F.xxhash64(F.lit(seed + 1), "__at"))
    again = again.withColumn("__piece", F.pmod(F.shiftrightunsigned("__h", 32), F.lit(pieces)).cast("int"))
    sizes = again.groupBy("shard", "__piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    # Bounded: a row per piece, of which there are rows / PIECE_ROWS.
    size = F.lit(total // shards) + F.when(F.col("shard") < total % shards, 1).otherwise(0)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0))
    offsets = sizes.select(
        "shard", "__piece", F.when(F.sum("n").over(Window.partitionBy("shard")) == size, offset).otherwise(moved).alias("__offset")
    )
    inside = Window.partitionBy("shard", "__piece").orderBy("__h", "__at")
    placed = again.withColumn("__n", F.row_number().over(inside)).join(F.broadcast(offsets), ["shard", "__piece"])
    return placed.select("__row", "shard", (F.col("__offset") + F.col("__n") - 1).cast("bigint").alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The columns of ``docs``, whatever its partitions, with ``shard`` and ``slot``."""
    return with_columns(
        dealt(materialise(docs), shards, seed), "__row", {"shard": F.col("shard"), "slot": F.col("slot")}, docs.schema
    )


def query(spark, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = materialise(table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ))
    return dealt(narrow).select(
        "__row.*", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

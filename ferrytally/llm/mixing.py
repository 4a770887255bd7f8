"""Mixing sources to target weights by Poisson replication.

A source with target weight w gets w / (sum of weights) of the mixture's text. Its repetition rate is
that share over its present one, so that the mixture is expected to be as large as the input. Each
document draws its number of copies from the Poisson distribution with that mean, by inverting the
distribution at a number hashed from the seed and the document; it is exploded by its count, and the
copies are sorted by another hash, their place, which is a global shuffle. Places are uniform, so equal ranges of places are
equal parts: the partition of a copy follows from its place, and texts are shuffled once, without a look at the data first. There are as many
parts as the mixture has ``PART_BYTES``. The distributions are broadcast for up to ``BROADCAST_SOURCES`` sources, a kilobyte or two each;
beyond, rows are joined to them with those of hot sources dealt into parts. Rates above ``STEP`` are drawn as a sum
of Poisson numbers with smaller means, so that nothing underflows.

A draw depends on seed, id and text alone, so it is the same wherever and however often a task runs.

Defined results: a null text has one byte, like an empty one, and is mixed; null is a source of its own.
Repeated rows draw the same count, each for itself. A source without a given weight weighs
``rest``; a weight of 0 removes a source. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import join_counted, table
from ferrytally.session import materialise, shuffle_width

STEP = 64.0  # the largest mean that is inverted at once
SEED = 11
BROADCAST_SOURCES = 5_000
PART_BYTES = 64 << 20  # text of a partition of the mixture, about
PLACES = 1 << 52


def _size(text: str) -> Column:
    """Bytes of a text, with its end."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + 1


def _identity(row: str = "") -> Column:
    return F.concat_ws(
        ":", F.coalesce(F.col(f"{row}doc_id").cast("string"), F.lit("")), F.md5(F.coalesce(F.col(f"{row}text"), F.lit("")).cast("binary"))
    )


def _number(*what: Column) -> Column:
    """52 random bits from a hash, as a number."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *what).cast("binary")), 1, 13), 16, 10).cast("bigint")


def _weighed(docs: DataFrame, weights: dict[str | None, float] | None, rest: float) -> tuple[DataFrame, int, int]:
    """(source, times, rate), the number of sources and the bytes of all their texts."""
    sizes = docs.groupBy("source").agg(F.sum(_size("text")).alias("size"), F.count(F.lit(1)).alias("times"))
    weight = F.lit(float(rest))
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sizes = materialise(sizes.withColumn("weight", weight))
    number, total, heavy = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0)), F.sum("weight")).first()
    rate = F.col("weight") / F.lit(heavy) * F.lit(total) / F.col("size") if heavy else F.lit(0.0)
    return sizes.select("source", "times", rate.alias("rate")), number, total


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, rest: float = 1.0) -> DataFrame:
    """(source, rate): how often each document of a source is to be repeated on average."""
    return _weighed(docs, weights, rest)[0].select("source", "rate")


def distribution(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, ... up to where doubles reach 1."""
    last = (rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.array(F.exp(-rate)).alias("all"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), (s["c"] + p).alias("c"), F.concat(s["all"], F.array(s["c"] + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["all"])


def _copies(docs: DataFrame, weights: dict[str | None, float] | None, rest: float, seed: int) -> tuple[DataFrame, int]:
    """What ``replicas`` returns, and the bytes of the mixture, about."""
    rates, number, total = _weighed(docs, weights, rest)
    steps = F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)).cast("int")
    cdfs = rates.select(
        F.col("source").isNull().alias("__none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__of"), "times", "rate",
        steps.alias("__steps"), (F.col("rate") / steps).alias("__mean"),
    ).withColumn("__cdf", F.when(F.col("rate") > 0, distribution(F.col("__mean"))))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("source").isNull().alias("__none"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("__of"), _identity().alias("__identity"),
    )
    keys = ["__none", "__of"]
    drawn = rows.join(F.broadcast(cdfs), keys) if number <= BROADCAST_SOURCES else join_counted(rows, cdfs, keys)
    count = F.aggregate(F.sequence(F.lit(0), F.col("__steps") - 1), F.lit(0), lambda n, i: n + _inverse(
        F.col("__cdf"), _number(F.lit(str(seed)), i.cast("string"), F.col("__identity")) / F.lit(float(PLACES))
    ))
    counted = drawn.filter("rate > 0").select("__row", "__identity", count.alias("__copies")).filter("__copies > 0")
    copied = counted.select("*", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("__copy"))
    place = _number(F.lit(str(seed + 1)), F.col("__copy").cast("string"), F.col("__identity"))
    return copied.select("__row", "__copies", "__copy", place.alias("__place")), total


def replicas(docs: DataFrame, weights: dict[str | None, float] | None = None, rest: float = 1.0, seed: int = SEED) -> DataFrame:
    """Every copy: the document as ``__row``, its number of copies, the copy's number and its place."""
    return _copies(docs, weights, rest, seed)[0]


def _inverse(cdf: Column, u: Column) -> Column:
    return F.aggregate(cdf, F.lit(0), lambda n, c: n + F.when(c <= u, 1).otherwise(0))


def shuffled(copies: DataFrame, size: int = 0) -> DataFrame:
    """In random order: sorted by place, which is a hash. Only rows that are alike can tie.

    ``size`` is the number of bytes to expect; there are no fewer parts than the session shuffles into.
    """
    width = shuffle_width(copies, size, PART_BYTES)
    part = F.floor(F.col("__place") / F.lit(PLACES // width + 1)).cast("int")
    return copies.repartitionById(width, part).sortWithinPartitions("__place", "__copy")


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, rest: float = 1.0, seed: int = SEED) -> DataFrame:
    """The mixture, with the columns of ``docs``."""
    copies = shuffled(*_copies(docs, weights, rest, seed))
    return copies.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """Equal shares for all sources: every copy with its text, in shuffled order."""
    copies = shuffled(*_copies(table(spark, sf_dir, "documents"), None, 1.0, SEED))
    return copies.select(
        "__row.doc_id", "__row.source", "__row.text", F.col("__copies").alias("n_copies"),
        F.col("__copy").alias("copy"), F.col("__place").alias("place"),
    )


def _hashed(*parts: str) -> str:
    return f"CAST('0x' || substr(md5({' || chr(58) || '.join(parts)}), 1, 13) AS BIGINT)"


_ID = "coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))"

#: For rates up to STEP, which equal weights over these tables never pass.
SQL = f"""
WITH d AS (SELECT *, {_ID} AS ident, coalesce(octet_length(encode(text)), 0) + 1 AS size FROM documents),
s AS (SELECT source, CAST(1 AS DOUBLE) / (SELECT count(DISTINCT coalesce(source, '')) FROM d) * (SELECT sum(size) FROM d) / sum(size) AS rate
  FROM d GROUP BY source),
c AS (SELECT source, unnest(list_transform(range(0, CAST(floor(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1),
  lambda j: list_sum(list_transform(range(0, j + 1), lambda k: exp(k * ln(rate) - rate - lgamma(k + 1)))))) AS cdf FROM s),
n AS (SELECT d.doc_id, d.source, d.text, d.ident, d.u, (SELECT count(*) FROM c WHERE c.source IS NOT DISTINCT FROM d.source AND c.cdf <= d.u) AS n_copies
  FROM (SELECT *, {_hashed(f"'{SEED}'", "'0'", "ident")} / CAST({1 << 52} AS DOUBLE) AS u FROM d) d),
e AS (SELECT *, unnest(range(0, n_copies)) AS copy FROM n)
SELECT doc_id, source, text, CAST(n_copies AS INTEGER) AS n_copies, CAST(copy AS INTEGER) AS copy,
  {_hashed(f"'{SEED + 1}'", "CAST(copy AS VARCHAR)", "ident")} AS place FROM e
"""

"""Benchmark decontamination by SimHash windows of item size.

An item is contaminating where a window of a document, as long as the item, has a weighted
similarity of at least ``similarity`` to it on 5-word shingles (a shingle weighs as often as it occurs)
and a fingerprint within ``radius`` bits. A document shorter than the item is one window, compared whole. An
item shorter than a shingle is one shingle of its own length, and is found where its words stand in a row.

Windows are compared by fingerprint: the 64 bits are cut into ``blocks``; within the radius at least
one block differs by no more than radius/blocks bits, so joining the windows' blocks with all such
neighbours of the items' blocks finds every fingerprint within the radius. The exact similarity
verifies what is found.

Which windows need a fingerprint follows from the similarity: with n shingles on either side, at least
``2 n s / (1 + s)`` of the window's shingles occur in an item of that length, so one of its first few
does. Only windows with such a shingle there are built; no other window can qualify. The same holds for a whole
document of m shingles, which must share ``(m + n) s / (1 + s)`` of them.

Everything is narrow work beside broadcast joins with the items. The benchmark is dealt into parts
of about ``part_shingles`` shingles and ``part_rows`` neighbours of blocks, so a broadcast has a known bound, but
for an item longer than a part, which is a part of its own; more parts mean more passes.

Defined results: texts without words, null or empty, and items without words match nothing; an empty
benchmark or table gives no rows. Items with equal texts all match. Rows with a null id are matched
like others. Repeated rows give one row per (doc_id, item_id).
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import let, row_key, table, upto, windows, words


@dataclass(frozen=True)
class Match:
    shingle: int = 5
    similarity: float = 0.8
    radius: int = 15
    blocks: int = 8  # divides 64
    part_shingles: int = 100_000  # of the items that are broadcast at once
    part_rows: int = 1_000_000  # of blocks and their neighbours that are broadcast at once

    def least_common(self, m: Column, n: Column) -> Column:
        """How many of m shingles a window must share with an item of n shingles."""
        return F.ceil((m + n) * F.lit(self.similarity / (1 + self.similarity)) - F.lit(1e-9))


def shingles(text: Column, size: int) -> Column:
    """The hashes of a text's shingles, in order; a short text is one shingle, an empty one none."""
    return let(words(F.lower(text)), lambda w: F.when(
        F.size(w) >= size, windows(w, size, lambda x: F.xxhash64(*x))
    ).when(F.size(w) > 0, F.array(F.xxhash64(F.lit("short"), F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>")))


def _bits(hashes: Column, lane: int) -> Column:
    """How many hashes have each of the 64 bits: 64-bit sums that hold ``lane``-bit counters side by side."""
    ones = sum(1 << at for at in range(0, 64, lane))
    mask = F.lit(ones - (1 << 64) if ones >> 63 else ones).cast("bigint")
    return F.array(*[
        F.aggregate(hashes, F.lit(0).cast("bigint"), lambda s, h: s + F.shiftrightunsigned(h, shift).bitwiseAND(mask))
        for shift in range(lane)
    ])


def _majority(sums: Column, n: Column, lane: int) -> Column:
    """The fingerprint: bit set where more than half of the n hashes have it."""
    top = F.lit((1 << lane) - 1).cast("bigint")
    bits = []
    for bit in range(64):
        count = F.shiftrightunsigned(F.get(sums, F.lit(bit % lane)), bit // lane * lane).bitwiseAND(top)
        value = (1 << bit) - (1 << 64) if bit == 63 else 1 << bit
        bits.append(F.when(2 * count > n, F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return bits[0]


def fingerprint(hashes: Column) -> Column:
    """SimHash of an array of shingle hashes; counters of 8 bits where they suffice, else of 32.

    The highest counter shares its word with the sign, so it holds one bit less.
    """
    def counted(lane: int) -> Column:
        return let(hashes, lambda h: let(_bits(h, lane), lambda s: _majority(s, F.size(h).cast("bigint"), lane)))

    return F.when(F.size(hashes) <= 127, counted(8)).otherwise(counted(32))


def tagged(hashes: Column) -> Column:
    """The hashes with the number of each occurrence mixed in: as a set, what the hashes are as a bag."""
    def numbered(h: Column) -> Column:
        return let(F.sort_array(h), lambda s: F.transform(s, lambda x, i: F.xxhash64(x, i - F.array_position(s, x) + 1)))

    return let(hashes, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.transform(h, lambda x: F.xxhash64(x, F.lit(0).cast("bigint")))
    ).otherwise(numbered(h)))


def _blocks(fp: Column, match: Match) -> list[Column]:
    width = 64 // match.blocks
    low = F.lit((1 << width) - 1).cast("bigint")
    return [F.shiftrightunsigned(fp, i * width).bitwiseAND(low) for i in range(match.blocks)]


def _flips(match: Match) -> list[int]:
    """Every difference that a block may have: up to radius/blocks bits."""
    width = 64 // match.blocks
    return [
        sum(1 << b for b in chosen)
        for k in range(match.radius // match.blocks + 1) for chosen in combinations(range(width), k)
    ]


def _first_near(differing: Column, match: Match) -> Column:
    """The first block that differs little enough: a pair met in several blocks is checked in that one."""
    most = match.radius // match.blocks
    return F.coalesce(*[F.when(F.bit_count(b) <= most, F.lit(i)) for i, b in enumerate(_blocks(differing, match))])


def item_table(benchmark: DataFrame, match: Match) -> DataFrame:
    """item, words of a short one (else 0), n, hashes, fp, bag and the bag's own hash of every item with words."""
    many = F.size(words(F.col("text")))
    own = benchmark.select(
        F.col("item_id").alias("item"), F.when(many < match.shingle, many).otherwise(0).alias("short"),
        shingles(F.col("text"), match.shingle).alias("h"),
    ).filter(F.size("h") > 0)
    made = own.select(
        "item", "short", F.size("h").alias("n"), "h", fingerprint(F.col("h")).alias("fp"), tagged(F.col("h")).alias("bag")
    )
    return made.withColumn("key", F.xxhash64("item", "bag")).dropDuplicates(["key"])


def leaks(docs: DataFrame, benchmark: DataFrame, match: Match = Match(), keys: dict[str, Column] | None = None) -> DataFrame:
    """One row per document and item that it holds: the best window, its place and similarity."""
    keys = keys or {"doc_id": F.col("doc_id")}
    items = item_table(benchmark, match)
    # Bounded: a length is less than a shingle's.
    brief = F.col("short") > 0
    total, number, few, lengths = items.agg(
        F.coalesce(F.sum(F.when(~brief, F.col("n"))), F.lit(0)), F.count_if(~brief), F.count_if(brief),
        F.collect_set(F.when(brief, F.col("short"))),
    ).first()
    parts = max(math.ceil(total / match.part_shingles), math.ceil(number * match.blocks * len(_flips(match)) / match.part_rows), 1)
    found = reduce(DataFrame.unionByName, [
        *[_leaks_of(docs, part, match, keys) for part in _dealt(items.filter(~brief), parts)],
        *[_short_leaks(docs, part, sorted(lengths), keys) for part in _dealt(items.filter(brief), math.ceil(few / match.part_rows))],
    ])
    best = F.max(F.struct("similarity", (-F.col("hamming")).alias("near"), (-F.col("start")).alias("first"), "n")).alias("best")
    return found.groupBy(*keys, "item").agg(best).select(
        *keys, F.col("item").alias("item_id"), (-F.col("best.first")).alias("start_word"),
        F.col("best.n").alias("n_shingles"),
        (-F.col("best.near")).alias("hamming"), "best.similarity",
    )


def _dealt(items: DataFrame, parts: int) -> list[DataFrame]:
    part = F.pmod(F.xxhash64(F.lit("part"), "key"), F.lit(parts))
    return [items if parts == 1 else items.filter(part == i) for i in range(parts)]


def _short_leaks(docs: DataFrame, items: DataFrame, lengths: list[int], keys: dict[str, Column]) -> DataFrame:
    """Items of fewer words than a shingle: found where a run of as many words is the same."""
    def placed(hashes: Column, k: int) -> Column:
        return F.transform(hashes, lambda h, i: F.struct(h.alias("run"), F.lit(k).alias("short"), i.alias("start")))

    runs = let(words(F.lower(F.col("text"))), lambda w: F.concat(*[
        placed(windows(w, k, lambda x: F.xxhash64(F.lit("short"), F.concat_ws(" ", *x))), k) for k in lengths
    ]))
    spots = docs.select(*[c.alias(k) for k, c in keys.items()], F.explode(runs).alias("__r"))
    own = items.select("item", "short", F.get("h", F.lit(0)).alias("run"))
    return spots.select(*keys, "__r.run", "__r.short", "__r.start").join(F.broadcast(own), ["run", "short"]).select(
        *keys, "item", F.lit(1).alias("n"), "start", F.lit(0).alias("hamming"), F.lit(1.0).alias("similarity")
    )


def _leaks_of(docs: DataFrame, items: DataFrame, match: Match, keys: dict[str, Column]) -> DataFrame:
    screen = items.select(F.explode("h").alias("__hash"), F.col("n").alias("n")).groupBy("__hash").agg(
        F.collect_set("n").alias("__lengths")
    )
    texts = docs.select(*[c.alias(k) for k, c in keys.items()], shingles(F.col("text"), match.shingle).alias("__h"))
    spots = texts.select(*keys, "__h", F.posexplode("__h").alias("__at", "__hash"))
    hits = spots.join(F.broadcast(screen), "__hash").select(*keys, "__h", "__at", F.explode("__lengths").alias("n"))
    n, m = F.col("n"), F.least(F.size("__h"), "n")
    # The windows that have this shingle among their first ones.
    starts = hits.select(
        *keys, "__h", "n", F.explode(F.transform(
            upto((m - match.least_common(m, n) + 1).cast("int")), lambda k: F.col("__at") - k
        )).alias("start"),
    ).filter((F.col("start") >= 0) & (F.col("start") + m <= F.size("__h")))
    window = starts.select(*keys, "n", "start", F.slice("__h", F.col("start") + 1, n).alias("w"))
    printed = window.select(*keys, "n", "start", "w", fingerprint(F.col("w")).alias("fp"))
    parts = printed.select("*", F.posexplode(F.array(*_blocks(F.col("fp"), match))).alias("block", "value"))
    wanted = items.select(
        F.col("key"), F.col("n").alias("n_item"), F.col("fp").alias("fp_item"),
        F.posexplode(F.array(*_blocks(F.col("fp"), match))).alias("block_item", "own"),
    ).select("*", F.explode(F.array(*[
        F.col("own").bitwiseXOR(F.lit(f).cast("bigint")) for f in _flips(match)
    ])).alias("value_item")).drop("own")
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp_item")))
    near = parts.join(
        F.broadcast(wanted),
        (F.col("n") == F.col("n_item")) & (F.col("block") == F.col("block_item")) & (F.col("value") == F.col("value_item"))
        & (apart <= match.radius) & (F.col("block") == _first_near(F.col("fp").bitwiseXOR(F.col("fp_item")), match)),
    )
    checked = near.select(*keys, "n", "start", "w", "key", apart.alias("hamming")).join(
        F.broadcast(items.select("key", "item", "bag")), "key"
    )
    common = F.size(F.array_intersect("bag", tagged(F.col("w"))))
    scored = checked.select(
        *keys, "item", F.size("w").alias("n"), "start", "hamming",
        (common / (F.size("w") + F.col("n") - common)).alias("similarity"),
    )
    return scored.filter(F.col("similarity") >= match.similarity)


def remove_leaks(docs: DataFrame, benchmark: DataFrame, match: Match = Match()) -> DataFrame:
    """The documents that hold no item, with their columns."""
    keys = {"__id": F.col("doc_id"), "__key": row_key(docs)}
    held = leaks(docs, benchmark, match, keys).select(F.col("__id").alias("__own"), F.col("__key").alias("__ownkey")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *[c.alias(n) for n, c in keys.items()])
    kept = rows.join(held, F.col("__id").eqNullSafe(F.col("__own")) & (F.col("__key") == F.col("__ownkey")), "left_anti")
    return kept.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

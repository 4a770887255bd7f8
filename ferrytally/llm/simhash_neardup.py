"""Near duplicates by SimHash, found through tables of distances to reference fingerprints.

Each distinct fingerprint gets its Hamming distances to many references (pivots): random ones and,
for each of those, variants with one block of bits flipped. The distance to a variant minus that
to its base depends on that block alone, and is equal for fingerprints that agree there. Two
fingerprints within ``radius`` bits agree in all but ``radius`` blocks, so they share the tuple of
differences for at least one choice of the other blocks: those tuples are the join keys, and no
link is missed. Within a key, pairs whose distances to any base pivot differ by more than the
radius are discarded, and the exact distance decides the rest.

Only distinct fingerprints take part, so exact copies cost nothing. A key with many members is cut
into chunks and every pair of chunks is a group of its own, so no task holds more than two
chunks. A group emits a spanning forest of its links, never all of them: components stay the same.

``near_duplicates`` links fingerprints of 64 bits within 3. That is far closer than a similarity of 0.8, at which texts
differ in about 15 % of the bits. ``one_of_each`` joins texts whose sets of five-word shingles have a Jaccard similarity of at
least 0.8, all of them and no others, in two steps that never list pairs (``set_links``):

* tentative links make clusters. Most come from 128-bit fingerprints within the radius that belongs to 0.8, whose keys are tuples of
  distances to pivots within chosen bits. What they miss comes from the prefix filter, between texts not in one cluster so far: shingles
  have one order for all texts, frequent ones last, and two similar sets share one among their first. That misses no pair;
* within the clusters whole sets of shingle hashes decide, and a spanning forest of the links that hold comes out.

Defined results: null and empty texts have fingerprint 0 and are linked like any other. Rows
with a null id take part; a component's id is the smallest id that is not null, and null if there
is none. Repeated rows are returned once each by ``near_duplicates``; ``one_of_each`` keeps one
row of a component, that with the smallest (id, row hash), nulls last.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import join_counted, map_arrow, row_key, stored, table
from ferrytally.llm.components import components
from ferrytally.llm.fingerprints import fingerprint, fingerprint_columns, fingerprinted
from ferrytally.llm.ngram_join import Join, bucket_bits, bucket_counts, ngrams, with_sets
from ferrytally.llm.set_links import Similarity, cells_of, exact_links, prefix_forest
from ferrytally.session import materialise


@dataclass(frozen=True)
class Pivots:
    radius: int = 3
    blocks: int = 6  # of the 64 bits; at least radius + 1
    bases: int = 8
    seed: int = 7
    chunk: int = 1024  # fingerprints of one key that are compared with each other at once

    def bounds(self) -> list[int]:
        return [64 * i // self.blocks for i in range(self.blocks + 1)]

    def masks(self) -> list[int]:
        edges = self.bounds()
        return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]

    def references(self) -> list[int]:
        rng = np.random.default_rng(self.seed)
        return [int(x) for x in rng.integers(0, 1 << 64, self.bases, dtype=np.uint64)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _distance(fp: Column, to: int) -> Column:
    return F.bit_count(fp.bitwiseXOR(F.lit(_signed(to)).cast("bigint")))


def pivot_keys(fps: DataFrame, pivots: Pivots) -> DataFrame:
    """(fp, k): the join keys of a fingerprint, one for each choice of blocks that a near one may share."""
    bases, fp = pivots.references(), F.col("fp")
    about = fps.select("fp", *[
        F.xxhash64(*[_distance(fp, b) - _distance(fp, b ^ m) for b in bases]).alias(f"about{i}")
        for i, m in enumerate(pivots.masks())
    ])
    chosen = combinations(range(pivots.blocks), pivots.blocks - pivots.radius)
    keys = [F.xxhash64(F.lit(i), *[F.col(f"about{block}") for block in blocks]) for i, blocks in enumerate(chosen)]
    return about.select("fp", F.explode(F.array(*keys)).alias("k"))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints whose last axis is their words."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int16)


def forest(fps: np.ndarray, bases: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (positions) that join what is within the radius: a spanning forest of the group."""
    table = _apart(fps[:, None], bases[None, :])
    left = np.arange(len(fps))
    links: list[tuple[int, int]] = []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.abs(table[left] - table[at]).max(axis=1) <= radius
            near[near] = _apart(fps[left[near]], fps[at]) <= radius
            found, left = left[near], left[~near]
            links.extend((int(at), int(x)) for x in found)
            queue.extend(found)
    return links


DENSE = 1  # links per member beyond which a group is reduced to a forest


def near_pairs(fps: np.ndarray, bases: np.ndarray, radius: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of consecutive rows: all of them, or a spanning forest where they are many."""
    table = _apart(fps[:, None], bases[None, :])
    group = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    ends = np.repeat(cuts[1:], np.diff(cuts))
    first, second, links = [], [], np.zeros(len(cuts) - 1, np.int64)
    rows, step = np.arange(len(fps)), 1
    dense = np.zeros(len(cuts) - 1, bool)
    while len(rows):
        rows = rows[(rows + step < ends[rows]) & ~dense[group[rows]]]
        near = rows[np.abs(table[rows] - table[rows + step]).max(axis=1, initial=0) <= radius]
        near = near[_apart(fps[near], fps[near + step]) <= radius]
        first.append(near)
        second.append(near + step)
        np.add.at(links, group[near], 1)
        dense = links > DENSE * np.diff(cuts)
        step += 1
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (first, second))
    kept = ~dense[group[a]]
    a, b = [a[kept]], [b[kept]]
    for g in np.flatnonzero(dense):
        lo, hi = cuts[g], cuts[g + 1]
        found = np.array(forest(fps[lo:hi], bases, radius), np.int64).reshape(-1, 2) + lo
        a.append(found[:, 0])
        b.append(found[:, 1])
    return np.concatenate(a), np.concatenate(b)


def _group_links(bases: np.ndarray, radius: int):
    """Links of all groups (k, i, j) in sorted rows; a group may go on over several batches."""
    words = bases.shape[1]
    columns = ["k", "i", "j", *fingerprint_columns(words)]
    names = [f"{side}{w}" for side in "ab" for w in range(words)]

    def links_of(rows: list[np.ndarray], cuts: np.ndarray) -> pa.RecordBatch:
        fps = np.stack([c.view(np.uint64) for c in rows[3:]], axis=1)
        pairs = near_pairs(fps, bases, radius, cuts)
        out = [np.ascontiguousarray(fps[side, w]).view(np.int64) for side in pairs for w in range(words)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.empty(0, np.int64)] * len(columns)
        for batch in batches:
            rows = [np.concatenate([r, batch.column(n).to_numpy()]) for r, n in zip(rest, columns)]
            if not len(rows[0]):
                continue
            new = reduce(np.logical_or, [c[1:] != c[:-1] for c in rows[:3]])
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1])
            # The last group may go on in the next batch.
            rest = [c[cuts[-1]:] for c in rows]
            yield links_of([c[:cuts[-1]] for c in rows], cuts)
        if len(rest[0]):
            yield links_of(rest, np.array([0, len(rest[0])]))

    return run


def linked(keyed: DataFrame, bases: np.ndarray, radius: int, chunk: int) -> DataFrame:
    """Links (a0.., b0..) between fingerprints that share a key ``k``: enough to join all that are near.

    A key with many members is cut into chunks, and each pair of chunks is a group of its own.
    """
    words = fingerprint_columns(bases.shape[1])
    shared = keyed.groupBy("k").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    chunks = F.ceil(F.col("times") / F.lit(chunk)).cast("bigint")
    members = join_counted(keyed, shared, ["k"]).select(
        "k", *words, chunks.alias("c"), F.pmod(F.xxhash64(*words, "k"), chunks).alias("own")
    )
    placed = members.select(
        "k", *words, "own", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c") - 1)).alias("other")
    ).select("k", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *words)
    grouped = placed.repartition("k", "i", "j").sortWithinPartitions("k", "i", "j")
    kind = ", ".join(f"{side}{w} bigint" for side in "ab" for w in range(len(words)))
    return grouped.mapInArrow(_group_links(bases, radius), kind).distinct()


def fingerprint_links(fps: DataFrame, pivots: Pivots = Pivots()) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp``: enough to join all that are near."""
    bases = np.array(pivots.references(), np.uint64).reshape(-1, 1)
    keyed = pivot_keys(fps, pivots).withColumnRenamed("fp", "fp0")
    return linked(keyed, bases, pivots.radius, pivots.chunk).select(F.col("a0").alias("a"), F.col("b0").alias("b"))


def classes(light: DataFrame, pivots: Pivots) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``light``."""
    fps = light.select("fp").distinct()
    joined = components(fingerprint_links(fps, pivots))
    return fps.join(joined, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, pivots: Pivots = Pivots()) -> DataFrame:
    """doc_id, fingerprint and component of every row."""
    light = materialise(fingerprinted(docs, {"doc_id": F.col("doc_id")}, "text", shingle).withColumnRenamed("fp0", "fp"))
    least = light.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    known = classes(light, pivots).join(least, "fp")
    named = known.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("times"))
    # One fingerprint may be that of a third of the rows, one class that of a third of the fingerprints.
    of = join_counted(known, named, ["root"]).select("fp", "component_id", F.col("rows").alias("times"))
    return join_counted(light, of, ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@dataclass(frozen=True)
class Wide:
    """Near duplicates by similarity: wider fingerprints, and keys that a similar pair shares with high probability.

    Texts of Jaccard similarity s differ in a share ``differs(s)`` of their bits. A key is the tuple of distances
    to the bases within ``bits`` chosen bits, and there are as many keys as a pair of the wanted similarity needs to
    share one with probability ``recall``. More texts take longer keys, and more of them.
    """

    similarity: float = 0.8
    words: int = 2
    recall: float = 0.97
    bases: int = 8
    seed: int = 7
    least_bits: int = 16
    spare: int = 64  # unrelated texts per key, about
    slack: int = 3  # bits beyond the expected distance at the wanted similarity
    chunk: int = 1024

    def differs(self, similarity: float) -> float:
        return math.acos(2 * similarity / (1 + similarity)) / math.pi

    @property
    def radius(self) -> int:
        return round(64 * self.words * self.differs(self.similarity)) + self.slack

    def references(self) -> np.ndarray:
        return np.random.default_rng(self.seed).integers(0, 1 << 64, (self.bases, self.words), dtype=np.uint64)

    def masks(self, texts: int) -> np.ndarray:
        """The bits of each key, for so many texts."""
        bits = max(self.least_bits, math.ceil(math.log2(max(texts, 1) / self.spare + 1)))
        alike = (1 - self.differs(self.similarity)) ** bits
        rng = np.random.default_rng(self.seed + 1)
        out = np.zeros((math.ceil(math.log(1 - self.recall) / math.log(1 - alike)), self.words), np.uint64)
        for mask in out:
            for bit in rng.choice(64 * self.words, bits, replace=False):
                mask[bit // 64] |= np.uint64(1) << np.uint64(bit % 64)
        return out


def _wide_keys(bases: np.ndarray, masks: np.ndarray):
    names = fingerprint_columns(bases.shape[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.stack([batch.column(n).to_numpy().view(np.uint64) for n in names], axis=1)
            unlike = fps[:, None] ^ bases[None]
            for i, mask in enumerate(masks):
                # Half the difference of the distances to a base and to the base with the mask's bits flipped.
                inside = np.bitwise_count(unlike & mask).sum(axis=-1, dtype=np.uint8)
                key = np.ascontiguousarray(inside).view(np.uint64)[:, 0] * np.uint64(0x9E3779B97F4A7C15)
                key = (key ^ (key >> np.uint64(32))) + np.uint64(0xC2B2AE3D27D4EB4F * (i + 1) & ((1 << 64) - 1))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *[batch.column(n) for n in names]], names=["k", *names])

    return run


BUDGET = 1 << 19  # hashes that a task compares with each other


def shingled(docs: DataFrame, keys: dict[str, Column], join: Join, wide: Wide) -> DataFrame:
    """``keys``, the fingerprint, ``node`` (hash of the set of shingles), its size ``n``, its prefix ``first`` and ``cells`` of each text."""
    bits = bucket_bits(docs)
    counts = docs.sparkSession.sparkContext.broadcast(bucket_counts(docs, "text", join.words, bits))
    narrow = docs.select(*[c.alias(n) for n, c in keys.items()], F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("__text"))
    names = list(keys)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "__text")
    more = [*fingerprint_columns(wide.words), "node", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, first, cells = [], [], []
            for t in b.column("__text"):
                h = ngrams(t.as_py(), join.words)
                node = int(np.uint64(xxhash.xxh64_intdigest(h.tobytes())).view(np.int64))
                found.append([*fingerprint(h, wide.words), node, len(h)])
                first.append(join.prefix(h, counts.value, bits))
                cells.append(cells_of(h))
            values = [pa.array([f[i] for f in found], pa.int64()) for i in range(len(more))]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(n) for n in names], *values, pa.array(first, pa.list_(pa.int64())), pa.array(cells, pa.binary())],
                names=[*names, *more, "first", "cells"],
            )

    return map_arrow(narrow, run, ", ".join([kept, *[f"{n} bigint" for n in more], "first array<bigint>", "cells binary"]))


def pivot_pairs(texts: DataFrame, wide: Wide) -> DataFrame:
    """Candidates (a, b): nodes whose fingerprints are linked, and nodes of one fingerprint."""
    words = fingerprint_columns(wide.words)
    named = stored(texts.filter("n > 0").groupBy(*words).agg(F.min("node").alias("name")))
    bases = wide.references()
    kind = ", ".join(["k bigint", *[f"{w} bigint" for w in words]])
    keyed = named.select(*words).mapInArrow(_wide_keys(bases, wide.masks(named.count())), kind)
    links = linked(keyed, bases, wide.radius, wide.chunk)
    # A row for each text: not to be broadcast, however small its file.
    named = named.hint("merge")
    a, b = (named.select(*[F.col(w).alias(w.replace("fp", x)) for w in words], F.col("name").alias(x)) for x in "ab")
    near = links.join(a, [w.replace("fp", "a") for w in words]).join(b, [w.replace("fp", "b") for w in words]).select("a", "b")
    return near.unionByName(texts.filter("n > 0").join(named, words).select(F.col("name").alias("a"), F.col("node").alias("b")))


def one_of_each(docs: DataFrame, shingle: int = 5, wide: Wide = Wide()) -> DataFrame:
    """One row of every group of similar texts, with the columns of ``docs``."""
    keys = {"__id": F.col("doc_id"), "__key": row_key(docs)}
    cut = Fraction(wide.similarity).limit_denominator(1000)
    join = Join(words=shingle, similar=Similarity(cut.numerator, cut.denominator), chunk=wide.chunk, budget=BUDGET)
    light = shingled(docs, keys, join, wide)
    least = F.min(F.struct(F.col("__id").isNull().alias("last"), F.col("__id"), F.col("__key"))).alias("least")
    # Texts with the same shingles are counted together before anything is joined.
    same = [F.first(c).alias(c) for c in (*fingerprint_columns(wide.words), "n", "first", "cells")]
    texts = stored(light.groupBy("node").agg(least, *same))
    near = stored(pivot_pairs(texts, wide))
    # What the many keys link is joined once: from here on a row for each node stands for it.
    joined = stored(components(near))
    labelled = texts.filter("n > 0").join(joined, "node", "left").withColumn("label", F.coalesce("root", "node"))
    rest = prefix_forest(stored(labelled.select("node", "label", "n", "first", "cells")), join.similar, join.chunk)
    clusters = components(joined.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(rest))
    one = F.struct(F.col("least.__key").alias("row"), F.col("least.__id").alias("id")).alias("one")
    clustered = stored(clusters.join(texts, "node").select(F.col("root").alias("cluster"), "node", "n", one))
    classes_of = components(exact_links(clustered, lambda rows: with_sets(docs, rows, "doc_id", "text", join), join.similar, join.budget))
    chosen = texts.select("node", "least").join(classes_of, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.min("least").alias("least")
    ).select(F.col("least.__id").alias("__own"), F.col("least.__key").alias("__ownkey"))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *[c.alias(n) for n, c in keys.items()])
    once = keyed.dropDuplicates(["__id", "__key"])
    kept = once.join(
        chosen, F.col("__id").eqNullSafe(F.col("__own")) & (F.col("__key") == F.col("__ownkey")), "left_semi"
    )
    return kept.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

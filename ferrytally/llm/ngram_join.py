"""Documents whose sets of word n-grams are similar, joined through an R-tree of count vectors.

A document's set is hashed, and its hashes are counted in groups: the counts are a point. Two sets share at most the sum of the lesser
counts, and a box of points bounds what any point in it can share, so an R-tree of points discards most pairs without looking at the sets.
What survives is verified on whole sets (``set_links``).

A bound on counts alone separates nothing across a whole corpus: the counts of any two documents of one length differ little compared with
what similarity 0.85 allows. So points meet in an R-tree only where they may be similar for another reason: similar sets share one of their
first hashes (15 % of them) in any order that all sets have in common. The order puts frequent hashes last, by counts over all
documents in a fixed number of buckets. Neither step loses a pair.

Equal sets count once, however many documents have them.

Defined results: null and empty texts have an empty set and are linked with nothing; a text with fewer words than an n-gram has one element, its whole
sequence. Rows with a null id take part; a component's id is the smallest id that is not null, and null if there is none. Repeated rows are returned
each. Two n-grams count as one only if 64 bits of hash agree, two sets only if 128 do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import ARROW_ROWS, join_counted, map_arrow, row_key, stored, table
from ferrytally.llm.components import components
from ferrytally.llm.set_links import Similarity, cells_of, exact_links, prefix_forest

FEWEST, MOST = 16, 22  # powers of two: buckets that hashes are counted in


@dataclass(frozen=True)
class Join:
    words: int = 4
    similar: Similarity = Similarity(85, 100)
    chunk: int = 1024  # sets that share a prefix hash and are indexed together
    budget: int = 1 << 19  # hashes that are compared with each other at once
    broadcast: int = 1_000_000  # keys of documents that are broadcast, at most

    def prefix(self, hashes: np.ndarray, frequent: np.ndarray, bits: int) -> np.ndarray:
        """The first of a set's hashes, those of frequent buckets last: a similar set has one of them among its own."""
        order = np.lexsort((hashes, frequent[(hashes >> np.uint64(64 - bits)).astype(np.int64)]))
        return hashes[order[:self.similar.prefix(len(hashes)) if len(hashes) else 0]].view(np.int64)


def ngrams(text: bytes, words: int) -> np.ndarray:
    """The distinct hashes of a text's n-grams, ascending. A-Z are lower-cased; ASCII blanks separate words."""
    w = text.lower().split()
    if not w:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    size = min(words, len(w))
    count = len(w) - size + 1
    mixed = np.full(count, size, np.uint64)
    for k in range(size):
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + own[k:k + count]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def _bytes(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def bucket_bits(docs: DataFrame) -> int:
    return min(MOST, max(FEWEST, (docs.count() // 4).bit_length()))


def bucket_counts(docs: DataFrame, text: str, words: int, bits: int) -> np.ndarray:
    """In how many documents the hashes of each bucket are; over all documents, with 2^bits numbers from each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for b in batches:
            for t in b.column("t"):
                total += np.bincount((ngrams(t.as_py(), words) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    # Bounded: at most 2^bits rows.
    found = docs.select(_bytes(F.col(text)).alias("t")).mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << bits, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def described(docs: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """Key, row hash, size ``n``, two hashes of the set, its prefix ``first`` and its counts ``cells`` for each document."""
    bits = bucket_bits(docs)
    counts = docs.sparkSession.sparkContext.broadcast(bucket_counts(docs, text, join.words, bits))
    narrow = docs.select(F.col(f"`{key}`").alias("id"), row_key(docs).alias("row"), _bytes(F.col(f"`{text}`")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, first, cells = [], [], []
            for t in b.column("t"):
                h = ngrams(t.as_py(), join.words)
                whole = xxhash.xxh3_128_digest(h.tobytes())
                rows.append((len(h), *np.frombuffer(whole, np.int64).tolist()))
                first.append(join.prefix(h, counts.value, bits))
                cells.append(cells_of(h))
            sizes = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("row"), *sizes, pa.array(first, pa.list_(pa.int64())), pa.array(cells, pa.binary())],
                names=["id", "row", "n", "k1", "k2", "first", "cells"],
            )

    kind = narrow.schema["id"].dataType.simpleString()
    return map_arrow(narrow, run, f"id {kind}, row bigint, n bigint, k1 bigint, k2 bigint, first array<bigint>, cells binary")


def with_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """``wanted`` (node, one: the id and hash of a row, and others) with the set ``h`` of that row, worked out again from its text."""
    wanted = stored(wanted.withColumn("row", F.col("one.row")))
    few = wanted.count() <= join.broadcast
    own = docs.select(F.col(f"`{key}`").alias("own"), row_key(docs).alias("row"), _bytes(F.col(f"`{text}`")).alias("t"))
    met = own.join(F.broadcast(wanted) if few else wanted, "row").filter(F.col("own").eqNullSafe(F.col("one.id")))
    kept = [f for f in wanted.schema if f.name not in ("one", "row")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()  # a row that repeats gives its set once in a task
        for b in batches:
            keys = list(zip(*[b.column(f.name).to_pylist() for f in kept]))
            new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
            for at in range(0, len(new), ARROW_ROWS):
                part = b.take(pa.array(new[at:at + ARROW_ROWS]))
                found = [ngrams(t.as_py(), join.words).view(np.int64) for t in part.column("t")]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(f.name) for f in kept], pa.array(found, pa.list_(pa.int64()))], names=[*[f.name for f in kept], "h"]
                )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "h array<bigint>"])
    return met.select(*[f.name for f in kept], "t").mapInArrow(run, schema)


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """Key, number of n-grams and component of every document."""
    light = stored(described(docs, key, text, join))
    same = light.filter("n > 0").groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("times"), F.min("id").alias("least"), F.min(F.struct("row", "id")).alias("one"),
        *[F.first(c).alias(c) for c in ("n", "first", "cells")],
    )
    texts = stored(same.withColumn("node", F.monotonically_increasing_id()).withColumn("label", F.col("node")))
    clusters = components(prefix_forest(texts, join.similar, join.chunk))
    clustered = stored(clusters.join(texts.select("node", "n", "one"), "node").select(F.col("root").alias("cluster"), "node", "n", "one"))
    classes = components(exact_links(clustered, lambda rows: with_sets(docs, rows, key, text, join), join.similar, join.budget))
    named = texts.join(classes, "node", "left").select("k1", "k2", "times", "least", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("times"))
    known = join_counted(named.drop("times"), least, ["root"]).drop("times").join(texts.select("k1", "k2", "times"), ["k1", "k2"])
    linked = join_counted(light.filter("n > 0").select("id", "n", "k1", "k2"), known.select("k1", "k2", "component_id", "times"), ["k1", "k2"])
    alone = light.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return linked.select("id", "n", "component_id").unionByName(alone).select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents"))


#: All links between documents that share an n-gram; what is reachable grows until nothing is added.
SQL = """
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), LAMBDA x: x <> '') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS gram
  FROM words),
sizes AS (SELECT r, count(*) AS n FROM grams GROUP BY r),
shared AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM grams a JOIN grams b ON a.gram = b.gram AND a.r <> b.r GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes s ON s.r = x JOIN sizes t ON t.r = y WHERE 100 * common >= 85 * (s.n + t.n - common)),
reached AS (SELECT r, r AS other FROM words UNION SELECT reached.r, y FROM reached JOIN links ON x = other)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM words w LEFT JOIN sizes s ON s.r = w.r
JOIN (SELECT reached.r, min(o.doc_id) AS component_id FROM reached JOIN words o ON o.r = other GROUP BY reached.r) c ON c.r = w.r
"""

"""Substring deduplication by factoring documents against blocks of all documents.

Every document is parsed relative to a reference: all documents, cut into content-defined blocks. A
window of ``window`` words is anchored at the smallest hash of its ``gram``-word runs. Equal windows
have equal anchors, so windows with one anchor form a block (at most ``2 window - gram`` words), and
the index of all blocks, by anchor and by content, tells a parser what else holds them:

* an anchor that occurs once: none of its windows occurs elsewhere;
* a block that occurs twice or more: all its windows do, and the whole block is a factor;
  blocks in a row join to one long factor;
* an anchor that occurs elsewhere within other words: a factor begins or ends here. These boundaries
  are checked window by window, against all other occurrences of the anchor.

Words covered by a factor of at least ``window`` words are removed, wherever the other copy is. Both copies go,
as each is repeated; the result does not depend on order. Hashes are 128 bits wide (two 64-bit
polynomials), so equal hashes stand for equal words.

Only counts, never lists of occurrences, are gathered per anchor, block or window, so a passage that a third
of the documents share is counted by partial sums, and its rows are dealt into parts to get the counts back. Texts are shuffled once; those with a boundary
are kept compressed in a table of the shared folder.

Defined results: a null or empty text has no words; a text shorter than the window keeps all. Rows with
a null id are rows like any other, and repeated rows are copies of each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import join_counted, map_arrow, stored, table

WINDOW = 35
GRAM = 8
COUNT_BITS = 20  # for the number of windows of a block
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they can be inverted modulo 2**64

_EMPTY = hashlib.sha256(b"").hexdigest()
_NO_ID = -(1 << 63)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class Polynomial:
    """Hashes of any run of words, from prefix sums."""

    def __init__(self, hashes: np.ndarray, base: int):
        n = len(hashes) + 1
        self.down = _powers(pow(base, -1, 1 << 64), n)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(hashes * _powers(base, n)[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def blocks(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(anchor hash, block hash, first window, number of windows) of each block of a document."""
    n, gram = len(hashes), min(gram, window)
    if n < window:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    one, two = (Polynomial(hashes, b) for b in BASES)
    at = np.arange(n - gram + 1)
    grams = one.of(at, at + gram)
    span = window - gram + 1
    anchors = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(n - window + 1)
    cuts = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1, [len(anchors)]])
    first, count = cuts[:-1], np.diff(cuts)
    anchor = anchors[first]
    inside = two.of(first, first + count - 1 + window)
    place = ((anchor - first) * (1 << COUNT_BITS) + count).astype(np.uint64)
    return grams[anchor], _mix(inside + place * np.uint64(0xD6E8FEB86659FD93)), first, count


def _index(window: int):
    """The blocks of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, sizes = [], []
            for text in b.column("text"):
                parts = blocks(_hashes(text.as_py().split()), window)
                found.append(parts)
                sizes.append(len(parts[0]))
            columns = [np.concatenate([f[i] for f in found]) for i in range(4)] if found else [np.empty(0, np.int64)] * 4
            ids = [np.repeat(b.column(c).to_numpy(zero_copy_only=False), sizes) for c in ("d", "t")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in (columns[0].view(np.int64), columns[1].view(np.int64), *ids)]
                + [pa.array(columns[2].astype(np.int32)), pa.array(columns[3].astype(np.int32))],
                names=["anchor", "block", "d", "t", "first", "n"],
            )

    return run


def _covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps)[:-1] > 0


def _kept(words: list[bytes], covered: np.ndarray) -> tuple[int, int, str]:
    removed = int(covered.sum())
    left = words if not removed else [w for w, c in zip(words, covered.tolist()) if not c]
    return len(words), removed, hashlib.sha256(b" ".join(left)).hexdigest()


def _parts(marks: np.ndarray) -> tuple[np.ndarray, ...]:
    """first, n, whether the block is a factor, whether its windows are to be checked."""
    return marks >> (COUNT_BITS + 2), (marks >> 2) & ((1 << COUNT_BITS) - 1), (marks >> 1) & 1 == 1, marks & 1 == 1


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, for the one shuffle they take."""
    pack = zstandard.ZstdCompressor(level=3)
    for b in batches:
        packed = pa.array([pack.compress(text.as_py()) for text in b.column("text")], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("d"), b.column("t"), packed], names=["d", "t", "packed"])


def _parse(window: int):
    """Results of texts without a boundary; the others as they are, with the hashes of their windows to check."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for d, t, packed, marks in zip(*[b.column(c) for c in ("d", "t", "packed", "marks")]):
                words = unpack.decompress(packed.as_py()).split()
                if not marks.is_valid:
                    rows.append((d.as_py(), t.as_py(), *_kept(words, np.zeros(len(words), bool)), None, None, None, None, None))
                    continue
                first, n, factor, check = _parts(marks.values.to_numpy())
                covered = _covered(len(words), first[factor], first[factor] + n[factor] - 1 + window)
                if not check.any():
                    rows.append((d.as_py(), t.as_py(), *_kept(words, covered), None, None, None, None, None))
                    continue
                hashes = _hashes(words)
                starts = np.concatenate([np.arange(f, f + k) for f, k in zip(first[check], n[check])])
                one, two = (Polynomial(hashes, base).of(starts, starts + window).view(np.int64) for base in BASES)
                rows.append((
                    d.as_py(), t.as_py(), len(words), 0, None, packed.as_py(), np.flatnonzero(covered).astype(np.int32),
                    starts.astype(np.int32), one, two,
                ))
            yield _batch(rows, _PARSED)

    return run


_PARSED = pa.schema([
    ("d", pa.int64()), ("t", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("packed", pa.binary()), ("covered", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())),
    ("one", pa.list_(pa.int64())), ("two", pa.list_(pa.int64())),
])
_RESULT = pa.schema([("d", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _finish(window: int):
    """Results of the texts with boundaries, once their repeated windows are known."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for d, packed, covered, found in zip(*[b.column(c) for c in ("d", "packed", "covered", "found")]):
                words = unpack.decompress(packed.as_py()).split()
                starts = found.values.to_numpy() if found.is_valid else np.empty(0, np.int64)
                mask = _covered(len(words), starts, starts + window)
                mask[covered.values.to_numpy()] = True
                rows.append((d.as_py(), *_kept(words, mask)))
            yield _batch(rows, _RESULT)

    return run


def _marks(docs: DataFrame, window: int) -> DataFrame:
    """(d, t, marks): of each text with a repeated anchor, its factors and what is to be checked."""
    # The number of distinct contents tells apart what needs the second count.
    index = map_arrow(docs, _index(window), "anchor bigint, block bigint, d bigint, t bigint, first int, n int")
    shared = index.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("times"), F.min("block").alias("low"), F.max("block").alias("high")
    ).filter("times > 1").select("anchor", "times", (F.col("low") == F.col("high")).alias("alike"))
    hits = stored(join_counted(index, shared, ["anchor"]).drop("times"))
    mixed = hits.filter("NOT alike")
    place = F.struct("d", "t", "first")
    counts = mixed.groupBy("anchor", "block").agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("model"))
    # Beside blocks that occur once, a repeated block of the same anchor is to be compared window by window.
    open_anchors = counts.groupBy("anchor").agg(F.min("times").alias("least"), F.max("times").alias("most")).filter(
        "least = 1 AND most > 1"
    ).select(F.col("anchor").alias("open"))
    repeated = counts.filter("times > 1").join(open_anchors, F.col("anchor") == F.col("open"), "left")
    judged = join_counted(mixed, repeated, ["anchor", "block"], "left").select(
        "d", "t", "first", "n", F.col("times").isNotNull().alias("factor"),
        # Of equal blocks one stands for all when windows are compared.
        F.coalesce(F.col("times").isNull() | (F.col("open").isNotNull() & (place == F.col("model"))), F.lit(False)).alias("check"),
    )
    factors = hits.filter("alike").select("d", "t", "first", "n", F.lit(True).alias("factor"), F.lit(False).alias("check"))
    mark = (
        F.col("first").cast("bigint") * (1 << COUNT_BITS + 2) + F.col("n") * 4
        + F.col("factor").cast("bigint") * 2 + F.col("check").cast("bigint")
    )
    # Bounded by the length of the text; repeated rows give equal marks.
    return factors.unionByName(judged).groupBy("d", "t").agg(F.collect_set(mark).alias("marks"))


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("d"), F.xxhash64(text).alias("t"),
        text.cast("binary").alias("text"),
    )


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words, one row per row of ``docs``."""
    if not 0 < window < 1 << COUNT_BITS:
        raise ValueError(f"a window has 1 to {(1 << COUNT_BITS) - 1} words, not {window}")
    narrow = _narrow(docs)
    marks = _marks(narrow, window)
    kind = "d bigint, t bigint, n_words bigint, n_removed bigint, kept_sha256 string, packed binary, "
    kind += "covered array<int>, starts array<int>, one array<bigint>, two array<bigint>"
    texts = map_arrow(narrow, _pack, "d bigint, t bigint, packed binary")
    parsed = stored(map_arrow(texts.join(marks, ["d", "t"], "left").select("d", "t", "packed", "marks"), _parse(window), kind))
    open_texts = parsed.filter("packed IS NOT NULL")
    windows = open_texts.select("d", "t", F.explode(F.arrays_zip("starts", "one", "two")).alias("w")).select(
        "d", "t", "w.starts", "w.one", "w.two"
    )
    repeated = windows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    found = join_counted(windows, repeated, ["one", "two"]).groupBy("d", "t").agg(F.collect_set("starts").alias("found"))
    finished = map_arrow(
        open_texts.select("d", "t", "packed", "covered").join(found, ["d", "t"], "left").select("d", "packed", "covered", "found"),
        _finish(window), "d bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    )
    done = parsed.filter("packed IS NULL").select("d", "n_words", "n_removed", "kept_sha256").unionByName(finished)
    return done.select(F.nullif(F.col("d"), F.lit(_NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))

"""Links between similar sets, found without listing pairs.

Two steps, both of which emit no more links than a group has members (small groups: a few times as many), whatever the number of similar pairs:

* ``prefix_forest`` groups sets by the shingles of their prefixes and joins, within a group, those whose upper bound of the
  overlap allows the similarity. The bound comes from counts: hashes are counted in ``CELLS`` groups, and two sets share at most the
  sum of the lesser counts. A group's counts are points of an R-tree, whose boxes are compared before the points are. What comes out are
  tentative links, a spanning forest for each group: every pair that may be similar ends up in one cluster.
* ``exact_links`` compares whole sets within the clusters that tentative links make, and emits a spanning forest of the links that hold.
  Large clusters are first compared with a few of their own sets; what these join need not meet again, and the rest is cut into
  chunks of bounded size that are compared two by two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import join_counted, stored
from ferrytally.llm.components import components

CELLS = 128
FINE = 1024  # cells of sets with more than LONG hashes: a few counts say little about many hashes
LONG = 2048
LEAF = 16  # points of a leaf; groups up to this size are not indexed


@dataclass(frozen=True)
class Similarity:
    """The least Jaccard similarity as a fraction, so that sets on the cut are judged exactly."""

    num: int
    den: int

    def holds(self, overlap, both):
        """``overlap`` is what two sets share, ``both`` the sum of their sizes."""
        return (self.num + self.den) * overlap >= self.num * both

    def sizes_allow(self, small, large):
        return self.den * small >= self.num * large

    def prefix(self, size: int) -> int:
        """How many first hashes, in any common order, two similar sets cannot all differ in."""
        return size - -(-self.num * size // self.den) + 1


def cells_of(hashes: np.ndarray) -> bytes:
    """How many hashes fall in each cell; a byte for each if all fit, else four."""
    cells = FINE if len(hashes) > LONG else CELLS
    counts = np.bincount((hashes & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return counts.astype(np.uint8 if counts.max() < 256 else "<u4").tobytes()


def _counts(cells: bytes) -> np.ndarray:
    return np.frombuffer(cells, np.uint8 if len(cells) in (CELLS, FINE) else "<u4").astype(np.int64)


@dataclass(frozen=True)
class Points:
    """Count vectors of many sets: all with few cells, and long ones also with many."""

    few: np.ndarray
    many: np.ndarray
    row: np.ndarray  # of ``many``, for each set; -1 for short ones

    @staticmethod
    def of(cells: pa.Array) -> Points:
        lengths = pc.binary_length(cells).to_numpy()
        if (lengths == CELLS).all():
            return Points(np.frombuffer(b"".join(cells.to_pylist()), np.uint8).reshape(-1, CELLS), np.empty((0, FINE), np.int64), np.full(len(cells), -1))
        counts = [_counts(c) for c in cells.to_pylist()]
        long = np.array([len(c) == FINE for c in counts])
        # A cell of the few is what its cells of the many add up to.
        few = np.stack([c.reshape(-1, CELLS).sum(axis=0) for c in counts])
        return Points(few, np.stack([c for c in counts if len(c) == FINE] or [np.empty(FINE)])[:long.sum()].astype(np.int64), np.where(long, np.cumsum(long) - 1, -1))

    def part(self, own: slice) -> Points:
        return Points(self.few[own], self.many, self.row[own])

    def may(self, x: np.ndarray, y: np.ndarray, n: np.ndarray, similar: Similarity) -> np.ndarray:
        """Whether the counts of the sets ``x`` and ``y`` (positions, pairwise) allow the similarity."""
        both = n[x] + n[y]
        good = similar.holds(np.minimum(self.few[x], self.few[y]).sum(axis=1, dtype=np.int64), both)
        at = np.flatnonzero(good & (self.row[x] >= 0) & (self.row[y] >= 0))
        if len(at):
            good[at] = similar.holds(np.minimum(self.many[self.row[x[at]]], self.many[self.row[y[at]]]).sum(axis=1), both[at])
        return good


def by_group(keys: list[str], links: Callable[[pa.RecordBatch, np.ndarray], Iterator[pa.RecordBatch]]):
    """For ``mapInArrow`` over rows sorted by ``keys``: ``links`` gets whole groups, and where they begin and end."""
    def key_rows(b: pa.RecordBatch) -> np.ndarray:
        return np.stack([b.column(k).to_numpy() for k in keys], axis=1)

    def whole(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            if not b.num_rows:
                continue
            rows = key_rows(b)
            cuts = np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1
            if not len(cuts) and (last is None or (rows[0] == last).all()):
                held, last = [*held, b], rows[-1]
                continue
            # The last group may go on in the next batch.
            cut = int(cuts[-1]) if len(cuts) else 0
            ready = whole([*held, b.slice(0, cut)]) if held or cut else None
            if ready is not None and ready.num_rows:
                done = key_rows(ready)
                yield from links(ready, np.concatenate([[0], np.flatnonzero((done[1:] != done[:-1]).any(axis=1)) + 1, [len(done)]]))
            held, last = [b.slice(cut)], rows[-1]
        if held:
            ready = whole(held)
            yield from links(ready, np.array([0, ready.num_rows]))

    return run


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def tree_forest(n: np.ndarray, points: Points, label: np.ndarray, similar: Similarity) -> list[tuple[int, int]]:
    """A spanning forest of the points whose counts allow the similarity; equal labels are joined already.

    The points are packed into the leaves of an R-tree by size and, among equal sizes, by the cell that varies most. A leaf's
    box is the largest count in each cell and its least and greatest size.
    """
    joined = np.unique(label, return_inverse=True)[1]
    cells = points.few
    order = np.lexsort((cells[:, np.argmax(cells.var(axis=0))], n))
    leaves = [order[i:i + LEAF] for i in range(0, len(order), LEAF)]
    box = np.stack([cells[leaf].max(axis=0) for leaf in leaves]).astype(np.int64)
    low, high = np.array([n[leaf[0]] for leaf in leaves]), np.array([n[leaf[-1]] for leaf in leaves])
    links: list[tuple[int, int]] = []
    for i, leaf in enumerate(leaves):
        after = np.arange(i, len(leaves))
        most = np.minimum(box[i], box[after]).sum(axis=1)
        # Leaves ascend in size.
        for j in after[similar.holds(most, low[i] + low[after]) & similar.sizes_allow(high[i], low[after])]:
            other = leaves[j]
            apart = joined[leaf][:, None] != joined[other][None]
            x, y = (v[rows] for v, rows in zip((leaf, other), np.nonzero(apart)))
            x, y = (v[similar.sizes_allow(np.minimum(n[x], n[y]), np.maximum(n[x], n[y]))] for v in (x, y))
            if not len(x):
                continue
            may = points.may(x, y, n, similar)
            for a, b in zip(x[may].tolist(), y[may].tolist()):
                if joined[a] != joined[b]:
                    links.append((a, b))
                    joined[joined == joined[b]] = joined[a]
    return links


def _tentative(similar: Similarity):
    def links(b: pa.RecordBatch, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        n, at, node, label = (b.column(c).to_numpy() for c in ("n", "at", "node", "label"))
        points = Points.of(b.column("cells"))
        sizes = np.diff(cuts)
        small = np.repeat(sizes <= LEAF, sizes)
        ends = np.repeat(cuts[1:], sizes)
        left = np.flatnonzero(small)
        for step in range(1, LEAF):
            left = left[left + step < ends[left]]
            if not len(left):
                break
            # Sizes ascend within a group.
            near = left[similar.sizes_allow(n[left], n[left + step]) & (label[left] != label[left + step])]
            x, y = near, near + step
            ahead = np.minimum(at[x], at[y]) + np.minimum(n[x] - at[x], n[y] - at[y])
            x, y = (v[similar.holds(ahead, n[x] + n[y])] for v in (x, y))
            may = points.may(x, y, n, similar)
            if may.any():
                yield _edges(node[x[may]], node[y[may]])
        for g in np.flatnonzero(sizes > LEAF):
            own = slice(int(cuts[g]), int(cuts[g + 1]))
            found = np.array(tree_forest(n[own], points.part(own), label[own], similar), np.int64).reshape(-1, 2) + cuts[g]
            if len(found):
                yield _edges(node[found[:, 0]], node[found[:, 1]])

    return by_group(["h", "i", "j"], links)


def prefix_forest(texts: DataFrame, similar: Similarity, chunk: int) -> DataFrame:
    """Tentative links (a, b) between the sets ``texts`` (node, label, n, first, cells): prefix hashes and counts of each.

    Every pair of different labels that is similar is joined by a path of links and labels. A hash with many sets is cut into chunks, and each
    pair of chunks is a group of its own.
    """
    placed = texts.select("node", "label", "n", F.posexplode("first").alias("at", "h"))
    # Only hashes of several labels can join any.
    shared = placed.groupBy("h").agg(
        F.count(F.lit(1)).alias("times"), F.min("label").alias("lo"), F.max("label").alias("hi")
    ).filter("lo <> hi").select("h", "times")
    chunks = F.ceil(F.col("times") / F.lit(chunk)).cast("bigint")
    members = join_counted(placed, shared, ["h"]).join(texts.select("node", "cells"), "node").select(
        "h", "node", "label", "n", F.col("at").cast("bigint").alias("at"), "cells",
        chunks.alias("c"), F.pmod(F.xxhash64("node", "h"), chunks).alias("own"),
    )
    dealt = members.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c") - 1))).select(
        "h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "label", "n", "at", "cells"
    )
    grouped = dealt.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "n", "node")
    return grouped.mapInArrow(_tentative(similar), "a bigint, b bigint").distinct()


def set_forest(sets: list[np.ndarray], label: np.ndarray, similar: Similarity) -> list[tuple[int, int]]:
    """A spanning forest of the links that hold between whole sets; sets of equal labels are joined already."""
    sizes = np.array([len(s) for s in sets])
    _, own = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    marked = np.zeros(int(own.max()) + 1, bool)
    left = np.ones(len(sets), bool)
    links: list[tuple[int, int]] = []
    for seed in range(len(sets)):
        if not left[seed]:
            continue
        left[seed], queue = False, [seed]
        while queue:
            at = queue.pop()
            alike = np.flatnonzero(left & (label == label[at]))
            left[alike] = False
            queue.extend(alike.tolist())
            if not left.any():
                break
            tokens = own[starts[at]:starts[at] + sizes[at]]
            marked[tokens] = True
            shared = np.add.reduceat(marked[own], starts, dtype=np.int64)
            marked[tokens] = False
            found = np.flatnonzero(left & similar.holds(shared, sizes + sizes[at]))
            left[found] = False
            links.extend((at, int(x)) for x in found)
            queue.extend(found.tolist())
    return links


def _verified(similar: Similarity):
    def links(b: pa.RecordBatch, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, label = b.column("node").to_numpy(), b.column("label").to_numpy()
        hashes, out = b.column("h"), []
        ends = hashes.offsets.to_numpy()
        flat = hashes.values.to_numpy()
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            sets = [flat[ends[k]:ends[k + 1]] for k in range(lo, hi)]
            out += [(x + lo, y + lo) for x, y in set_forest(sets, label[lo:hi], similar)]
        if out:
            found = np.array(out)
            yield _edges(node[found[:, 0]], node[found[:, 1]])

    return by_group(["cluster", "i", "j"], links)


PIVOTS = 6  # sets of a large cluster that all its others are compared with


def _pivot_links(large: DataFrame, weights: DataFrame, sets: DataFrame, similar: Similarity) -> DataFrame:
    """Links that hold between the sets of large clusters and a few sets of each, drawn by hash."""
    drawn = [F.min(F.struct(F.xxhash64(F.lit(i), "node").alias("by"), "node"))["node"].alias(f"p{i}") for i in range(PIVOTS)]
    named = large.groupBy("cluster").agg(*drawn).select(
        "cluster", F.explode(F.array_distinct(F.array(*[f"p{i}" for i in range(PIVOTS)]))).alias("node")
    )
    pivots = named.join(sets, "node").groupBy("cluster").agg(F.collect_list(F.struct("node", "h")).alias("pivots"))
    met = join_counted(large.join(sets, "node"), weights.select("cluster", "times").join(pivots, "cluster"), ["cluster"])
    each = met.select("node", "h", F.explode("pivots").alias("pivot")).select(
        F.col("node").alias("a"), F.col("pivot.node").alias("b"), F.size(F.array_intersect("h", "pivot.h")).alias("shared"),
        (F.size("h") + F.size("pivot.h")).alias("both"),
    )
    return each.filter((F.col("a") != F.col("b")) & similar.holds(F.col("shared"), F.col("both"))).select("a", "b")


def exact_links(clustered: DataFrame, with_sets: Callable[[DataFrame], DataFrame], similar: Similarity, budget: int) -> DataFrame:
    """Links (a, b) that hold, enough to join all similar sets of a cluster: ``clustered`` has (cluster, node, n) and what
    ``with_sets`` needs to add the set ``h`` to rows of nodes (which may repeat a row).

    A task compares at most two chunks of about ``budget`` hashes. Clusters of up to that size are one chunk.
    """
    weights = stored(clustered.groupBy("cluster").agg(F.count(F.lit(1)).alias("times"), F.sum("n").alias("weight")))
    large = stored(join_counted(clustered, weights.filter(F.col("weight") > budget), ["cluster"]).drop("times", "weight"))
    small = clustered.join(weights.filter(F.col("weight") <= budget).select("cluster"), "cluster", "left_semi")
    columns = ["cluster", "i", "j", "node", "label", "h"]
    none = F.lit(0).cast("bigint")
    found = _compared(with_sets(small.withColumn("label", F.col("node")).withColumn("i", none).withColumn("j", none)).select(*columns), similar)
    if large.isEmpty():
        return stored(found)
    sets = stored(with_sets(large).select("node", "h").dropDuplicates(["node"]))
    first = stored(_pivot_links(large.select("cluster", "node"), weights, sets, similar))
    joined = components(first)
    labelled = stored(large.join(joined, "node", "left").select("cluster", "node", "n", F.coalesce("root", "node").alias("label")))
    rest = _compared(_chunk_pairs(labelled, budget).join(sets, "node").select(*columns), similar)
    return stored(found.unionByName(first).unionByName(rest))


def _compared(placed: DataFrame, similar: Similarity) -> DataFrame:
    grouped = placed.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return grouped.mapInArrow(_verified(similar), "a bigint, b bigint").filter("a <> b")


def _chunk_pairs(labelled: DataFrame, budget: int) -> DataFrame:
    """Rows (cluster, i, j, node, label): every set with each pair of chunks that it takes part in.

    Labels with much weight have chunks of their own, which do not meet each other; all else of a cluster shares chunks.
    """
    by_label = labelled.groupBy("cluster", "label").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("times"))
    pure = F.col("w") > budget
    kinds = by_label.select("cluster", "label", "w", "times", pure.alias("pure"))
    rest = kinds.filter(~F.col("pure")).groupBy("cluster").agg(F.sum("w").alias("w")).select("cluster", F.col("w").alias("rest"))
    parts = stored(kinds.join(rest, "cluster", "left").select(
        "cluster", "label", "times", "pure", F.ceil(F.when(F.col("pure"), F.col("w")).otherwise(F.col("rest")) / F.lit(budget)).cast("bigint").alias("parts"),
    ))
    owner = F.when(F.col("pure"), F.col("label"))
    every = parts.select("cluster", "pure", owner.alias("owner"), "parts").distinct().select(
        "cluster", "pure", "owner", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    ).select("cluster", "pure", "owner", F.xxhash64("owner", "part").alias("chunk"))
    # One row for each chunk, not for each set, meets its like.
    a, b = (every.select("cluster", *[F.col(c).alias(f"{c}_{x}") for c in ("pure", "owner", "chunk")]) for x in "ij")
    same = F.col("owner_i").eqNullSafe(F.col("owner_j")) & F.col("pure_i")
    pairs = a.join(b, "cluster").filter((F.col("chunk_i") <= F.col("chunk_j")) & ~same).select(
        "cluster", F.col("chunk_i").alias("i"), F.col("chunk_j").alias("j")
    )
    # A pair is a row for each of its chunks.
    sides = pairs.select("cluster", F.explode(F.array_distinct(F.array("i", "j"))).alias("chunk"), "i", "j")
    own = join_counted(labelled, parts, ["cluster", "label"]).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts"))).select(
        "cluster", "node", "label", F.xxhash64(owner, "part").alias("chunk")
    )
    return own.join(sides, ["cluster", "chunk"])

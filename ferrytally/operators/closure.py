"""Reachability within the connected parts of a graph, each worked out in one task.

Parts are found on hashes of the nodes: two nodes with one hash can only make two parts one, which changes nothing. Every task
first joins the edges that it reads, a chunk at a time; what is left are links between the parts of chunks, of which there are few where
edges that belong together stand together, and which Spark joins (``components``).

Within a part the nodes are numbered and what each reaches is a set of bits, so no pair is ever stored or exchanged.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.operators.components import components
from ferrytally.operators.numbering import BROADCAST_KEYS
from ferrytally.session import shuffle_width, stored

# Python workers get this module's functions with the job, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 1 << 18  # edges that are joined at once where they are read
TASK_EDGES = 100_000  # edges of small parts in a task, about
PAIRS = 1 << 20  # pairs that are handed over at once, about
LABEL = "__label"


def joined_roots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each edge the smallest node of all that it is connected to."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(nodes)))
    for x, y in zip(at[:len(a)].tolist(), at[len(a):].tolist()):
        while up[x] != x:
            up[x] = x = up[up[x]]
        while up[y] != y:
            up[y] = y = up[up[y]]
        if x < y:
            up[y] = x
        else:
            up[x] = y
    for i, x in enumerate(up):  # the smaller ones are settled
        up[i] = up[x]
    return nodes[np.array(up, np.int64)[at[:len(a)]]]


def _node(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.xxhash64(name))


def _sized(df: DataFrame) -> DataFrame:
    """A stored frame as the side of a join: broadcast only if it is known to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df.hint("merge")


def labelled(edges: DataFrame) -> DataFrame:
    """``edges`` (output_id, source_id), stored, with the part that each belongs to. An end that is null joins nothing."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= CHUNK:
                yield from rooted(held)
                held, rows = [], 0
        yield from rooted(held)

    def rooted(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not sum(b.num_rows for b in held):
            return
        a, b = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("__a", "__b"))
        roots = joined_roots(a, b)
        at = 0
        for x in held:
            yield pa.RecordBatch.from_arrays(
                [x.column("output_id"), x.column("source_id"), pa.array(roots[at:at + x.num_rows])], names=["output_id", "source_id", "__local"]
            )
            at += x.num_rows

    none = F.lit(0).cast("bigint")
    ends = edges.select(
        "output_id", "source_id", F.coalesce(_node("output_id"), _node("source_id"), none).alias("__a"),
        F.coalesce(_node("source_id"), _node("output_id"), none).alias("__b"),
    )
    schema = T.StructType([*edges.select("output_id", "source_id").schema.fields, T.StructField("__local", T.LongType())])
    known = stored(ends.mapInArrow(join, schema))
    # Nodes of several chunks' parts link these.
    placed = known.select(F.explode(F.array(_node("output_id"), _node("source_id"))).alias("node"), "__local").filter("node IS NOT NULL")
    shared = stored(placed.groupBy("node").agg(F.min("__local").alias("lo"), F.max("__local").alias("hi")).filter("lo < hi").select("node", "lo"))
    links = placed.join(_sized(shared), "node").select(F.col("lo").alias("a"), F.col("__local").alias("b"))
    if shared.isEmpty():
        return known.withColumnRenamed("__local", LABEL)
    roots = stored(components(links)).select(F.col("node").alias("__local"), "root")
    return known.join(_sized(roots), "__local", "left").select("output_id", "source_id", F.coalesce("root", "__local").alias(LABEL))


def split_parts(edges: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None, int]:
    """The labelled edges of parts of up to ``most`` edges without nulls; those of the others, if there are any; the number of all edges."""
    null = F.col("output_id").isNull() | F.col("source_id").isNull()
    parts = edges.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"), F.bool_or(null).alias("null"))
    sizes = stored(parts.groupBy((F.col("null") | (F.col("n") > most)).alias("other"), F.when(
        F.col("null") | (F.col("n") > most), F.col(LABEL)
    ).alias(LABEL)).agg(F.sum("n").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    others = sizes.filter("other").select(LABEL)
    if others.isEmpty():
        return edges, None, total
    side = _sized(others)
    return edges.join(side, LABEL, "left_anti"), edges.join(side, LABEL, "left_semi"), total


def reached(steps: list[list[int]]) -> list[int]:
    """For each node the nodes that it reaches, as bits. Strongly connected nodes are taken together, the last ones first (Tarjan)."""
    count = len(steps)
    number, low, group, bits = [0] * count, [0] * count, [-1] * count, [0] * count
    stack: list[int] = []
    seen = 0
    for start in range(count):
        if number[start]:
            continue
        seen += 1
        number[start] = low[start] = seen
        stack.append(start)
        path = [(start, iter(steps[start]))]
        while path:
            node, rest = path[-1]
            for to in rest:
                if not number[to]:
                    seen += 1
                    number[to] = low[to] = seen
                    stack.append(to)
                    path.append((to, iter(steps[to])))
                    break
                if group[to] < 0 and number[to] < low[node]:
                    low[node] = number[to]
            else:
                path.pop()
                if path and low[node] < low[path[-1][0]]:
                    low[path[-1][0]] = low[node]
                if low[node] == number[node]:
                    at = len(stack) - 1
                    while stack[at] != node:
                        at -= 1
                    members = stack[at:]
                    del stack[at:]
                    for x in members:
                        group[x] = node
                    found = 0
                    for x in members:
                        for to in steps[x]:
                            found |= 1 << to | (bits[to] if group[to] != node else 0)
                    for x in members:
                        bits[x] = found
    return bits


def within(steps: list[list[int]], hops: int) -> list[int]:
    """The same in at most ``hops`` steps."""
    if hops < 1:
        return [0] * len(steps)
    if hops >= len(steps):
        return reached(steps)
    one = [0] * len(steps)
    for x, following in enumerate(steps):
        for to in following:
            one[x] |= 1 << to
    bits = one
    for _ in range(hops - 1):
        more = one[:]
        for x, following in enumerate(steps):
            for to in following:
                more[x] |= bits[to]
        if more == bits:
            break
        bits = more
    return bits


def part_pairs(outputs: np.ndarray, sources: np.ndarray, hops: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the edges of one part: nodes, how many each reaches, and all of these one after another."""
    nodes, at = np.unique(np.concatenate([outputs, sources]), return_inverse=True)
    steps: list[list[int]] = [[] for _ in nodes]
    for x, y in zip(at[:len(outputs)].tolist(), at[len(outputs):].tolist()):
        steps[x].append(y)
    bits = reached(steps) if hops is None else within(steps, hops)
    starts = [x for x, following in enumerate(steps) if following]
    width, rows = (len(nodes) + 7) // 8, max(1, 4 * PAIRS // len(nodes))
    for i in range(0, len(starts), rows):
        block = starts[i:i + rows]
        packed = np.frombuffer(b"".join(bits[x].to_bytes(width, "little") for x in block), np.uint8).reshape(-1, width)
        row, to = np.nonzero(np.unpackbits(packed, axis=1, count=len(nodes), bitorder="little"))
        yield nodes[block], np.bincount(row, minlength=len(block)), nodes[to]


def closed_parts(edges: DataFrame, total: int, hops: int | None) -> DataFrame:
    """All pairs of the labelled edges, whose parts are small; ``total`` is about the number of edges."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            label = b.column(LABEL).to_numpy()
            # The last part may go on in the next batch.
            cuts = np.flatnonzero(label[1:] != label[:-1])
            if held and held[-1].column(LABEL)[-1].as_py() != label[0]:
                yield held
                held = []
            cut = int(cuts[-1]) + 1 if len(cuts) else 0
            if cut:
                yield [*held, b.slice(0, cut)]
                held = []
            held.append(b.slice(cut))
        if held:
            yield held

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in whole(batches):
            label = np.concatenate([b.column(LABEL).to_numpy() for b in part])
            ids = pa.concat_arrays([b.column(c) for c in ("output_id", "source_id") for b in part]).dictionary_encode()
            code, names = ids.indices.to_numpy(), ids.dictionary
            cuts = np.concatenate([[0], np.flatnonzero(label[1:] != label[:-1]) + 1, [len(label)]]).tolist()
            outputs, counts, sources, pairs = [], [], [], 0
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                for output, count, source in part_pairs(code[lo:hi], code[len(label) + lo:len(label) + hi], hops):
                    outputs.append(output)
                    counts.append(count)
                    sources.append(source)
                    pairs += len(source)
                    if pairs >= PAIRS:
                        yield batch(names, outputs, counts, sources)
                        outputs, counts, sources, pairs = [], [], [], 0
            if outputs:
                yield batch(names, outputs, counts, sources)

    def batch(names: pa.Array, outputs: list, counts: list, sources: list) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), names.take(pa.array(np.concatenate(sources))))
        return pa.RecordBatch.from_arrays([names.take(pa.array(np.concatenate(outputs))), lists], names=["output_id", "__sources"])

    kinds = {f.name: f.dataType for f in edges.schema}
    schema = T.StructType([T.StructField("output_id", kinds["output_id"]), T.StructField("__sources", T.ArrayType(kinds["source_id"]))])
    dealt = edges.select("output_id", "source_id", LABEL).repartition(shuffle_width(edges, total, TASK_EDGES), LABEL).sortWithinPartitions(LABEL)
    return dealt.mapInArrow(close, schema).select("output_id", F.explode("__sources").alias("source_id"))

"""The prefix trie of conversations, with subtree figures from an Euler tour.

Every conversation is rebuilt: it begins with the first turns of the conversation that opens its hundred, as many as a hash of its id
says, and goes on with its own later ones. Each distinct beginning is a node. A beginning is known by the sum of one hash for
each of its turns, place included, twice with 64 bits, so that beginnings are running sums and no conversation has to meet in one task.

Subtree figures come from the Euler tour. A node has an entering and a leaving arc, and every arc's successor is known locally: from a
node into its first child or, without children, out of it again; out of a child into the next one; out of the last one out of the
parent. The tour is a linked list, which is ranked in three steps:

* links of one block (of conversations and depths next to each other, a bounded number) are chained within the block, so that the list
  shrinks to the paths between blocks;
* while there are more paths than a task takes, a share of them, drawn by hash, become rulers; pointers jump until they
  meet a ruler, which takes a number of rounds that grows with the logarithm of the gaps, and the rulers alone go on;
* what is left, at most ``BLOCK`` paths, is ranked in one task.

Sorted by rank, running sums over the tour give each subtree: the sum at the leaving arc less the sum before the entering one.

Defined results: rows without a conv_id belong to no conversation. Turns are ordered by ``turn``, null first, equal ones by the hashes of their role
and text; repeated rows are turns of their own. Null roles and texts are empty. An empty table has no node, not even the root. Two different
beginnings would be taken for one only if 128 bits of hash agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import join_counted, stored, table
from ferrytally.llm.scan import scanned
from ferrytally.session import materialise

#: Conversations of a hundred share up to five turns of its first one.
FAMILY = 100
SHARES = 6

BLOCK = 1 << 17  # paths that one task ranks
CONVERSATIONS, DEPTHS = 7, 10  # powers of two: a block has so many conversations and depths
RULERS = 8  # one path in so many is a ruler
IDS = 8192  # ids in a piece of text
EMPTY = hashlib.sha256(b"").hexdigest()


def turns_of(conversations: DataFrame) -> DataFrame:
    """Two hashes and the length of each turn, placed within its conversation."""
    role, text = (F.coalesce(F.col(f"`{n}`").cast("string"), F.lit("")) for n in ("role", "text"))
    narrow = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("c"), F.col("turn"),
        F.xxhash64(F.lit(1), role, text).alias("h1"), F.xxhash64(F.lit(2), role, text).alias("h2"),
        F.char_length(text).cast("bigint").alias("tokens"),
    )
    return scanned(narrow, ["c"], ["turn", "h1", "h2"], []).select("c", "place", "h1", "h2", "tokens")


def rebuilt(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(c, at, h1, h2, tokens): the turns of every rebuilt conversation. ``convs`` has (c, n): the number of original turns."""
    base = F.col("c") - F.col("c") % FAMILY
    share = F.crc32(F.col("c").cast("string").cast("binary")) % SHARES
    known = convs.select("c", "n", base.alias("b"), share.alias("h"))
    first = convs.select(F.col("c").alias("b"), F.col("n").alias("nb"))
    plan = stored(known.join(first, "b", "left").select(
        "c", "b", "h", F.least("h", F.coalesce("nb", F.lit(0))).alias("k"), F.col("n").alias("times")
    ))
    own = join_counted(turns, plan.select("c", "h", "k", "times"), ["c"]).filter("place > h").select(
        "c", (F.col("k") + F.col("place") - F.col("h")).alias("at"), "h1", "h2", "tokens"
    )
    opening = turns.filter((F.col("c") % FAMILY == 0) & (F.col("place") < SHARES)).withColumnRenamed("c", "b")
    # A hundred conversations (199 around zero) and five turns meet at most.
    lead = opening.join(plan.select("c", "b", "k"), "b").filter("place <= k").select("c", F.col("place").alias("at"), "h1", "h2", "tokens")
    return own.unionByName(lead)


def beginnings(turns: DataFrame) -> DataFrame:
    """(c, depth, a, b, pa, pb, tokens): the two sums of each beginning of a conversation and of the one a turn shorter."""
    placed = [F.xxhash64(F.lit(i), "h1", "h2", "at").alias(n) for i, n in ((1, "a"), (2, "b"))]
    return scanned(turns.select("c", "at", "tokens", *placed), ["c"], ["at"], ["a", "b"]).select(
        "c", F.col("at").alias("depth"), F.col("upto_a").alias("a"), F.col("upto_b").alias("b"),
        F.col("before_a").alias("pa"), F.col("before_b").alias("pb"), "tokens",
    )


def grown(begun: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes with their parents and children, numbered so that siblings follow each other by conv_id."""
    root = convs.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    nodes = stored(begun.groupBy("depth", "a", "b").agg(
        F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("tokens").alias("tokens"),
        F.min("pa").alias("pa"), F.min("pb").alias("pb"),
    ).unionByName(root.select("conv_id", "n_convs", *[zero.alias(n) for n in ("depth", "a", "b", "tokens", "pa", "pb")])))
    above = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("pd"), "pa", "pb").agg(F.count(F.lit(1)).alias("times"))
    parents = nodes.select(
        F.col("depth").alias("pd"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent")
    ).join(above, ["pd", "pa", "pb"])
    children = join_counted(nodes.filter("depth > 0").withColumn("pd", F.col("depth") - 1), parents, ["pd", "pa", "pb"]).drop("times", "pd")
    rooted = children.unionByName(nodes.filter("depth = 0").withColumn("parent", zero))
    numbered = stored(scanned(
        rooted.select("conv_id", "depth", "a", "b", "n_convs", "tokens", "parent"), ["parent", "depth"], ["conv_id"], []
    ))
    families = numbered.filter("depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.min("number").alias("first"), F.max("number").alias("last"), F.count(F.lit(1)).alias("n_children")
    )
    return stored(numbered.join(families, ["conv_id", "depth"], "left").fillna(0, ["n_children"]))


def tour_links(tree: DataFrame) -> DataFrame:
    """(block, arc, next, leaf, saved): the successor of each arc; figures stand on entering arcs. A node's arcs are 2 n and 2 n + 1."""
    enter, leave = 2 * F.col("number"), 2 * F.col("number") + 1
    none, leafless = F.lit(0).cast("bigint"), F.col("n_children") == 0
    saved = (F.col("n_convs") - 1) * F.col("tokens")

    def link(arc: Column, following: Column, leaf: Column = none, saving: Column = none) -> Column:
        return F.struct(arc.alias("arc"), following.alias("next"), leaf.alias("leaf"), saving.alias("saved"))

    links = F.array(
        F.when(leafless, link(enter, leave, F.lit(1).cast("bigint"), saved)).otherwise(link(enter, 2 * F.col("first"), none, saved)),
        F.when(~leafless, link(2 * F.col("last") + 1, leave)),
        F.when(F.col("place") > 1, link(enter - 1, enter)),
        F.when(F.col("depth") == 0, link(leave, F.lit(None).cast("bigint"))),
    )
    block = F.xxhash64(F.shiftright("conv_id", CONVERSATIONS), F.shiftright("depth", DEPTHS))
    return tree.select(block.alias("block"), F.explode(F.array_compact(links)).alias("link")).select("block", "link.*")


def _chained(ids: np.ndarray, following: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For links sorted by id: the position of each chain's last link, the weight from each link to it (itself not counted), the first links, and the successors' positions."""
    at = np.minimum(np.searchsorted(ids, following), len(ids) - 1)
    inside = ids[at] == following
    hop = np.where(inside, at, np.arange(len(ids)))
    ahead = np.where(inside, weights, 0)
    heads = np.ones(len(ids), bool)
    heads[at[inside]] = False
    while True:
        further = hop[hop]
        if (further == hop).all():
            return hop, ahead, np.flatnonzero(heads), at
        ahead, hop = ahead + ahead[hop], further


def _block_paths(links: pa.Table) -> pa.Table:
    """Each arc's path within the block and its place in it; the first arc of a path also has the path's successor and length."""
    links = links.sort_by("arc")
    ids, following = (links.column(n).fill_null(-1).to_numpy() for n in ("arc", "next"))
    last, ahead, heads, _ = _chained(ids, following, np.ones(len(ids), np.int64))
    head_of, length = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    head_of[last[heads]], length[last[heads]] = heads, ahead[heads] + 1
    following = np.where(following < 0, -1, following)[last]
    offset = length[last] - 1 - ahead
    first = offset == 0
    return pa.table({
        "arc": ids, "path": ids[head_of[last]], "offset": offset, "leaf": links.column("leaf"), "saved": links.column("saved"),
        "next": pa.array(following, mask=~first | (following < 0)), "length": pa.array(length[last], mask=~first),
    })


def _block_ranks(paths: pa.Table) -> pa.Table:
    paths = paths.sort_by("id")
    ids, weights = paths.column("id").to_numpy(), paths.column("w").to_numpy()
    last, ahead, _, _ = _chained(ids, paths.column("next").fill_null(-1).to_numpy(), weights)
    return pa.table({"id": ids, "rank": ahead + weights[last]})


def ranked(paths: DataFrame, block: int = BLOCK, level: int = 0) -> DataFrame:
    """(id, rank) of a linked list (id, next, w), whose last next is null: the weight from each id to the end of the list."""
    if paths.count() <= block:
        return paths.withColumn("one", F.lit(1)).groupBy("one").applyInArrow(_block_ranks, "id bigint, rank bigint")

    def ruler(name: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(level), name), F.lit(RULERS)) == 0

    state = paths
    on = F.col("next").isNotNull() & ~ruler("next")
    while not state.filter(on).isEmpty():
        then = state.select(F.col("id").alias("next"), F.col("next").alias("then"), F.col("w").alias("more"))
        moved = state.filter(on).join(then, "next").select("id", F.col("then").alias("next"), (F.col("w") + F.col("more")).alias("w"))
        state = materialise(moved.unionByName(state.filter(~on)))
    top = ranked(stored(state.filter(ruler("id"))), block, level + 1)
    beyond = top.select(F.col("id").alias("next"), F.col("rank").alias("beyond"))
    return state.join(beyond, "next", "left").select("id", (F.col("w") + F.coalesce("beyond", F.lit(0))).alias("rank"))


def subtrees(tree: DataFrame, block: int = BLOCK) -> DataFrame:
    """(number, n_leaves, saved_tokens) of every node."""
    kind = "arc bigint, path bigint, offset bigint, leaf bigint, saved bigint, next bigint, length bigint"
    arcs = stored(tour_links(tree).groupBy("block").applyInArrow(_block_paths, kind))
    paths = stored(arcs.filter("offset = 0").select(F.col("path").alias("id"), "next", F.col("length").alias("w")))
    ranks = ranked(paths, block)
    # A path has the links of one block at most.
    placed = arcs.join(ranks.withColumnRenamed("id", "path"), "path").select(
        (F.col("offset") - F.col("rank")).alias("at"), "arc", "leaf", "saved"
    )
    tour = scanned(placed, [], ["at"], ["leaf", "saved"])
    leaves, enters = F.col("arc") % 2 == 1, F.col("arc") % 2 == 0
    return tour.groupBy(F.shiftright("arc", 1).alias("number")).agg(*[
        (F.max(F.when(leaves, F.col(f"upto_{v}"))) - F.max(F.when(enters, F.col(f"before_{v}")))).alias(n)
        for v, n in (("leaf", "n_leaves"), ("saved", "saved_tokens"))
    ])


def _runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """Runs of rows with equal keys: the key, the first row and the one after the last."""
    keys = np.stack([batch.column(n).to_numpy() for n in names], axis=1)
    cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield tuple(keys[lo].tolist()), lo, hi


def digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) from (depth, a, b, c): the hash of the sorted ids of each node.

    Ranges of sorted ids become pieces of text first, many tasks for a node with many ids. The pieces of a node go through one hash
    one after the other, as SHA-256 asks for, without being held together.
    """
    keys = ["depth", "a", "b"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            ids, out = b.column("c").to_numpy(), []
            for key, lo, hi in _runs(b, keys):
                out += [(*key, int(ids[i]), ",".join(map(str, ids[i:min(hi, i + IDS)].tolist()))) for i in range(lo, hi, IDS)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], names=[*keys, "c", "piece"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key = None, None
        for b in batches:
            if not b.num_rows:
                continue
            done, texts = [], b.column("piece")
            for own, lo, hi in _runs(b, keys):
                if own != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    state, key, comma = hashlib.sha256(), own, b""
                for i in range(lo, hi):
                    state.update(comma + texts[i].as_py().encode())
                    comma = b","
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=[*keys, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=[*keys, "ends_sha256"])

    kind = "depth bigint, a bigint, b bigint"
    ends = stored(ends)
    texts = ends.repartitionByRange(*keys, "c").sortWithinPartitions(*keys, "c").mapInArrow(pieces, f"{kind}, c bigint, piece string")
    return texts.repartition(*keys).sortWithinPartitions(*keys, "c").mapInArrow(hashed, f"{kind}, ends_sha256 string")


def trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for every node of the trie of rebuilt conversations."""
    turns = turns_of(conversations)
    convs = stored(turns.groupBy("c").agg(F.count(F.lit(1)).alias("n")))
    begun = stored(beginnings(rebuilt(turns, convs)))
    tree = grown(begun, convs)
    last = begun.groupBy("c").agg(F.max(F.struct("depth", "a", "b")).alias("end"))
    zero = F.lit(0).cast("bigint")
    ends = convs.select("c").join(last, "c", "left").select(*[F.coalesce(F.col("end")[n], zero).alias(n) for n in ("depth", "a", "b")], "c")
    found = tree.join(subtrees(tree, block), "number").join(digests(ends), ["depth", "a", "b"], "left")
    return found.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


def _crc32(value: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII string: the bitwise division, eight steps a character."""
    step = "xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_concat([xor(r, o)], [0::BIGINT FOR i IN range(8)]), LAMBDA c, i: {step})"
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], [ord(x)::BIGINT FOR x IN string_split({value}, '')]), LAMBDA r, o: {byte}), 4294967295)"""


#: Beginnings as lists of turns; each childless node and each saving is counted at all beginnings of its first member.
SQL = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % {FAMILY} AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % {SHARES} AS h
          FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS part, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.p <= c.h
  UNION ALL
  SELECT c.conv_id, 1, t.p, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.p > c.h),
rebuilt AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth, sha256(concat(length(role), ':', role, text)) AS turn, length(text) AS tokens FROM parts),
begun AS (
  SELECT conv_id, depth, tokens, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
named AS (
  SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node, max(depth) OVER (PARTITION BY conv_id) AS deepest FROM begun),
nodes AS (
  SELECT node, depth, count(*) AS n_convs, min(tokens) AS tokens,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (deepest = depth), '') AS ends
  FROM named GROUP BY node, depth),
tree AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN named p ON p.conv_id = n.node AND p.depth = n.depth - 1),
families AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM tree WHERE depth > 0 GROUP BY ALL),
figures AS (
  SELECT t.node, t.depth, CASE WHEN f.n_children IS NULL THEN 1 ELSE 0 END AS leaf, (t.n_convs - 1) * t.tokens AS saved
  FROM tree t LEFT JOIN families f ON f.parent = t.node AND f.depth = t.depth),
below AS (
  SELECT a.node, a.depth, sum(g.leaf) AS n_leaves, sum(g.saved) AS saved_tokens
  FROM figures g JOIN named a ON a.conv_id = g.node AND a.depth <= g.depth GROUP BY ALL)
SELECT t.node AS conv_id, CAST(t.depth AS BIGINT) AS depth, t.parent AS parent_conv_id, t.n_convs, coalesce(f.n_children, 0) AS n_children,
  CAST(b.n_leaves AS BIGINT) AS n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(t.ends) AS ends_sha256
FROM tree t LEFT JOIN families f ON f.parent = t.node AND f.depth = t.depth JOIN below b ON b.node = t.node AND b.depth = t.depth
"""

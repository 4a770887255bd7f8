"""Transitive sources: deep chains, cycles, hop limits and hubs against plain searches."""

import random
from collections import deque

import pytest

from ferrytally.operators import closure, lineage


def plain(edges, limit=None):
    """Shortest distances by a breadth-first search from every node."""
    step = {}
    for a, b in edges:
        step.setdefault(a, set()).add(b)
    out = set()
    for start in step:
        seen, queue = {}, deque((n, 1) for n in step[start])
        while queue:
            node, hops = queue.popleft()
            if node not in seen and (limit is None or hops <= limit):
                seen[node] = hops
                queue.extend((n, hops + 1) for n in step.get(node, ()))
        out |= {(start, n) for n in seen}
    return out


def closed(spark, edges, **options):
    frame = spark.createDataFrame([tuple(map(str, e)) for e in edges] or [], "output_id string, source_id string")
    rows = [tuple(r) for r in lineage.transitive_sources(frame, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def text(pairs):
    return {tuple(map(str, p)) for p in pairs}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(75)] + [(100, 100), (3, 3), (3, 3)]
    assert closed(spark, edges) == text(plain(edges))
    assert closed(spark, edges, hot_rows=10) == text(plain(edges))


@pytest.mark.parametrize("hops", [1, 2, 3, 5, 8])
def test_hop_limits(spark, hops):
    edges = [(i, i + 1) for i in range(20)] + [(20, 4), (0, 9), (7, 2)]
    assert closed(spark, edges, max_hops=hops) == text(plain(edges, hops))


def test_empty(spark):
    assert closed(spark, []) == set()


def test_a_deep_chain_with_a_cycle_takes_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(lineage, "materialise", lambda df, real=lineage.materialise: rounds.append(1) or real(df))
    edges = spark.range(4096).selectExpr("id AS output_id", "CASE WHEN id = 4095 THEN 4090 ELSE id + 1 END AS source_id")
    found = lineage.transitive_sources(edges)
    # Every node of the chain reaches all later ones, and the six of the cycle each other and themselves.
    assert found.count() == 4090 * 4089 // 2 + 4090 * 6 + 36
    assert len(rounds) <= 15


@pytest.mark.parametrize("hops", [None, 3])
def test_parts_closed_by_a_task_and_by_joins(spark, hops, monkeypatch):
    """Whatever the size from which parts are joined, and however many chunks their edges are read in."""
    monkeypatch.setattr(closure, "CHUNK", 7)
    rng = random.Random(5)
    edges = [(base + rng.randrange(12), base + rng.randrange(12)) for base in range(0, 600, 20) for _ in range(rng.randrange(1, 25))]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(1040, 1037), (2000, 2000)]
    rng.shuffle(edges)
    expected = text(plain(edges, hops))
    for size in (10, 100_000):
        assert closed(spark, edges, max_hops=hops, part_edges=size) == expected


def test_ends_that_are_null(spark):
    """They are reached, or start, but nothing goes on through them."""
    rows = [("a", "b"), ("b", None), (None, "b"), (None, None), ("c", None), ("d", "e"), ("e", "f")]
    found = lineage.transitive_sources(spark.createDataFrame(rows, "output_id string, source_id string")).distinct().collect()
    assert {tuple(r) for r in found} == {*rows, ("a", None), ("d", "f")}


def test_pairs_of_small_parts_are_not_stored(spark, monkeypatch):
    """Chains of 256 nodes have 128 pairs for each edge; files hold edges and their parts alone."""
    rows = []
    real = closure.stored
    monkeypatch.setattr(closure, "stored", lambda df: (kept := real(df), rows.append(kept.count()))[0])
    monkeypatch.setattr(lineage, "stored", lambda df: (kept := real(df), rows.append(kept.count()))[0])
    edges = spark.range(64 * 256).selectExpr("CAST(id AS STRING) output_id", "CAST(IF(id % 256 = 255, id - 2, id + 1) AS STRING) source_id")
    found = lineage.transitive_sources(edges)
    assert found.count() == 64 * (253 * 252 // 2 + 253 * 3 + 9)
    assert max(rows) <= 64 * 256

"""Mixing: the draws against plain Python, shares, and odd inputs."""

import hashlib
import math
from collections import Counter

import pytest

from ferrytally.llm import mixing
from tests.llm import odd


def number(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16)


def identity(doc, text):
    return f"{'' if doc is None else doc}:{hashlib.md5((text or '').encode()).hexdigest()}"


def poisson(mean, u):
    k, p = 0, math.exp(-mean)
    c = p
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def plain(rows, weights, rest, seed=mixing.SEED):
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").encode()) + 1
    heavy = sum(weights.get(s, rest) for s in size)
    out = Counter()
    for doc, text, source in rows:
        rate = weights.get(source, rest) / heavy * sum(size.values()) / size[source]
        steps = max(1, math.ceil(rate / mixing.STEP))
        who = identity(doc, text)
        for copy in range(sum(poisson(rate / steps, number(str(seed), str(i), who) / 2 ** 52) for i in range(steps)) if rate else 0):
            out[doc, text, source, copy, number(str(seed + 1), str(copy), who)] += 1
    return out


@pytest.mark.parametrize("weights, rest", [({}, 1.0), ({"s0": 3.0, None: 0.0}, 1.0), ({"s1": 500.0}, 0.01)])
def test_draws(spark, weights, rest):
    got = mixing.replicas(odd.frame(spark), weights, rest).collect()
    have = Counter((*[r["__row"][c] for c in ("doc_id", "text", "source")], r["__copy"], r["__place"]) for r in got)
    assert have == plain([(r[0], r[1], r[3]) for r in odd.rows()], weights, rest)


def test_shares_meet_the_target(spark):
    rows = [(i, f"text {i} " * (i % 7 + 1), "hot" if i % 3 else f"s{i % 5}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = Counter()
    for r in mixing.mixed(docs, {"hot": 1.0}, 1.0).collect():
        got[r["source"]] += len(r["text"]) + 1
    total = sum(got.values())
    assert total == pytest.approx(sum(len(t) + 1 for _, t, _ in rows), rel=0.06)
    assert all(n / total == pytest.approx(1 / 6, rel=0.15) for n in got.values())


def test_large_rates_do_not_underflow(spark):
    rows = [(i, "x" * 99, "small") for i in range(3)] + [(9, "y" * 599_999, "large")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    n = Counter(r["source"] for r in mixing.mixed(docs).collect())
    assert n["small"] == pytest.approx(3000, rel=0.1)


def test_order_is_by_place(spark):
    places = [r["__place"] for r in mixing.shuffled(mixing.replicas(odd.frame(spark))).collect()]
    assert places == sorted(places)


def test_columns_and_empty(spark):
    assert mixing.mixed(odd.frame(spark)).columns == odd.frame(spark).columns
    assert mixing.mixed(odd.empty(spark)).collect() == []
    assert mixing.mixed(odd.frame(spark), {}, 0.0).collect() == []


def test_many_sources_are_joined_in_parts(spark, monkeypatch):
    """Beyond the broadcast: the same draws, a hot source and null included."""
    from ferrytally.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rows = [(i, f"t{i} " * (i % 5), None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 40}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    before = sorted(map(str, mixing.replicas(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 3)
    assert sorted(map(str, mixing.replicas(docs).collect())) == before


def test_parts_follow_from_places(spark):
    """One exchange of the texts, a global order, and every copy in the part of its place."""
    docs = spark.createDataFrame([(i, f"text {i}", f"s{i % 3}") for i in range(3000)], "doc_id bigint, text string, source string")
    copies, size = mixing._copies(docs, None, 1.0, mixing.SEED)
    got = mixing.shuffled(copies, 40 * mixing.PART_BYTES)
    assert got.rdd.getNumPartitions() == 40
    rows = got.collect()
    assert [r["__place"] for r in rows] == sorted(r["__place"] for r in copies.collect())
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert min(sizes) > 30 and max(sizes) < 150
    plan = mixing.mixed(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1 and "rangepartitioning" not in plan

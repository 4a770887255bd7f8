"""Sharding: exact sizes, gapless slots, and draws that follow the distribution."""

import math
from collections import Counter

import numpy as np
import pytest

from ferrytally.llm import sharding as s
from tests.llm import odd


@pytest.mark.parametrize("n, shards", [(1000, 16), (5, 16), (17, 4)])
def test_exact_sizes(spark, n, shards):
    got = s.dealt(spark.range(n).repartition(7).checkpoint(), shards).select("__row.id", "shard", "slot").collect()
    assert sorted(r["id"] for r in got) == list(range(n))
    sizes = Counter(r["shard"] for r in got)
    counts = [sizes.get(i, 0) for i in range(shards)]
    assert max(counts) - min(counts) <= 1
    for i in range(shards):
        assert sorted(r["slot"] for r in got if r["shard"] == i) == list(range(counts[i]))


def test_pieces_give_gapless_slots(spark, monkeypatch):
    monkeypatch.setattr(s, "PIECE_ROWS", 10)
    got = s.dealt(spark.range(900).checkpoint(), 4).select("shard", "slot").collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(i, k) for i in range(4) for k in range(225)]


def test_same_again_and_no_order_left(spark):
    docs = spark.range(2000).repartition(5).checkpoint()
    once = {r["id"]: (r["shard"], r["slot"]) for r in s.dealt(docs).select("__row.id", "shard", "slot").collect()}
    assert once == {r["id"]: (r["shard"], r["slot"]) for r in s.dealt(docs).select("__row.id", "shard", "slot").collect()}
    place = [once[i][0] * 125 + once[i][1] for i in range(2000)]
    assert abs(np.corrcoef(place, np.arange(2000))[0, 1]) < 0.1


def test_copies_are_spread(spark):
    rows = spark.createDataFrame([("same",)] * 1600, "text string").repartition(6).checkpoint()
    got = Counter(r["shard"] for r in s.dealt(rows).collect())
    assert set(got.values()) == {100}


def test_matrix_margins():
    counts = [0, 5, 100, 7, 1000, 1]
    matrix = s.communication_matrix(counts, 16, 3)
    assert [sum(r) for r in matrix] == counts
    sizes = [sum(r[i] for r in matrix) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("good, bad, draws", [(30, 70, 20), (3, 5, 4), (3 * 10**9, 9 * 10**9, 10**6)])
def test_hypergeometric(good, bad, draws):
    rng = np.random.default_rng(1)
    got = np.array([s.hypergeometric(rng, good, bad, draws) for _ in range(3000)])
    p = good / (good + bad)
    sd = math.sqrt(draws * p * (1 - p) * (good + bad - draws) / (good + bad - 1))
    assert got.mean() == pytest.approx(draws * p, abs=5 * sd / math.sqrt(3000))
    assert got.std() == pytest.approx(sd, rel=0.08)
    assert got.min() >= max(0, draws - bad) and got.max() <= min(good, draws)


def test_large_draws_follow_the_exact_distribution():
    """The own inversion, made to run on small numbers, against the probabilities."""
    rng, n = np.random.default_rng(2), 20_000
    good, bad, draws = 2 * 10**9, 2 * 10**9, 6
    got = Counter(s.hypergeometric(rng, good, bad, draws) for _ in range(n))
    for k in range(7):
        assert got[k] / n == pytest.approx(math.comb(6, k) / 64, abs=0.015)


def test_odd_and_empty(spark):
    docs = odd.frame(spark).checkpoint()
    got = s.sharded(docs)
    assert got.columns == [c for c in docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    assert got.count() == len(odd.rows())
    assert s.sharded(odd.empty(spark).checkpoint()).collect() == []


def scan_that_changes(spark, path):
    """A Parquet scan, and what splits it in other ways from now on."""
    spark.range(4000).selectExpr("id", "repeat(cast(id as string), 20) text").repartition(3).write.parquet(path)
    return spark.read.parquet(path), lambda: spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")


def test_scan_may_change_its_partitions(spark, tmp_path):
    """Cores that come or go change the split of a scan between the count and the deal."""
    docs, change = scan_that_changes(spark, str(tmp_path / "docs"))
    try:
        sharded = s.sharded(docs)
        change()
        got = sharded.select("id", "shard", "slot").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r["id"] for r in got) == list(range(4000))
    assert sorted((r["shard"], r["slot"]) for r in got) == [(i, k) for i in range(16) for k in range(250)]


def test_changed_partitions_are_an_error(spark, tmp_path):
    docs, change = scan_that_changes(spark, str(tmp_path / "docs"))
    try:
        dealt = s.dealt(docs)
        change()
        with pytest.raises(Exception, match="partitions changed"):
            dealt.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")

"""Drawn keys: the bound of a large table gives the same keys as ranking them all."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ferrytally.operators import sampling


def plain(keys, n, seed=42):
    rank = lambda k: hashlib.md5("|".join([str(seed), *["~null~" if v is None else str(v) for v in k]]).encode()).hexdigest()
    return sorted(sorted(set(keys), key=lambda k: (rank(k), str(k)))[:n], key=str)


@pytest.mark.parametrize("n", [0, 1, 40, 300, 2000])
@pytest.mark.parametrize("small_bytes", [0, 1 << 30])
def test_draw(spark, n, small_bytes):
    """Repeated keys, a hot one, nulls."""
    keys = [(i % 700, "x" if i % 3 else None) for i in range(3000)] + [(None, None)] * 500 + [(5, "x")] * 2000
    df = spark.createDataFrame(keys, "a int, b string").repartition(6)
    got = sampling.sample_keys(df, ["a", "b"], n, small_bytes=small_bytes).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(keys, n)


def test_a_bound_that_is_too_low_is_raised(spark, monkeypatch):
    """As if the sketch had counted a hundred times too many keys."""
    real = F.approx_count_distinct
    monkeypatch.setattr(sampling.F, "approx_count_distinct", lambda *a: real(*a) * 100)
    keys = [(i,) for i in range(5000)]
    got = sampling.sample_keys(spark.createDataFrame(keys, "a int"), ["a"], 200, small_bytes=0).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(keys, 200)


def test_few_jobs(spark):
    """A synchronised draw from two tables and its rows."""
    left = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    right = left.filter("v <> 3")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    a, b = sampling.sync_sample(left, right, ["k"], 300)
    drawn = (a.count(), b.count())
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    assert drawn[0] == 300 and 200 < drawn[1] < 300
    assert len(jobs) <= 10  # two counts with their broadcasts among them

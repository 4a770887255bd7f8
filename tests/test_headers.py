"""Unique names of long headers against a plain fold."""

import random

import pytest
from pyspark.sql import functions as F

from ferrytally.operators.schema import unique_in_header

SCHEMA = "dataset string, at int, n string"


def plain(rows):
    """Names in order; a repeat takes the first number that is free, and after a null name none."""
    nulls_first = lambda v: (v is not None, v)
    out, used = [], {}
    for row in sorted(rows, key=lambda r: (nulls_first(r[0]), nulls_first(r[1]), nulls_first(r[2]))):
        seen, own = used.setdefault(row[0], set()), row[2]
        final = own
        if own is not None and own in seen:
            final = None if None in seen else next(f"{own}_{k}" for k in range(1, len(seen) + 2) if f"{own}_{k}" not in seen)
        seen.add(final)
        out.append((*row, final))
    return sorted(out, key=str)


def found(spark, rows):
    return sorted(map(tuple, unique_in_header(spark.createDataFrame(rows, SCHEMA), F.col("n"), ["dataset"], "at").collect()), key=str)


@pytest.mark.parametrize("nulls", [False, True])
def test_headers_of_names_that_look_like_repeats(spark, nulls):
    rng = random.Random(3)
    names = ["A", "A_1", "A_2", "A_1_1", "A_01", "A1", "B_", "B__1", "", "_1", "7", "7_1", "é\n", *[None] * nulls]
    rows = [(rng.choice(["x", "y", "z", None]), rng.choice([None, *range(200)]) if nulls else i, rng.choice(names)) for i in range(400)]
    assert found(spark, rows) == plain(rows)


def test_a_long_header_is_gone_through_once(spark):
    """20,000 repeats: a fold that looks through all names for each would take hours."""
    rows = spark.range(20_000).select(F.lit("x").alias("dataset"), F.col("id").cast("int").alias("at"), F.when(F.col("id") % 2 == 0, "A").otherwise("A_1").alias("n"))
    names = unique_in_header(rows, F.col("n"), ["dataset"], "at")
    assert names.select("final_name").distinct().count() == 20_000
    assert names.filter("at = 19998").first()["final_name"].startswith("A_")

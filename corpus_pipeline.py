"""A training-data pipeline of corpus operators: each stage reads what the one before it wrote.

``run`` applies the stages to ``documents``. Every stage takes (spark, docs, sf_dir) and returns a
frame with the columns of ``documents``; the last one adds the shard and the place in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferrytally.llm import decontaminate, mixing, quality_rules, sharding, simhash_neardup
from ferrytally.llm.common import table
from ferrytally.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return simhash_neardup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeat until every source has an equal share of the text, in random order."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into shards of equal size."""
    return sharding.sharded(docs)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("sharding", shard),
]

#: Hashes of trained weights and fingerprints decide; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between them the rows are Parquet in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            path = scratch_path(spark, f"stage{at}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

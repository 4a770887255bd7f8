"""Quality rules: plain text statistics, and a hashed n-gram log-likelihood ratio.

A document is judged by how likely its words and word pairs are in trusted texts, compared with
the whole corpus. Both are multinomials over hash buckets. The trusted one is fitted on at most
``target_docs`` labelled documents, the corpus one on every n-gram of every document. The ratio is
averaged over the n-grams of the document and compared with a fixed threshold.

Defined results: a null or empty text has no words, fails the base rules and scores 0. Without
trusted documents every ratio is 0, so only the base rules decide. Repeated rows are judged alike
and each counts in the corpus. A null id is never trusted. Columns of the input that are not used
are ignored by ``judge`` and kept by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytally.llm.common import let, table, windows, words


@dataclass(frozen=True)
class Rules:
    buckets: int = 65_536  # of the hashed n-grams; bounds the weights to half a megabyte
    target_docs: int = 20_000  # labelled documents that the trusted multinomial is fitted on, at most
    smoothing: float = 20.0  # added to the trusted count and to the count that the corpus predicts
    threshold: float = -0.12  # mean log ratio per n-gram below which a document is rejected
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8


#: Fixed value: the characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"


def base_stats(text: Column, rules: Rules = Rules()) -> dict[str, Column]:
    """The plain statistics, all in one pass over the text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    stats = let(let(words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        repeated_words(w, rules.window).cast("bigint").alias("n_repeat_words"),
    )), lambda s: F.struct(
        s["n_words"].alias("n_words"), s["word_chars"].alias("word_chars"), s["n_repeat_words"].alias("n_repeat_words"),
        (
            (s["n_words"] < rules.min_words) | (100 * s["n_repeat_words"] > rules.max_repeat_percent * s["n_words"])
        ).alias("base_failed"),
    ))
    return {
        "stats": stats,
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
    }


def repeated_words(w: Column, size: int) -> Column:
    """How many words lie in a window of ``size`` words that the text holds twice or more."""
    def covered(hashes: Column) -> Column:
        order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
        starts = let(order, lambda s: F.sort_array(F.filter(F.transform(s, lambda x, i: F.when(
            (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["p"]
        )), lambda p: p.isNotNull())))
        reach = let(starts, lambda p: F.transform(
            p, lambda x, i: F.least(F.lit(size), F.coalesce(F.get(p, i + 1) - x, F.lit(size)))
        ))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    return let(windows(w, size, lambda x: F.xxhash64(*x)), lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)
    ).otherwise(F.lit(0)))


def gram_buckets(text: Column, buckets: int) -> Column:
    """The hash buckets of all words and word pairs of a text."""
    def bucket(*x: Column) -> Column:
        return F.pmod(F.xxhash64(*x), F.lit(buckets)).cast("int")

    return let(words(text), lambda w: F.concat(
        F.transform(w, lambda x: bucket(x)), windows(w, 2, lambda x: bucket(*x))
    ))


def trusted_ids(labels: DataFrame, rules: Rules) -> DataFrame:
    """At most ``target_docs`` ids of good quality, those with the smallest hashes."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__good"))
    return good.distinct().orderBy(F.xxhash64("__good"), "__good").limit(rules.target_docs)


def ratio_weights(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row: the log ratio of every bucket, as an array. Every n-gram of the corpus counts."""
    texts = docs.select(F.col("doc_id").alias("__id"), F.col("text").alias("__text"))
    marked = texts.join(F.broadcast(trusted_ids(labels, rules)), F.col("__id") == F.col("__good"), "left")
    grams = marked.select(
        F.col("__good").isNotNull().cast("bigint").alias("t"),
        F.explode(gram_buckets(F.col("__text"), rules.buckets)).alias("b"),
    )
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("r"), F.sum("t").alias("t"))
    every = docs.sparkSession.range(rules.buckets).select(F.col("id").cast("int").alias("b"))
    dense = every.join(counts, "b", "left").select("b", F.coalesce("r", F.lit(0)).alias("r"), F.coalesce("t", F.lit(0)).alias("t"))
    one = dense.agg(
        F.sort_array(F.collect_list(F.struct("b", "r", "t"))).alias("all"), F.sum("r").alias("nr"), F.sum("t").alias("nt")
    )
    share = F.when(F.col("nt") > 0, F.col("nt") / F.greatest(F.col("nr"), F.lit(1))).otherwise(F.lit(0.0))
    smooth = F.lit(rules.smoothing)
    return one.select(F.transform("all", lambda x: F.log((x["t"] + smooth) / (x["r"] * share + smooth))).alias("weights"))


def judge(docs: DataFrame, labels: DataFrame, rules: Rules = Rules(), packed: bool = False) -> DataFrame:
    """Statistics and verdict of every document; ``packed`` adds the whole row as ``__row``."""
    weights = ratio_weights(docs, labels, rules).scalar()
    text = F.col("text")
    llr = let(F.col("__weights"), lambda a: let(gram_buckets(text, rules.buckets), lambda g: F.when(F.size(g) > 0, F.aggregate(
        g, F.lit(0.0), lambda s, b: s + F.get(a, b)
    ) / F.size(g)).otherwise(F.lit(0.0))))
    rows = docs.select(
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")] if packed else []), "doc_id", "text"
    )
    measured = rows.withColumn("__weights", weights).select(
        *(["__row"] if packed else []), "doc_id", *[c.alias(n) for n, c in base_stats(text, rules).items()], llr.alias("llr")
    )
    # The verdict takes the statistics once: a filter on it would work out the texts again for each use.
    kept = F.when(F.col("stats.base_failed"), False).otherwise(F.col("llr") >= rules.threshold)
    return measured.select(
        *(["__row"] if packed else []), "doc_id", "stats.n_words", "stats.word_chars", "n_symbols", "n_dup_lines",
        "stats.n_repeat_words", "stats.base_failed", kept.alias("kept"), "llr",
    )


def keep_good(docs: DataFrame, labels: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that pass, with their columns."""
    kept = judge(docs, labels, rules, packed=True).filter("kept")
    return kept.select(*[F.col("__row")[c].alias(c) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

"""Quality rules against plain Python."""

import math
import re

import pytest

from ferrytally.llm import quality_rules as q
from tests.llm import odd

LABELS = [(0, 1, 0), (3, 1, 0), (3, 0, 0), (15, 1, 1), (None, 1, 0), (14, None, 0)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = set()
    for i, r in enumerate(runs):
        if runs.count(r) > 1:
            covered.update(range(i, i + 8))
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed)


def short_texts():
    extra = ["x # *\n\nx # *\n x\nx # *", "a b c d e f g h i " * 3 + "z", "<|%> " * 30, "w1 " * 25 + " ".join(f"u{i}" for i in range(60))]
    return [t for t in odd.texts() if len(t or "") < 3000] + extra


def test_statistics(spark):
    rows = [(i, t) for i, t in enumerate(short_texts())]
    got = q.judge(spark.createDataFrame(rows, "doc_id bigint, text string"), labels(spark)).orderBy("doc_id").collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert [tuple(r[n] for n in names) for r in got] == [plain(t) for _, t in rows]
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_ratio_is_that_of_the_counts(spark):
    """The score is recomputed from bucket counts that plain Python makes of Spark's buckets."""
    docs, rules = odd.frame(spark), q.Rules(buckets=64, smoothing=2.0)
    grams = [
        (r["doc_id"], r["g"]) for r in
        docs.select("doc_id", q.gram_buckets(docs["text"], rules.buckets).alias("g")).collect()
    ]
    for (_, g), row in zip(grams, odd.rows()):
        n = len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
        assert len(g) == max(0, 2 * n - 1)
    trusted = {0, 3, 15}
    corpus, target = [0] * 64, [0] * 64
    for doc, g in grams:
        for b in g:
            corpus[b] += 1
            target[b] += doc in trusted
    share = sum(target) / sum(corpus)
    weight = [math.log((t + 2.0) / (c * share + 2.0)) for c, t in zip(corpus, target)]
    want = [sum(weight[b] for b in g) / len(g) if g else 0.0 for _, g in grams]
    got = [r["llr"] for r in q.judge(docs, labels(spark), rules).collect()]
    assert got == pytest.approx(want)


def test_junk_goes_and_clean_stays(spark):
    import random

    rng = random.Random(1)
    clean = [odd.words(rng, 120, "aeioulmnrst") for _ in range(60)]
    junk = [" ".join(w.upper() + "!!" for w in odd.words(rng, 120, "ae").split()) for _ in range(20)]
    docs = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id bigint, text string")
    kept = {r["doc_id"] for r in q.keep_good(docs, labels(spark, [(i, 1, 0) for i in range(0, 60, 2)])).collect()}
    assert kept == set(range(60))


def test_odd_and_empty(spark):
    docs = odd.frame(spark)
    assert q.judge(docs, labels(spark)).count() == len(odd.rows())
    kept = q.keep_good(docs, labels(spark, []))
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(
        (r[0] for r in odd.rows() if not plain(r[1])[-1]), key=str
    )
    assert q.judge(odd.empty(spark), labels(spark, [])).collect() == []


def test_trusted_sample_is_bounded(spark):
    many = labels(spark, [(i, 1, 0) for i in range(500)])
    assert q.trusted_ids(many, q.Rules(target_docs=40)).count() == 40

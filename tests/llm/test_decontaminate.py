"""Decontamination against plain Python: every window of item size, whole documents that are shorter, runs of short items."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ferrytally.llm import decontaminate as d
from tests.llm import odd

ITEMS = "item_id bigint, text string, fp bigint, n int"


def shingles(text):
    w = (text or "").lower().split()
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [("short", *w)] if w else []


def plain(docs, items, similarity=0.8):
    """Pairs with a window similar enough, and the best similarity."""
    out = {}
    for doc, text in docs:
        h, w = shingles(text), (text or "").lower().split()
        for item, own in items:
            bag, short = shingles(own), (own or "").lower().split()
            n = len(bag)
            best = 0.0
            if 0 < len(short) < 5:
                best = float(any(w[i:i + len(short)] == short for i in range(len(w))))
                n = 0
            for s in range(max(len(h) - n, 0) + 1 if n and h else 0):
                a, b = Counter(h[s:s + n]), Counter(bag)
                best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= similarity:
                out[doc, item] = max(best, out.get((doc, item), 0))
    return out


def corpus():
    rng = random.Random(8)
    items = [odd.words(rng, n) for n in (12, 30, 30, 45, 60)] + ["a b c d e", "p q", "", None, "z " * 40]
    items += ["Q", "q r s t", " ".join(f"u{i}" for i in range(15))]
    docs = []
    for text in items[:5]:
        w = text.split()
        docs.append(f"{odd.words(rng, 30)} {text} {odd.words(rng, 20)}")
        docs.append(text.upper())
        for edits in (1, 1, 2, 3, 6):
            v = list(w)
            for _ in range(edits):
                at = rng.randrange(len(v))
                v[at:at + 1] = rng.choice([[], ["new"], [v[at], "more"]])
            docs.append(f"{odd.words(rng, rng.randint(0, 9))} {' '.join(v)} {odd.words(rng, 5)}")
        docs.append(" ".join(w[: len(w) // 2]))
    docs += ["a b c d e", "x a b c d e y", "p q", "p q r", "z " * 38, "z " * 60, "", None, odd.words(rng, 300)]
    own = items[-1].split()
    docs += [" ".join(own[:14]), " ".join(own[1:]), " ".join(own[:12]), " ".join(own[2:]), "u0 u1 u2 u3", "q r s t u", "r p\nq", "p r q", "pq", "q r s"]
    for text in items[:4]:
        docs += [" ".join(text.split()[:-k]) for k in (1, 2, 3, 5)]
    return list(enumerate(docs)), [(i, t) for i, t in enumerate(items)] + [(0, items[0]), (None, items[1]), (0, items[3])]


@pytest.mark.parametrize("part", [100_000, 20])
def test_all_windows(spark, part):
    docs, items = corpus()
    got = d.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([(*i, 0, 0) for i in items], ITEMS), d.Match(radius=39, part_shingles=part),
    ).collect()
    want = plain(docs, items)
    # A radius that no window of such similarity exceeds here, so the exact similarity alone decides.
    assert {(r["doc_id"], r["item_id"]): pytest.approx(r["similarity"]) for r in got} == want
    assert len(got) == len(want)


def test_short_documents_and_items(spark):
    """A document one word shorter than the item, and an item of four words within a longer document, are found."""
    own = "one of the many questions that a benchmark asks in fifteen words or a few"
    docs = [(1, own.rsplit(" ", 1)[0]), (2, own.split(" ", 1)[1]), (3, "well then who wrote this book they asked"), (4, "who wrote this")]
    got = d.leaks(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([(7, own, 0, 0), (8, "Who wrote this book", 0, 0)], ITEMS),
    ).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start_word"], r["n_shingles"]) for r in got) == [(1, 7, 0, 10), (2, 7, 0, 10), (3, 8, 2, 1)]


def test_parts_are_bounded_in_rows(spark):
    docs, items = corpus()
    docs, items = (spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(*i, 0, 0) for i in items], ITEMS))
    got, whole = (sorted(map(tuple, d.leaks(docs, items, m).collect()), key=str) for m in (d.Match(part_rows=500), d.Match()))
    assert got == whole


def test_default_radius_finds_nearly_all(spark):
    docs, items = corpus()
    got = d.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(*i, 0, 0) for i in items], ITEMS))
    found, want = {(r["doc_id"], r["item_id"]) for r in got.collect()}, plain(docs, items)
    assert found <= set(want) and {k for k, s in want.items() if s > 0.85} <= found and len(found) >= 0.9 * len(want)


def test_fingerprints_agree_in_both_counters(spark):
    rows = [([rng.randrange(-(1 << 63), 1 << 63) for _ in range(n)],) for rng in [random.Random(4)] for n in (1, 2, 7, 127, 128, 255, 256, 700)]
    rows += [([-1] * n,) for n in (127, 128, 300)]
    got = spark.createDataFrame(rows, "h array<bigint>").select("h", d.fingerprint(F.col("h")).alias("fp"))
    for h, fp in got.collect():
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert fp & ((1 << 64) - 1) == want


def test_odd_documents(spark):
    rows = [r[:2] for r in odd.rows()]
    items = [(1, odd.texts()[0]), (2, odd.texts()[16]), (3, "one two"), (4, None)]
    bench = spark.createDataFrame([(*i, 0, 0) for i in items], ITEMS)
    docs = odd.frame(spark)
    want = plain(rows, items)
    assert {(r["doc_id"], r["item_id"]) for r in d.leaks(docs, bench).collect()} == set(want)
    kept = d.remove_leaks(docs, bench)
    bad = {t for _, t in rows if plain([(0, t)], items)}
    assert kept.columns == docs.columns
    assert sorted((r["text"] for r in kept.collect()), key=str) == sorted((t for _, t in rows if t not in bad), key=str)


def test_empty(spark):
    none = spark.createDataFrame([], ITEMS)
    assert d.leaks(odd.frame(spark), none).collect() == []
    assert d.remove_leaks(odd.frame(spark), none).count() == len(odd.rows())
    assert d.leaks(odd.empty(spark), spark.createDataFrame([(1, "a b c d e", 0, 0)], ITEMS)).collect() == []

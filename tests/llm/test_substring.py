"""Substring deduplication against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest

from ferrytally.llm import substring_dedup as s
from tests.llm import odd


def plain(rows, window=35):
    texts = [(d, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for d, t in rows]
    times = Counter(tuple(w[i:i + window]) for _, w in texts for i in range(len(w) - window + 1))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - window + 1):
            if times[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, window=35):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted((tuple(r) for r in s.deduplicated(docs, window).collect()), key=str)


def test_odd_documents(spark):
    got = sorted((tuple(r) for r in s.deduplicated(odd.frame(spark)).collect()), key=str)
    assert got == plain([r[:2] for r in odd.rows()])
    assert s.deduplicated(odd.empty(spark)).collect() == []


def test_passages_of_all_lengths(spark):
    """Passages around the window's length, cut at either end, repeated within and across documents."""
    rng = random.Random(5)
    passage = odd.words(rng, 90).split()
    rows = []
    for i in range(120):
        a = rng.randint(0, 50)
        part = passage[a:a + rng.randint(30, 45)]
        rows.append((i, " ".join([odd.words(rng, rng.randint(0, 40)), *part, odd.words(rng, rng.randint(0, 40))])))
    rows += [(500, " ".join(passage[:36] * 3)), (501, " ".join(["x"] * 100)), (502, " ".join(["x y"] * 40)), (None, rows[3][1])]
    assert found(spark, rows) == plain(rows)


def test_near_copies(spark):
    rng = random.Random(6)
    base = odd.words(rng, 400).split()
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(0, 8)):
            w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((i, "\n".join(w)))
    assert found(spark, rows) == plain(rows)


def test_blocks_cover_every_window_once():
    hashes = s._hashes([str(x).encode() for x in range(200)])
    _, _, first, n = s.blocks(hashes)
    assert [x for f, k in zip(first, n) for x in range(f, f + k)] == list(range(200 - s.WINDOW + 1))
    assert n.max() <= s.WINDOW - s.GRAM + 1


@pytest.mark.parametrize("window", [1, 5, 20, 60, 400])
def test_windows_of_other_lengths(spark, window):
    rng = random.Random(9)
    passage = odd.words(rng, 700).split()
    rows = []
    for i in range(40):
        a = rng.randint(0, 200)
        part = passage[a:a + rng.choice([3, 19, 20, 21, 25, 59, 60, 61, 90, 420])]
        rows.append((i, " ".join([odd.words(rng, rng.randint(0, 30), "ijklmnop"), *part, odd.words(rng, rng.randint(0, 30), "qrstuvw")])))
    rows += [(500, " ".join(["x"] * 500)), (501, "x y"), (502, None), (None, rows[3][1])]
    want = plain(rows, window)
    assert found(spark, rows, window) == want and any(r[2] for r in want)


def test_a_window_has_words(spark):
    with pytest.raises(ValueError):
        s.deduplicated(odd.frame(spark), 0)

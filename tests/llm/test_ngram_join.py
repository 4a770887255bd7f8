"""The n-gram join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ferrytally.llm import ngram_join, set_links
from ferrytally.llm.set_links import Similarity
from tests.llm import odd


def shingles(text, size=4):
    low = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
    w = re.findall(rb"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def expected(rows, size=4, num=85, den=100):
    """Component of every row (id, text), by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and den * shared >= num * (len(a) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def check(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, 1, "x", b"c") for i, t in rows], "doc_id bigint, text string, n int, node string, cells binary")
    got = ngram_join.joined(frame.repartition(3), join=ngram_join.Join(**options))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    found = sorted((tuple(r) for r in got.collect()), key=str)
    assert found == expected(rows, options.get("words", 4))
    return found


def variants(rng, base, count, most):
    out = []
    for _ in range(count):
        w = list(base)
        for at in rng.sample(range(len(w)), rng.randint(0, most)):
            w[at] = rng.choice(["new", "words", "here"])
        out.append(" ".join(w))
    return out


def documents(seed):
    rng = random.Random(seed)
    texts = odd.texts()
    for size, most in ((12, 1), (40, 2), (120, 6), (400, 12)):
        for _ in range(4):
            texts += variants(rng, odd.words(rng, size).split(), 12, most)
    footer = odd.words(rng, 60)
    texts += [f"{odd.words(rng, rng.randint(1, 12))} {footer}" for _ in range(80)]
    texts += [odd.words(rng, rng.randint(1, 6), "ab") for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, texts[0]), (None, "nothing like it at all here"), (None, None), (3, texts[3]), (3, texts[3])]


# Tiny chunks and budgets cut every group and every cluster.
@pytest.mark.parametrize("options", [{}, {"chunk": 20, "budget": 300}, {"chunk": 3, "budget": 2000, "broadcast": 0}])
def test_against_all_pairs(spark, options):
    found = check(spark, documents(1), **options)
    assert len({f[2] for f in found}) < len(found) - 100


def test_one_large_cluster(spark):
    """Copies on both sides of the cut, so that pivots join some and chunks the rest."""
    rng = random.Random(8)
    base = odd.words(rng, 100).split()
    rows = [(i, t) for i, t in enumerate(variants(rng, base, 250, 7))]
    check(spark, rows, budget=3000, chunk=64)


def test_odd_and_empty(spark):
    rows = [r[:2] for r in odd.rows()]
    got = sorted((tuple(r) for r in ngram_join.joined(odd.frame(spark)).collect()), key=str)
    assert got == expected(rows)
    assert ngram_join.joined(odd.empty(spark)).collect() == []


def test_long_text(spark):
    rng = random.Random(10)
    base = odd.words(rng, 30_000)
    # More than 255 hashes in a cell.
    check(spark, [(1, base), (2, base + " end"), (3, " ".join(base.split()[:20_000])), (4, "one two three four five")])


def test_bounds_hold():
    """No box and no cell count ever promises less than two sets share."""
    rng = np.random.default_rng(2)
    similar = Similarity(85, 100)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, [900, 9000][_ % 2]), dtype=np.uint64))
        kept = a[rng.random(len(a)) < 0.93]
        b = np.unique(np.concatenate([kept, rng.integers(0, 1 << 63, rng.integers(1, 60), dtype=np.uint64)]))
        shared = len(np.intersect1d(a, b))
        n = np.array([len(a), len(b)])
        points = set_links.Points.of(pa.array([set_links.cells_of(s) for s in (a, b)]))
        assert np.minimum(*points.few).sum() >= shared
        assert points.may(np.array([0]), np.array([1]), n, similar)[0] or not similar.holds(shared, n.sum())
        if similar.holds(shared, len(a) + len(b)):
            order = lambda s: s[np.argsort(s % np.uint64(97), kind="stable")]
            heads = [set(order(s)[:similar.prefix(len(s))].tolist()) for s in (a, b)]
            assert heads[0] & heads[1]


def test_forests_join_what_all_pairs_join():
    rng = np.random.default_rng(3)
    similar = Similarity(85, 100)
    centres = [rng.integers(0, 1 << 63, 80, dtype=np.uint64) for _ in range(5)]
    sets = [np.unique(np.where(rng.random(80) < 0.06, rng.integers(0, 1 << 63, 80, dtype=np.uint64), centres[i % 5])) for i in range(120)]
    label = np.arange(len(sets))

    def groups(links):
        root = list(range(len(sets)))
        for a, b in links:
            ra, rb = root[a], root[b]
            root = [ra if r == rb else r for r in root]
        return root

    true = [(i, j) for i in range(len(sets)) for j in range(i) if similar.holds(len(np.intersect1d(sets[i], sets[j])), len(sets[i]) + len(sets[j]))]
    partition = lambda root: {frozenset(np.flatnonzero(np.array(root) == r).tolist()) for r in set(root)}
    exact = set_links.set_forest(sets, label, similar)
    assert partition(groups(exact)) == partition(groups(true)) and len(exact) < len(sets)
    points = set_links.Points.of(pa.array([set_links.cells_of(s) for s in sets]))
    tree = set_links.tree_forest(np.array([len(s) for s in sets]), points, label, similar)
    assert len(tree) < len(sets)
    joined = groups(tree)
    assert all(joined[a] == joined[b] for a, b in true)

"""SimHash near duplicates against plain Python."""

import random
import re

import numpy as np
import pytest
import xxhash

from ferrytally.llm import common
from ferrytally.llm import simhash_neardup as nd
from ferrytally.llm.components import components
from tests.llm import odd


def plain_fingerprint(text, size=3):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not w:
        return 0
    runs = [w[i:i + size] for i in range(len(w) - size + 1)] or [w]
    counts = [0] * 64
    for r in runs:
        h = xxhash.xxh64_intdigest(b" ".join(r), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(runs))


def roots(items, linked):
    root = list(range(len(items)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(items)):
        for j in range(i):
            if linked(items[i], items[j]):
                root[find(i)] = find(j)
    return [find(i) for i in range(len(items))]


def expected(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    found = roots(prints, lambda a, b: bin(a ^ b).count("1") <= 3)
    least = {}
    for (doc, _), r in zip(rows, found):
        if doc is not None:
            least[r] = min(doc, least.get(r, doc))
    return sorted(((d, format(p, "016x"), least.get(r)) for (d, _), p, r in zip(rows, prints, found)), key=str)


def test_odd_documents(spark):
    got = [tuple(r) for r in nd.near_duplicates(odd.frame(spark)).collect()]
    assert sorted(got, key=str) == expected([r[:2] for r in odd.rows()])


def test_empty_table(spark):
    assert nd.near_duplicates(odd.empty(spark)).collect() == []
    assert nd.one_of_each(odd.empty(spark)).columns == odd.empty(spark).columns


@pytest.mark.parametrize("chunk", [1024, 5])
def test_links_are_complete(spark, chunk):
    """Random fingerprints with dense clusters; tiny chunks split every key."""
    rng = np.random.default_rng(1)
    values = [int(x) for x in rng.integers(0, 1 << 63, 200)]
    for centre in values[:6]:
        for _ in range(40):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            values.append(centre ^ sum(1 << int(f) for f in flips))
    values = sorted({v - (1 << 64) if v >> 63 else v for v in values})
    pivots = nd.Pivots(chunk=chunk)
    links = [tuple(r) for r in nd.fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp bigint"), pivots).collect()]
    mask = (1 << 64) - 1
    near = lambda a, b: bin((a ^ b) & mask).count("1") <= 3
    assert links and all(near(a, b) for a, b in links)
    want = roots(values, near)
    at = {v: i for i, v in enumerate(values)}
    pairs = {frozenset((at[a], at[b])) for a, b in links}
    have = roots(list(range(len(values))), lambda i, j: frozenset((i, j)) in pairs)
    groups = lambda found: {frozenset(i for i, r in enumerate(found) if r == x) for x in found}
    assert groups(want) == groups(have)


def test_forest_is_linear():
    fps = np.array([[0]] + [[1 << i] for i in range(50)], np.uint64)
    bases = np.array([[5], [9]], np.uint64)
    assert len(nd.forest(fps, bases, 3)) == len(fps) - 1
    a, b = nd.near_pairs(fps, bases, 3, np.array([0, len(fps)]))
    assert len(a) == len(b) == len(fps) - 1


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star + [(5, 5)], "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def similarity(a, b):
    sets = []
    for text in (a, b):
        w = (text or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_similar_texts_are_found(spark):
    """Near copies of similarity 0.85 and more go, texts below 0.6 stay."""
    rng = random.Random(12)
    rows = []
    for group in range(60):
        base = odd.words(rng, 300).split()
        rows.append((group * 10, " ".join(base)))
        for copy in range(1, 4):
            w = list(base)
            for at in rng.sample(range(300), rng.randint(1, 5)):
                w[at] = "changed"
            rows.append((group * 10 + copy, " ".join(w)))
        far = list(base)
        for at in range(0, 300, 8):
            far[at] = "far"
        rows.append((group * 10 + 9, " ".join(far)))
    near = [similarity(rows[i][1], rows[i + k][1]) for i in range(0, len(rows), 5) for k in (1, 2, 3)]
    assert min(near) > 0.84 and similarity(rows[0][1], rows[4][1]) < 0.6
    kept = {r["doc_id"] for r in nd.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    stay = {g * 10 for g in range(60)} | {g * 10 + 9 for g in range(60)}
    assert stay <= kept and len(kept - stay) <= 5


def test_one_of_each(spark):
    docs = odd.frame(spark)
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    texts = {r[0]: r[1] for r in odd.rows() if r[0] is not None}
    chosen = [texts[i] for i in ids]
    assert None not in ids and len(set(ids)) == len(ids)
    # Of equal texts the first stays; of texts unlike all others each one does.
    assert {0, 3, 4, 7, 10, 15, 19} <= set(ids) and not {1, 8, 9} & set(ids) and 12 not in ids
    for text in texts.values():
        assert max(similarity(text, t) for t in chosen) >= 0.5


def test_links_of_many_keys_are_joined_once(spark, monkeypatch):
    """Near copies share most keys: only the first components see all their links, the next ones a row for each text."""
    rng, seen, real = random.Random(3), [], nd.components
    monkeypatch.setattr(nd, "components", lambda links: (seen.append(links.count()), real(links))[1])
    base, rows = odd.words(rng, 300).split(), []
    for i in range(80):
        w = list(base)
        w[rng.randrange(300)] = f"changed{i}"
        rows.append((i, " ".join(w)))
    assert [r["doc_id"] for r in nd.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()] == [0]
    assert seen[0] > 160 >= seen[1]


def test_stored_rows_leave_no_shuffle_behind(spark):
    """The setting holds while rows are written, and is as it was afterwards."""
    at = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(at, None)
    with common.dropping_shuffles(spark):
        assert spark.conf.get(at) == "true"
    assert spark.conf.get(at, None) == before
    twice = common.stored(spark.range(100).groupBy("id").count())
    assert twice.count() == 100 and twice.join(twice.select("id"), "id").count() == 100


def test_the_cut_is_exact(spark):
    """Pairs on both sides of 0.8: all at or above it are joined, none below."""
    rng = random.Random(21)
    rows = []
    for group in range(120):
        base = odd.words(rng, 64 + group % 7).split()
        other = list(base)
        for at in rng.sample(range(len(base)), 1 + group % 2):
            other[at] = f"changed{group}"
        rows += [(2 * group, " ".join(base)), (2 * group + 1, " ".join(other))]
    near = {g for g in range(120) if similarity(rows[2 * g][1], rows[2 * g + 1][1]) >= 0.8}
    kept = {r["doc_id"] for r in nd.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert 30 < len(near) < 90
    assert kept == {2 * g for g in range(120)} | {2 * g + 1 for g in range(120) if g not in near}


@pytest.mark.parametrize("chunk", [1024, 3])
def test_prefix_filter_alone_is_complete(spark, chunk, monkeypatch):
    """Without a single link of fingerprints the same rows stay."""
    monkeypatch.setattr(nd, "pivot_pairs", lambda texts, wide: spark.createDataFrame([], "a bigint, b bigint"))
    rng = random.Random(5)
    footer = odd.words(rng, 30)
    rows = [(i, f"{odd.words(rng, rng.randint(1, 9))} {footer}") for i in range(150)]
    got = {r["doc_id"] for r in nd.one_of_each(spark.createDataFrame(rows, "doc_id bigint, text string"), wide=nd.Wide(chunk=chunk)).collect()}
    found = roots(rows, lambda a, b: similarity(a[1], b[1]) >= 0.8)
    want = {min(i for i, r in enumerate(found) if r == x) for x in found}
    assert got == want and 1 < len(want) < 150

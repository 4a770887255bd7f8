"""The conversation trie against a plain dictionary of beginnings, and running sums against plain loops."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ferrytally.llm import conversation_trie as ct
from ferrytally.llm import scan

SCHEMA = "conv_id bigint, turn bigint, role string, text string, c bigint, place int, depth string, n_convs int, h1 string"


def plain(rows, tie):
    """Every node of the trie, as the contract states it; ``tie`` orders equal turns."""
    original = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            original.setdefault(conv, []).append((turn is not None, turn or 0, tie[role or "", text or ""], role or "", text or ""))
    built = {}
    for conv, turns in original.items():
        turns.sort()
    for conv, turns in original.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - (abs(conv) % 100) * (1 if conv >= 0 else -1)
        built[conv] = [t[3:] for t in original.get(base, [])[:h]] + [t[3:] for t in turns[h:]]
    members = {}
    for conv, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, convs in members.items():
        under = [p for p in members if p[:len(path)] == path]
        ends = sorted(c for c in convs if len(built[c]) == len(path))
        out.append((
            min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), len(children.get(path, [])),
            sum(p not in children for p in under), sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, 2, "d", 3, "h") for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in ct.trie(frame, **options).collect()), key=str)


def ties(spark, rows):
    """The order that hashes give to turns with one number."""
    frame = spark.createDataFrame(sorted({(r or "", t or "") for _, _, r, t in rows}), "role string, text string")
    hashes = frame.select("role", "text", *[F.xxhash64(F.lit(i), "role", "text") for i in (1, 2)]).collect()
    return {(r[0], r[1]): (r[2], r[3]) for r in hashes}


def conversations(seed, count):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-150, 450), count):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            text = rng.choice(["yes", "no", "\U0001f600 é", "", None, "a" * rng.randint(1, 40)])
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", None]), text))
    return rows


@pytest.mark.parametrize("block", [1 << 17, 3])
def test_against_a_dictionary(spark, block):
    """Tiny blocks rank the tour by rulers over several levels."""
    rows = conversations(1, 90)
    rows += [(c, t, "user", "hello") for c in range(1000, 1040) for t in range(2)]  # one opening of many
    rows += [(None, 1, "user", "lost"), (5000, None, None, None), (5000, None, None, None), (5001, 3, "user", "world " * 3000)]
    rng = random.Random(2)
    rng.shuffle(rows)
    assert found(spark, rows, block=block) == plain(rows, ties(spark, rows))


def test_one_long_conversation(spark):
    rows = [(7, t, "user", f"t{t % 3}") for t in range(3000)] + [(8, t, "user", f"t{t % 3}") for t in range(2990)]
    got = {(r[0], r[1]): r for r in found(spark, rows, block=64)}
    want = {(r[0], r[1]): r for r in plain(rows[:60] + rows[3000:3050], ties(spark, rows))}
    assert len(got) == 1 + 3000 - zlib.crc32(b"7") % 6 + 2990 - zlib.crc32(b"8") % 6 - sum(
        1 for k, r in got.items() if r[3] == 2 and k[1]
    )
    assert got[7, 0][3] == want[7, 0][3] == 2 and got[7, 0][5] == len([r for r in got.values() if not r[4]])


def test_empty(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []


@pytest.mark.parametrize("ruled", [1000, 7])
def test_ranks(spark, ruled):
    order = random.Random(3).sample(range(10_000), 700)
    weights = [1 + i % 5 for i in range(700)]
    rows = [(a, b, w) for a, b, w in zip(order, order[1:] + [None], weights)]
    frame = spark.createDataFrame(sorted(rows), "id bigint, next bigint, w bigint")
    got = {r["id"]: r["rank"] for r in ct.ranked(frame, ruled).collect()}
    assert got == {a: sum(weights[i:]) for i, a in enumerate(order)}


def test_scan(spark, monkeypatch):
    """One group over many ranges, groups of one row, sums that wrap."""
    monkeypatch.setattr(scan, "ROWS", 20)
    rng = random.Random(4)
    rows = [(0, i, rng.randrange(-(1 << 63), 1 << 63)) for i in range(300)] + [(g, 0, g) for g in range(1, 40)] + [(50, i, 1) for i in range(60)]
    rng.shuffle(rows)
    got = sorted(scan.scanned(spark.createDataFrame(rows, "g bigint, o bigint, v bigint"), ["g"], ["o"], ["v"]).collect())
    wrap = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    last, place, total = None, 0, 0
    for number, ((g, o, v), r) in enumerate(zip(sorted(rows), got), 1):
        place, total = (place, total) if g == last else (0, 0)
        place, before, total, last = place + 1, total, wrap(total + v), g
        assert tuple(r) == (g, o, v, number, place, wrap(before), total)

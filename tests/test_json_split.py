"""The splitting JSON reader against Python's, with ranges of a few bytes."""

import json
import random

import pytest

from ferrytally.operators.lineage import lineage_edges
from ferrytally.sources import json_split
from ferrytally.sources.readers import read_lineage

TRICKY = ["}", "{", '"', "\\", '\\"', '"entities": {', "\\\\}", "\n\t", "é世\U0001f600", "}}{{", "a" * 300, ""]


@pytest.fixture
def tiny_ranges(spark):
    """Byte ranges of a few dozen bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(old, (str(size), "1"))]
    for k, v in old.items():
        spark.conf.set(k, v)


def text(rng):
    return "".join(rng.choice(TRICKY) for _ in range(rng.randint(0, 4)))


def export(seed, members):
    rng = random.Random(seed)
    refs = lambda: rng.choice([None, [], [{"id": text(rng), "type": rng.choice(["DATA_SOURCE", "DATAFLOW"]), "x": {"y": text(rng)}} for _ in range(rng.randint(0, 3))]])
    entities = {}
    for i in range(members):
        entities[f"K{i}{text(rng)}"] = rng.choice([None, *[{"id": f"i{i}", "note": text(rng), "type": "DATAFLOW", "parents": refs(), "children": refs()}] * 5])
    before = {"version": 1, "about": {"entities": {"no": {"id": "no"}}, text(rng): [text(rng), {"a": {}}]}}
    return {**before, "entities": entities, "after" + text(rng): {"x": {"id": text(rng)}}, "list": [{"entities": {"no": {}}}]}


def expected(documents):
    out = []
    for d in documents:
        for key, e in (d.get("entities") or {}).items():
            e = e or {}
            refs = [None if e.get(k) is None else [(r["id"], r["type"]) for r in e[k]] for k in ("parents", "children")]
            out.append((key, e.get("id"), e.get("type"), *refs))
    return sorted(out, key=str)


def read(spark, path):
    rows = read_lineage(spark, str(path)).collect()
    refs = lambda v: None if v is None else [tuple(r) for r in v]
    return sorted(((r[0], r[1], r[2], refs(r[3]), refs(r[4])) for r in rows), key=str)


@pytest.mark.parametrize("size", [23, 61, 500, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_ranges_of_any_size(spark, tmp_path, tiny_ranges, size, indent):
    documents = [export(seed, 25) for seed in (1, 2)]
    for i, d in enumerate(documents):
        (tmp_path / f"{i}.json").write_text(json.dumps(d, indent=indent, ensure_ascii=bool(i)), "utf-8")
    tiny_ranges(size)
    assert read(spark, tmp_path) == expected(documents)
    # As Spark reads whole files.
    whole = spark.read.schema("entities map<string, struct<id:string>>").option("multiLine", True).json(str(tmp_path))
    assert len(expected(documents)) == whole.selectExpr("explode(entities)").count()


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_ranges):
    document = export(3, 200)
    (tmp_path / "one.json").write_text(json.dumps(document))
    tiny_ranges(1000)
    members = json_split.object_members(spark, str(tmp_path), "entities")
    records = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert records.rdd.getNumPartitions() > 20 and members.count() > 100
    assert read(spark, tmp_path) == expected([document])


@pytest.mark.parametrize("content", ["", "{}", "\n", '{"entities": {}}', '{"entities": null}', '{"entities": { \n }, "x": {}}\n', '{"other": {"a": {"id": "b"}}}'])
def test_nothing_to_read(spark, tmp_path, tiny_ranges, content):
    (tmp_path / "a.json").write_text(content)
    tiny_ranges(5)
    assert read(spark, tmp_path) == []


def test_several_exports_in_a_file(spark, tmp_path, tiny_ranges):
    documents = [export(seed, 4) for seed in range(6)]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(d) for d in documents))
    (tmp_path / "b.json").write_text(json.dumps(documents))
    tiny_ranges(97)
    assert read(spark, tmp_path) == expected(documents * 2)
    assert lineage_edges(read_lineage(spark, str(tmp_path))).count() > 0


@pytest.mark.parametrize("note", ["{", "}", '} " { {'])
def test_the_driver_gets_a_few_numbers_of_each_range(spark, tmp_path, tiny_ranges, monkeypatch, note):
    """However many braces stand in texts, and so count as members if a range is taken to begin inside one."""
    document = {"about": {"a": note}, "entities": {f"K{i}": {"id": str(i), "note": note, "type": "DATAFLOW"} for i in range(1500)}}
    (tmp_path / "one.json").write_text(json.dumps(document))
    tiny_ranges(20_000)
    sent, frame = [], type(spark.range(0))
    monkeypatch.setattr(frame, "collect", lambda self, real=frame.collect: sent.extend(rows := real(self)) or rows)
    members = json_split.object_members(spark, str(tmp_path), "entities")
    assert len(sent) > 3 and max(len(str(tuple(row))) for row in sent) < 300
    monkeypatch.undo()
    assert members.count() > 0 and read(spark, tmp_path) == expected([document])

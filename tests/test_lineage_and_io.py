import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferrytally.functions.names import transform_name
from ferrytally.operators import lineage
from ferrytally.operators.schema import match_columns, unique_names
from ferrytally.operators.scoring import score_steps, step_points, weights
from ferrytally.plans import migrate
from ferrytally.plans.stage_models import stage_select
from ferrytally.sources import readers, sinks


def closure_by_hand(edges):
    out = set()
    for root in {a for a, _ in edges}:
        seen, todo = set(), [b for a, b in edges if a == root]
        while todo:
            node = todo.pop()
            if node not in seen:
                seen.add(node)
                todo += [b for a, b in edges if a == node]
        out |= {(root, s) for s in seen}
    return out


@pytest.mark.parametrize("edges", [
    [("a", "b"), ("b", "c"), ("c", "a")],
    [("a", "a"), ("b", "a")],
    [(str(i), str(i + 1)) for i in range(25)] + [("25", "20")],
    [("x", f"s{i}") for i in range(50)] + [(f"s{i}", "t") for i in range(50)],
])
def test_closure(spark, edges):
    df = spark.createDataFrame(edges, "output_id string, source_id string")
    closed = lineage.transitive_sources(df)
    got = {tuple(r) for r in closed.collect()}
    assert got == closure_by_hand(edges) and closed.count() == len(got)
    again = {tuple(r) for r in lineage.transitive_sources(closed).collect()}
    assert again == got


def test_lineage_json(spark, tmp_path):
    entities = {
        "DATA_SOURCEa": {"id": "a", "type": "DATA_SOURCE", "children": [{"id": "f1", "type": "DATAFLOW"}, {"id": "r", "type": "REPORT"}]},
        "DATAFLOWf1": {"id": "f1", "type": "DATAFLOW", "parents": [{"id": "a", "type": "DATA_SOURCE"}, {"id": "u", "type": "USER"}],
                       "children": [{"id": "b", "type": "DATA_SOURCE"}]},
        "DATAFLOWf2": {"id": "f2", "type": "DATAFLOW", "parents": [{"id": "b", "type": "DATA_SOURCE"}]},
        "DATAFLOWf3": {"id": "f3", "type": "DATAFLOW", "parents": [{"id": "b", "type": "DATA_SOURCE"}]},
    }
    (tmp_path / "l.json").write_text(json.dumps({"entities": entities}, indent=2))
    df = readers.read_lineage(spark, str(tmp_path))
    assert {tuple(r) for r in lineage.lineage_edges(df).collect()} == {
        ("f1", "source", "a"), ("f1", "output", "b"), ("f2", "source", "b"), ("f3", "source", "b")}
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "dataset_id string")
    consumers = lineage.consumers_of(df, wanted)
    assert {tuple(r) for r in consumers.collect()} == {("a", "f1"), ("b", "f2"), ("b", "f3")}
    report = lineage.lineage_report(wanted, consumers)
    assert sorted(tuple(r) for r in report.collect()) == [("a", 0, "f1", 1), ("b", 0, "f2, f3", 2), ("c", 0, "None", 0)]
    assert lineage.lineage_summary(report).first()[:] == (3, 2, 3, 1.0)
    assert lineage.producers_of(df, wanted).first()[:] == ("f1", 0, "a", "b")


def test_flow_tables(spark, rows):
    flows = spark.createDataFrame([("f", "a,\na", "x,\ny"), ("g", "b", "x"), ("h", None, None)],
                                  "flow_id string, source_ids string, output_ids string")
    assert rows(lineage.explode_outputs(flows)) == [("f", "a", "x"), ("f", "a", "y"), ("g", "b", "x"), ("h", "", "")]
    assert rows(lineage.source_map(flows)) == [("x", "a"), ("x", "b"), ("y", "a")]
    assert lineage.expansion_stats(flows.filter("false")).first()["ratio"] == 0.0


def test_cells_in_parts(spark, rows):
    df = spark.createDataFrame([("k", ",".join(f"i{n}" for n in range(5)), "z")], "k string, a string, b string")
    assert rows(lineage.merge_ids(df, "k", ["a", "b"], cell_ids=2)) == [
        ("k", 0, "i0,\ni1", "z"), ("k", 1, "i2,\ni3", ""), ("k", 2, "i4", "")]


def test_unique_names(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a "), (3, "b"), (4, "A-")], "o int, n string")
    got = [r[0] for r in unique_names(df, transform_name(F.col("n")), [], "o").orderBy("o").select("final_name").collect()]
    assert got == ["A", "A_1", "B", "A_2"]


def kth_free(rows):
    """Final names by scope and ordinal, one name after the other."""
    taken, seen, out = {(d, n) for d, _, n in rows}, {}, {}
    for d, o, n in sorted(rows, key=lambda r: r[1]):
        if (d, n) not in seen:
            seen[d, n] = 0
            out[d, o] = n
            continue
        seen[d, n] += 1
        while (d, f"{n}_{seen[d, n]}") in taken:
            seen[d, n] += 1
        out[d, o] = f"{n}_{seen[d, n]}"
    return out


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_names_that_look_like_repeats(spark, hot_rows):
    rng = random.Random(8)
    pool = ["A"] * 6 + ["A_1", "A_2", "A_2", "A_4", "A_01", "A_1_1", "A_10", "B_", "B__1", "B_", "_1", "", "", "C", "A_99999999999999999999"]
    rows = [(d, o, rng.choice(pool)) for d in ("p", "q", "r") for o in range(60 if d == "p" else 9)]
    df = spark.createDataFrame(rows, "d string, o int, n string")
    got = unique_names(df, F.col("n"), ["d"], "o", hot_rows=hot_rows).collect()
    assert {(r["d"], r["o"]): r["final_name"] for r in got} == kth_free(rows) and len(got) == len(rows)
    assert len({(r["d"], r["final_name"]) for r in got}) == len(rows)


def test_contested_names_numbered_as_hot_keys(spark):
    """Repeats and taken numbers of one stem are a hot key, and only some columns of the rows are wanted."""
    rows = [("p", o, "A" if o % 2 else f"A_{1 + o % 7}", o % 3) for o in range(120)]
    df = spark.createDataFrame(rows, "d string, o int, n string, more int")
    got = unique_names(df, F.col("n"), [], "o", hot_rows=10).drop("n", "more").collect()
    assert {(r["d"], r["o"]): r["final_name"] for r in got} == kth_free([r[:3] for r in rows]) and len(got) == len(rows)


def test_match_columns_cases(spark):
    left = spark.createDataFrame([("d", 1, "Order ID", "LONG"), ("d", 2, "Gone", "STRING"), ("only_left", 1, "x", "LONG")],
                                 "dataset string, ordinal int, name string, type string")
    right = spark.createDataFrame([("d", 1, "ORDER_ID", "NUMBER"), ("d", 2, "NEW", "VARCHAR"), ("only_right", 1, "Y", "DATE")],
                                  "dataset string, ordinal int, name string, type string")
    got = {(r["dataset"], r["name"]): tuple(r[2:]) for r in match_columns(left, right).collect()}
    assert got == {
        ("d", "ORDER_ID"): ("number", "LONG", "Order ID", "matched"),
        ("d", "Gone"): ("varchar(16777216)", "STRING", "Gone", "left_only"),
        ("d", "NEW"): ("varchar", "UNKNOWN", "MISSING_IN_LEFT_NEW", "right_only"),
        ("only_left", "x"): ("number", "LONG", "x", "target_missing"),
        ("only_right", "Y"): ("date", "UNKNOWN", "Y", "default_type"),
    }


def test_half_even_points(spark):
    steps = spark.createDataFrame([("a", "Constant", 500, 0), ("a", "Constant", 500, 0), ("b", "Nope", 1000, 0)],
                                  "dataflow_id string, action_type string, sql_chars int, fallback_chars int")
    got = {r[0]: tuple(r)[1:] for r in step_points(score_steps(steps, weights(spark))).collect()}
    assert got == {"a": (4, 2, 6), "b": (22, 1, 22)}


def test_csv_round_trip_keeps_odd_text(spark, tmp_path, rows):
    data = [(1, 'say "hi"'), (2, "two\nlines"), (3, "a,b"), (4, None), (5, " padded "), (6, "back\\slash")]
    df = spark.createDataFrame(data, "k int, t string")
    sinks.save_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), schema="k int, t string", multi_line=True)) == data


def test_csv_encoding_and_separator(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("name;n\nJosé;1\n".encode("latin-1"))
    df = readers.read_csv(spark, str(tmp_path / "x.csv"), encoding="latin1", sep=";")
    assert df.first()[:] == ("José", 1)


def test_stage_rejects_do_not_depend_on_the_selection(spark, tmp_path):
    (tmp_path / "a.csv").write_text("K,V\n1,2\n2,bad\n3,4,5\n4,\n")
    schema = T.StructType([T.StructField("K", T.LongType()), T.StructField("V", T.DoubleType())])
    good = sinks.read_stage(spark, str(tmp_path), schema)
    assert good.count() == 2 and sorted(r[0] for r in good.select("K").collect()) == [1, 4]
    assert sinks.load_rejects(spark, str(tmp_path), schema).count() == 2
    with pytest.raises(ValueError):
        sinks.load_stage(spark, str(tmp_path), str(tmp_path / "t"), schema, on_error="abort")


def test_load_stage_takes_header_names(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "a.csv").write_text('Id,Text\n1,"x, y"\n')
    sinks.load_stage(spark, str(tmp_path / "s"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).first().asDict() == {"Id": "1", "Text": "x, y"}


def test_migrate_empty_leaves_target(spark, tmp_path):
    target = str(tmp_path / "t")
    assert migrate.migrate(spark.range(5), target, limit=None).first()[:] == (5, 5, True)
    with pytest.raises(ValueError):
        migrate.migrate(spark.range(0), target)
    assert spark.read.parquet(target).count() == 5


def test_migrate_limit(spark, tmp_path):
    assert migrate.migrate(spark.range(5000), str(tmp_path / "t"), limit=1000, order=["id"]).first()["actual"] == 1000
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.max("ID")).first()[0] == 999


def test_stage_select(spark):
    df = spark.createDataFrame([("1", "x")], ["Order ID", "Other"])
    out = stage_select(df, [("Order ID", "number"), ("missing", "text")], use_cast=True)
    assert out.dtypes == [("order_id", "bigint")]


def test_query_over_dataset(spark):
    out = readers.read_dataset(spark.range(10), "SELECT max(id) AS m FROM {table}")
    assert out.first()["m"] == 9

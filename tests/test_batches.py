from pyspark.sql import functions as F

from ferrytally.plans import batch, migrate
from ferrytally.plans.report import compare_tables
from ferrytally.plans.stage_models import source_manifest, stage_models
from ferrytally.streaming.stage_ingest import ingest_stage


def tables(spark):
    left = spark.createDataFrame([(i, float(i)) for i in range(50)], "Id int, `Amount $` double")
    return {"same": left, "off": left.withColumn("Amount $", F.col("Amount $") + (F.col("Id") % 2))}


def test_compare_many(spark):
    control = spark.createDataFrame(
        [(1, "same", "same.sql", "Id", "10", "testing", "before"), (2, "same", "off", "Id ,", "", "Testing", None),
         (3, "same", "gone", "Id", None, "testing", ""), (4, "same", "off", "Id", None, "Done", "kept"),
         (5, None, "off", "Id", None, "testing", "kept"), (6, "same", "off", " , ", None, "testing", "kept")],
        "row int, `Dataset ID` string, `Model Name` string, `Key Columns` string, `Sample Size` string, Status string, Notes string",
    )
    data = tables(spark)
    run = batch.compare_many(control, data.__getitem__, data.__getitem__, "row")
    got = {r["ordinal"]: (r["status"], r["overall_match"]) for r in run.outcomes.collect()}
    assert got == {1: ("success", True), 2: ("success", False), 3: ("failed", None)}
    notes = {r["row"]: r["Notes"] for r in run.control.collect()}
    assert notes[1].startswith("before\n\nPERFECT MATCH: same -> same\n") and "All values matched" in notes[1]
    assert notes[2].startswith("DISCREPANCIES FOUND: same -> off\n") and "Amount $" in notes[2]
    assert notes[3].startswith("COMPARISON FAILED") and notes[4] == notes[5] == notes[6] == "kept"
    sampled = batch.compare_many(control, data.__getitem__, data.__getitem__, "row", sampled=True)
    assert sampled.outcomes.filter("ordinal = 1").first()["overall_match"]


def test_migrate_control(spark, tmp_path):
    control = spark.createDataFrame(
        [(1, "same", "A B", None), (2, "gone", "x", "Pending"), (3, " ", "y", "Pending"), (4, "off", "z", "MIGRATED 2024"),
         (5, "same", "again", "Failed")], "row int, `Dataset ID` string, `Model Name` string, Status string",
    )
    run = migrate.migrate_control(control, tables(spark).__getitem__, lambda t: str(tmp_path / t), "row")
    got = {r["ordinal"]: (r["status"], r["target_table"], r["actual"]) for r in run.outcomes.collect()}
    assert got == {1: ("success", "a_b", 50), 2: ("error", "x", None), 3: ("error", None, None), 5: ("success", "again", 50)}
    status = {r["row"]: r["Status"] for r in run.control.collect()}
    assert status == {1: "Migrated", 2: "Pending", 3: "Pending", 4: "MIGRATED 2024", 5: "Failed"}
    assert spark.read.parquet(str(tmp_path / "a_b")).columns == ["ID", "AMOUNT"]


def test_via_stage_and_incremental(spark, tmp_path):
    source = tables(spark)["same"]
    assert migrate.via_stage(source, str(tmp_path / "stage"), "one", str(tmp_path / "t")).first()[:] == (50, 50, 0, True)
    loaded = spark.read.parquet(str(tmp_path / "t"))
    assert loaded.count() == 50 and loaded.dtypes == [("ID", "int"), ("AMOUNT", "double")]
    schema = migrate.staged_schema(source)
    for expected in (50, 50, 100):
        if expected == 100:
            migrate.to_stage(source, str(tmp_path / "stage"), "two")
        ingest_stage(spark, str(tmp_path / "stage"), str(tmp_path / "inc"), schema, str(tmp_path / "state"))
        assert spark.read.parquet(str(tmp_path / "inc")).count() == expected


def test_negative_zero_keys_are_one_key(spark):
    df = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "k double, v int")
    s = compare_tables(df, df, ["k"]).summary.first()
    assert (s["common_rows"], s["left_duplicate_rows"]) == (2, 2)


def test_stage_models_control(spark):
    control = spark.createDataFrame(
        [("ds", "T", "stg_t.sql", None), ("nods", "U", "stg_u.sql", "False"), ("ds", "GONE", "stg_g.sql", None),
         ("ds", "T", "done.sql", "TRUE"), ("ds", None, "no_name.sql", None)],
        "`Dataset ID` string, Name string, Model string, Check string",
    )
    left = spark.createDataFrame([("ds", 1, "Order ID", "LONG")], "dataset string, ordinal int, name string, type string")
    right = spark.createDataFrame([("T", 1, "ORDER_ID", "NUMBER"), ("U", 1, "X", "DATE")], left.schema)
    models = stage_models(control, left, right, use_cast=True)
    expressions = {(r["model"], r["status"]): r["expression"] for r in models.columns.collect()}
    assert expressions == {
        ("stg_t.sql", "matched"): 'cast("ORDER_ID" as number) as order_id',
        ("stg_u.sql", "default_type"): 'cast("X" as date) as x',
        ("stg_g.sql", "target_missing"): None,
    }
    checks = {r["Model"]: r["Check"] for r in models.control.collect()}
    assert checks == {"stg_t.sql": "True", "stg_u.sql": "True", "stg_g.sql": None, "done.sql": "TRUE", "no_name.sql": None}
    manifest = source_manifest(control, "DW", "SRC")
    assert {r["name"] for r in manifest.collect()} == {"T", "U", "GONE"}

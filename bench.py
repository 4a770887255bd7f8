"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.
Each query is planned and run in full into a no-op sink; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from checks.all import QUERIES  # noqa: E402
from checks.inputs import frame  # noqa: E402
from ferrytally.operators import cleaning, sampling  # noqa: E402
from ferrytally.plans import migrate  # noqa: E402
from ferrytally.session import scratch_path  # noqa: E402

HEADLINE = [
    "compare_tables", "compare_tables_duplicate_keys", "compare_tables_hot_key", "compare_tables_sampled",
    "compare_with_csv", "column_stats_tolerant", "rows_left_only", "duplicate_row_count", "sample_sync_random",
    "occurrence_number", "schema_summary", "fuzzy_schema_join", "apply_schema", "rename_transformed",
    "load_from_stage", "status_update_join", "explode_outputs", "producers_of", "transitive_sources", "flow_scores",
]


def auto_types_documents(spark, sf):
    return cleaning.auto_types(frame(spark, sf, "documents"))


def sync_sample_lineitem(spark, sf):
    left, right = frame(spark, sf, "lineitem"), frame(spark, sf, "right_lineitem")
    return sampling.sync_sample(left, right, ["l_orderkey", "l_linenumber"])[1]


def migrate_lineitem(spark, sf):
    return migrate.migrate(frame(spark, sf, "lineitem"), scratch_path(spark, "bench"), limit=None)


EXTRA = {f.__name__: f for f in (auto_types_documents, sync_sample_lineitem, migrate_lineitem)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("ferrytally-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or [*HEADLINE, *EXTRA]
    times = {}
    for name in chosen:
        fn = EXTRA.get(name) or QUERIES[name]
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(f"{name}: {[round(r, 2) for r in runs]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Compare registered queries with their oracle SQL: ``python -m checks.against_oracle SF_DIR [key ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from checks.inputs import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def _bag(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(spark: SparkSession, con, sf_dir: str, fn, sql: str | None) -> str | None:
    """What differs between a query and its oracle, or None."""
    df = fn(spark, sf_dir)
    columns, got = _bag(df.columns, df.collect())
    if not got:
        return "no rows"
    if sql is None:
        return None
    result = con.execute(sql)
    want_columns, want = _bag([d[0] for d in result.description], result.fetchall())
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    if got != want:
        extra, missing = got - want, want - got
        return (
            f"{sum(got.values())} rows against {sum(want.values())}; only Spark {sum(extra.values())}: "
            f"{list(extra)[:2]}; only oracle {sum(missing.values())}: {list(missing)[:2]}"
        )
    return None


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("ferrytally")
        .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str, keys: list[str]) -> int:
    from checks.all import ORACLES, QUERIES

    spark, con, bad = session(), connect(sf_dir), 0
    for key in keys or sorted(QUERIES):
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, QUERIES[key], ORACLES.get(key))
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        kind = "sql" if key in ORACLES else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.2f}s {key} {problem or ''}", flush=True)
    print(f"{bad} of {len(keys or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)

"""Compare queries with their SQL: ``python -m checks.run [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, norm(v)) for k, v in value.items()))
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cut = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(cut, key=repr)


def compare(spark: SparkSession, con, sf_dir: str, name: str, query, sql: str | None) -> str:
    started = time.time()
    frame = query(spark, sf_dir)
    got = as_rows(frame.columns, [tuple(r) for r in frame.collect()])
    took = time.time() - started
    if sql is None:
        return f"rows {len(got[1])} {took:.1f}s"
    cursor = con.execute(sql)
    want = as_rows([d[0] for d in cursor.description], cursor.fetchall())
    if got == want:
        return f"ok {len(got[1])} {took:.1f}s"
    if got[0] != want[0]:
        return f"BAD columns {got[0]} {want[0]}"
    extra = [r for r in got[1] if r not in set(want[1])][:2]
    lacking = [r for r in want[1] if r not in set(got[1])][:2]
    return f"BAD {len(got[1])} vs {len(want[1])}\n   spark {str(extra)[:900]}\n   sql   {str(lacking)[:900]}"


def main() -> None:
    from checks import ORACLES, QUERIES, load_all

    load_all()
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    con = duck(sf_dir)
    bad = 0
    for name in names:
        try:
            line = compare(spark, con, sf_dir, name, QUERIES[name], ORACLES.get(name))
        except Exception as problem:  # noqa: BLE001
            line = f"BAD {type(problem).__name__} {str(problem)[:1500]}"
        bad += line.startswith("BAD")
        print(f"{name}: {line}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()

"""Compare every query with its SQL twin: row count, schema and values.

    python -m workload.verify [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

# DuckDB type -> Spark type
TYPES = {
    "VARCHAR": "string",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "DATE": "date",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _canonical(value) -> str:
    if value is None or value is pd.NaT:
        return "NULL"
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def _rows(records) -> list[tuple[str, ...]]:
    return sorted(tuple(_canonical(v) for v in r) for r in records)


def compare(spark: SparkSession, db, sf_dir: str, query, sql: str | None) -> str:
    df = query(spark, sf_dir)
    names = sorted(df.columns)
    actual = _rows(tuple(r) for r in df.select(*names).collect())
    if sql is None:
        return f"rows only: {len(actual)}"
    relation = db.sql(sql)
    if sorted(relation.columns) != names:
        return f"FAIL columns {names} != {sorted(relation.columns)}"
    kinds = {c: TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    wrong = {c: (k, kinds[c]) for c, k in df.dtypes if kinds[c] != k}
    if wrong:
        return f"FAIL types {wrong}"
    order = [relation.columns.index(c) for c in names]
    expected = _rows(tuple(r[i] for i in order) for r in relation.fetchall())
    if len(actual) != len(expected):
        return f"FAIL rows {len(actual)} != {len(expected)}"
    different = [(a, e) for a, e in zip(actual, expected) if a != e]
    if different:
        return f"FAIL {len(different)} of {len(actual)} rows differ, first {different[0]}"
    return f"ok: {len(actual)} rows"


def open_database(sf_dir: str):
    db = duckdb.connect()
    for name in TABLES:
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def main() -> int:
    sys.path.insert(0, os.getcwd())
    from workload.oracle import ORACLE
    from workload.queries import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = open_database(sf_dir)
    failures = 0
    for name in chosen:
        started = time.time()
        try:
            verdict = compare(spark, db, sf_dir, QUERIES[name], ORACLE.get(name))
        except Exception as error:  # report and go on with the next query
            verdict = f"FAIL {type(error).__name__}: {str(error)[:600]}"
        failures += verdict.startswith("FAIL")
        print(f"{name:28s} {time.time() - started:6.2f}s  {verdict}", flush=True)
    print(f"{len(chosen)} queries, {failures} failures")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())

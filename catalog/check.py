"""Run every query in Spark, its statement in DuckDB, and compare: ``python -m catalog.check [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

import catalog


def check_engine(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if hasattr(x, "tolist"):
            x = x.tolist()
        if isinstance(x, list):
            return repr([cell(i) for i in x])
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and x != x):
            return ""
        if isinstance(x, bool):
            return str(x)
        if isinstance(x, (int, float)):
            return repr(float(x))
        return str(x)
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(cell(x) for x in row) for row in frame.itertuples(index=False))


def compare(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """None when both engines agree, else what differs."""
    ours = catalog.QUERIES[name](spark, sf_dir).toPandas()
    if name not in catalog.ORACLE:
        return None if len(ours) else "no rows"
    theirs = connection.execute(catalog.ORACLE[name]).fetchdf()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"
    a, b = canonical(ours), canonical(theirs)
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:4], sorted(set(b) - set(a))[:4]
    return f"{len(a)} against {len(b)} rows; only here {only_a}; only there {only_b}"


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.001"
    catalog.load_all()
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = check_engine(sf_dir)
    failed = 0
    for name in arguments[1:] or catalog.QUERIES:
        start = time.time()
        try:
            problem = compare(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        kind = "sql " if name in catalog.ORACLE else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
        failed += problem is not None
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))

"""Run registered queries in Spark and their SQL in DuckDB, and compare the rows.

python -m checks.compare [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from .oracle import ORACLE
from .queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    rows = [
        tuple(float(v) if isinstance(v, (int, float)) else v for v in row)
        for row in plain.itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def compare(spark: SparkSession, con, sf: str, name: str) -> tuple[bool, str]:
    start = time.time()
    ours = QUERIES[name](spark, sf).toPandas()
    spent = time.time() - start
    if name not in ORACLE:
        return True, f"{len(ours)} rows, no SQL, {spent:.1f}s"
    start = time.time()
    theirs = con.sql(ORACLE[name]).df()
    note = f"{spent:.1f}s, SQL {time.time() - start:.1f}s"
    if sorted(ours.columns) != sorted(theirs.columns):
        return False, f"columns {list(ours.columns)} / {list(theirs.columns)}"
    a, b = rows_of(ours), rows_of(theirs)
    if a == b:
        return True, f"{len(a)} rows, {note}"
    left, right = set(a) - set(b), set(b) - set(a)
    return False, (
        f"{len(a)} / {len(b)} rows; only ours {sorted(left, key=repr)[:3]}; "
        f"only SQL {sorted(right, key=repr)[:3]}, {note}"
    )


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = database(args.sf)
    failed = []
    for name in args.names or QUERIES:
        try:
            good, note = compare(spark, con, args.sf, name)
        except Exception as error:  # noqa: BLE001
            good, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if good else 'FAIL'} {name}: {note}", flush=True)
        if not good:
            failed.append(name)
    print("failed:", failed)


if __name__ == "__main__":
    main()

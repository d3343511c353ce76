"""Run every registered query beside its SQL counterpart and compare names, counts and values.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry_points  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("tillstar-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _norm(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(row[i]) for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, con, name: str, folder: str) -> tuple[bool, str]:
    started = time.time()
    df = entry_points.queries()[name](spark, folder)
    got = rows_of(df.columns, df.collect())
    seconds = time.time() - started
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        return True, f"rows only: {len(got)} rows, {seconds:.1f} s"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if len(got) != len(want):
        return False, f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return False, f"{a} against {b}"
    return True, f"{len(got)} rows, {seconds:.1f} s"


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:]
    spark, con, failed = session(), database(folder), []
    for name in names or entry_points.queries():
        try:
            good, note = compare(spark, con, name, folder)
        except Exception as error:  # a broken query must not hide the others
            good, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if good else "FAIL", name, note, flush=True)
        if not good:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())

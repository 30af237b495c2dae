"""Compare every query with its SQL twin, ignoring row and column order."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

import suite.current  # noqa: F401
import suite.learning  # noqa: F401
from suite.oracle import ORACLE
from suite.registry import QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[str | None, int]:
    """What differs, or None, and the number of rows."""
    found = QUERIES[name](spark, sf_dir)
    got = _rows(found.columns, found.collect())
    if name not in ORACLE:
        return None, sum(got.values())
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)} against {sorted(columns)}", sum(got.values())
    if got != want:
        extra, lost = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows against {sum(want.values())}; only here {extra}; only SQL {lost}", sum(got.values())
    return None, sum(got.values())


def main() -> None:
    from legwork.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem, rows = differences(spark, con, sf_dir, name)
        except Exception as error:  # report every query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += problem is not None
        kind = "ok" if name in ORACLE else "rows only"
        print(f"{name:28} {rows:8} {time.time() - start:6.1f}s {problem or kind}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()

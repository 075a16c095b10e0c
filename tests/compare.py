"""Compare registered queries with their SQL on DuckDB.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(_value(v) for v in value)
    return repr(value)


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(spark, connection, fn, sql, sf_dir) -> str | None:
    """None if both sides agree, else a short description."""
    df = fn(spark, sf_dir)
    mine = multiset(df.columns, df.collect())
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(columns)}"
    other = multiset(columns, result.fetchall())
    if mine == other:
        return None
    return (f"{sum(mine.values())} and {sum(other.values())} rows; only ours {list((mine - other).items())[:3]}; "
            f"only SQL {list((other - mine).items())[:3]}")


def main() -> int:
    from pyspark.sql import SparkSession

    from karst.workload import ORACLES, QUERIES
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in names:
        started = time.time()
        try:
            if name in ORACLES:
                problem = difference(spark, connection, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem = None if QUERIES[name](spark, sf_dir).collect() else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.2f}s"
              f"{'' if name in ORACLES else ' (rows only)'} {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)

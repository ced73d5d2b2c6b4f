"""Run registered queries beside their SQL twins and compare whole results.

``python tests/oracle_check.py [sf_dir] [name ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rillstone.plans import ORACLE, QUERIES  # noqa: E402


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> str:
    """Empty text when names, types' families, row count and all values agree."""
    frame = QUERIES[name](spark, sf_dir)
    ours = _sorted_rows(frame.columns, frame.collect())
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    theirs = _sorted_rows(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} vs {sorted(columns)}"
    same_type = {
        "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
        "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
    }
    for column, kind in frame.dtypes:
        if same_type.get(kind) != kinds[column]:
            return f"type of {column}: {kind} vs {kinds[column]}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference: {a} vs {b}"
    return ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        begun = time.time()
        problem = compare(spark, con, name, sf_dir)
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begun:.2f}s {problem}")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())

"""Run queries beside their SQL and compare rows: python -m harness.check SF_DIR [name ...]"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from harness.oracles import ORACLES
from harness.queries import QUERIES


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark: SparkSession, db, name: str, sf_dir: str) -> str:
    """Empty if the query and its SQL give the same rows, else what differs."""
    ours = QUERIES[name](spark, sf_dir)
    got = rows_of(ours.columns, ours.collect())
    cursor = db.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    if sorted(ours.columns) != sorted(columns):
        return f"columns {sorted(ours.columns)} against {sorted(columns)}"
    if got != want:
        return (f"{sum(got.values())} rows against {sum(want.values())}; "
                f"only ours {str(list((got - want).elements())[:2])[:700]}; "
                f"only SQL {str(list((want - got).elements())[:2])[:700]}")
    types = {c: t for c, t in ours.dtypes}
    if any(t in ("timestamp", "date") or t.startswith(("array", "struct", "map")) for t in types.values()):
        return f"types that do not compare: {types}"
    return ""


def main() -> int:
    sf_dir, *names = sys.argv[1:]
    spark, db = session(), connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        began = time.time()
        try:
            problem = compare(spark, db, name, sf_dir) if name in ORACLES else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.2f}s {problem}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))

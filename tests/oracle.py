"""Compare registered queries with their SQL: ``python tests/oracle.py [sf] [query ...]``."""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    return sorted(tuple(_plain(v) for v in row) for row in frame.itertuples(index=False, name=None))


def _plain(value):
    if value is None:
        return ""
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, (int, float)) or hasattr(value, "item"):
        number = value.item() if hasattr(value, "item") else value
        return str(float(number))
    return str(value)


def compare(spark, con, sf_dir, query, sql):
    """``(problem or None, rows)`` of one query."""
    ours = query(spark, sf_dir).toPandas()
    theirs = con.execute(sql).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}", len(ours)
    left, right = canonical(ours), canonical(theirs)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}", len(left)
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return (f"{len(different)} rows differ, first {different[0]}" if different else None), len(left)


def main():
    from __spark_entry__ import oracle_sql, queries
    from tierflow.runtime import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    chosen = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(
        "oracle", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__sql__warehouse__dir="/tmp/tierflow-oracle-warehouse",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in sqls:
                problem, count = compare(spark, con, sf_dir, query, sqls[name])
            else:
                problem, count = None, query(spark, sf_dir).count()
        except Exception as error:  # report and go on with the next query
            problem, count = f"{type(error).__name__}: {str(error)[:1500]}", 0
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok':5}{name:28}{count:8} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()

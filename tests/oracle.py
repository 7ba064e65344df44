"""Compare registered queries with their oracles: ``python tests/oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def value(v):
    return str(v) if isinstance(v, (bytes, dict, list)) else v


def bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(row[i]) for i in order) for row in rows)


def difference(spark, connection, sf_dir: str, query, oracle: str) -> str | None:
    """What differs between a query and its oracle, or None."""
    df = query(spark, sf_dir)
    got_rows = [tuple(r) for r in df.collect()]
    cursor = connection.execute(oracle)
    columns, types = [d[0] for d in cursor.description], [str(d[1]) for d in cursor.description]
    want_rows = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    names = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    wanted_types = dict(zip(columns, types))
    off = [f"{c} {t} != {wanted_types[c]}" for c, t in df.dtypes if names.get(t, t) != wanted_types[c]]
    if off:
        return "types " + ", ".join(off)
    got, want = bag(df.columns, got_rows), bag(columns, want_rows)
    if got != want:
        only_got, only_want = got - want, want - got
        return f"{sum(only_got.values())}/{len(got_rows)} rows differ: {list(only_got)[:2]} != {list(only_want)[:2]}"
    return None


def main() -> int:
    import __spark_entry__ as contract
    from lakeloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark = build_session("oracle", master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            if name in contract.oracle_sql():
                problem = difference(spark, connection, sf_dir, query, contract.oracle_sql()[name])
            else:
                print(f"{name}: no SQL, {query(spark, sf_dir).count()} rows", end=" ")
                problem = None
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())

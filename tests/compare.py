"""Runs registered queries beside their SQL and compares all rows. Usage: python tests/compare.py SF [names]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return repr(value)
    return str(value) if value is not None else None


def oracle(folder):
    connection = duckdb.connect()
    connection.execute("set TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def rows_of(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=lambda r: tuple((x is None, x or "") for x in r))


def compare(spark, connection, query, sql, folder):
    """None when both sides agree, else a description of the first difference."""
    df = query(spark, folder)
    mine = rows_of(df.columns, df.collect())
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    theirs = rows_of(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} / {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(names)}\n  spark {a}\n  sql   {b}"
    return None


if __name__ == "__main__":
    from tidemark.plans.workload import QUERIES
    from tidemark.plans.workload_sql import SQL
    from tidemark.session import local_session

    folder = f"/root/testdata/sf{sys.argv[1]}"
    spark, connection = local_session(8), oracle(folder)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            result = compare(spark, connection, QUERIES[name], SQL[name], folder) or "ok"
        except Exception as error:
            result = f"ERROR {str(error)[:600]}"
        print(f"{name:26s} {time.time() - start:6.1f}s  {result}", flush=True)
